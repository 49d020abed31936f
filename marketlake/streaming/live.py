"""Live trades: de-duplication, candles, idempotent upserts.

The event-time column is cast to a zoned timestamp for the watermark and back
to a zone-less one in the output.  State is bounded by the watermark: trades
later than ``delay`` after the newest one are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake.functions import interval_unit
from marketlake.functions.time import NTZ
from marketlake.operators.maintain import upsert_batches
from marketlake.operators.series import carry_open, trade_measures, unfold_measures

DELAY = "1 hour"


def open_trade_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Parquet files arriving below ``path`` (a folder or a pattern); each file is picked up once."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def watermarked(trades: DataFrame, delay: str = DELAY) -> DataFrame:
    return trades.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)


def unique_live_trades(trades: DataFrame, keys: Sequence[str], delay: str = DELAY, seq: str = "seq") -> DataFrame:
    """Drop repeats of a sequence number that arrive within the delay."""
    stream = trades if "event_time" in trades.columns else watermarked(trades, delay)
    return stream.dropDuplicatesWithinWatermark([*keys, seq])


def live_candles(trades: DataFrame, keys: Sequence[str], interval: str, delay: str = DELAY) -> DataFrame:
    """Candles over tumbling windows; in append mode a bar appears once it is closed.

    In update mode every bar that a micro-batch changed comes out as it is by
    then, open or closed; upserted by key, the table holds all bars at any time.

    The open is the first trade of the bar: the carried open needs the previous
    bar and is applied on reading (:func:`closed_candles`).
    """
    unit = interval_unit(interval)
    stream = trades if "event_time" in trades.columns else watermarked(trades, delay)
    bars = stream.groupBy(F.window("event_time", f"1 {unit.lower()}").alias("w"), *keys).agg(*trade_measures())
    return unfold_measures(bars, [*keys, F.col("w.start").cast(NTZ).alias("datetime")])


def closed_candles(stored: DataFrame, keys: Sequence[str], interval: str) -> DataFrame:
    """Stored live candles with the carried open."""
    return carry_open(stored, keys, interval)


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    latest: Sequence[str],
    partition_by: Sequence[str] = (),
    output_mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch into a Parquet table; available input, then stop.

    Started again with the same ``checkpoint`` it picks up where it stopped.
    With a ``name`` a batch that reached the table before a crash is not applied again.
    """
    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert_batches(path, keys, latest, partition_by, name))
        .trigger(availableNow=True)
        .start()
    )


def drain(
    stream: DataFrame, path: str, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None
) -> None:
    """Process what is available into Parquet (or ``sink``) and wait for the end."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink is None:
        query = writer.format("parquet").outputMode("append").start(path)
    else:
        query = writer.foreachBatch(sink).start()
    query.awaitTermination()
