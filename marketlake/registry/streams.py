"""Streams over the events file; each run drains what is available and reads the result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake import streaming
from marketlake.operators.maintain import read_table, upsert_batches
from marketlake.registry.base import KEYS, TRADES_SQL, Tables, register, rounded, trades
from marketlake.registry.series import candles_cte, rounded_sql
from marketlake.session import shared_path
from marketlake.sources import message_stream, parse_messages


class _StreamTables(Tables):
    """As Tables, with events read as a stream."""

    def __getattr__(self, name: str) -> DataFrame:
        schema = self.spark.read.parquet(self.path(name)).schema
        # as a pattern, the path may name one file or a folder of files
        pattern = f"{self.sf_dir}/[{name[0]}]{name[1:]}.parquet"
        return streaming.open_trade_stream(self.spark, pattern, schema)


def _stream(t: Tables) -> DataFrame:
    return trades(_StreamTables(t.spark, t.sf_dir))


def _closed(unit: str, relation: str) -> str:
    return rounded_sql(
        f"(SELECT * FROM {relation} WHERE datetime + INTERVAL 1 {unit} <= (SELECT max(ts) FROM trades) - INTERVAL 1 HOUR)"
    )


for _interval, _unit in {"1h": "hour", "1d": "day"}.items():

    @register(f"stream_candles_{_interval}", f"WITH {candles_cte(_unit)} {_closed(_unit, 'candles')}")
    def _stream_candles(t: Tables, interval: str = _interval) -> DataFrame:
        out, checkpoint = shared_path(t.spark, "bars"), shared_path(t.spark, "bars-state")
        streaming.drain(streaming.live_candles(_stream(t), KEYS, interval), out, checkpoint)
        return rounded(streaming.closed_candles(t.spark.read.parquet(out), KEYS, interval))


@register("stream_upsert", f"WITH {TRADES_SQL} SELECT * FROM trades")
def _stream_upsert(t: Tables) -> DataFrame:
    """The same input drained by two queries into one table: the second changes nothing."""
    out = shared_path(t.spark, "upserted")
    for run in range(2):
        checkpoint = shared_path(t.spark, f"upserted-state-{run}")
        streaming.drain(_stream(t), out, checkpoint, upsert_batches(out, [*KEYS, "seq"], ["ts"]))
    return t.spark.read.parquet(out)


@register("stream_trades_dedup", f"WITH {TRADES_SQL} SELECT * FROM trades")
def _stream_dedup(t: Tables) -> DataFrame:
    out, checkpoint = shared_path(t.spark, "unique"), shared_path(t.spark, "unique-state")
    twice = _stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    unique = streaming.unique_live_trades(twice, KEYS).drop("event_time")
    streaming.drain(unique, out, checkpoint)
    return t.spark.read.parquet(out)


@register(
    "stream_messages",
    """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '' AS text FROM events WHERE event_type <> 'error'
       UNION ALL SELECT -1, 'not json ' || event_id FROM events WHERE event_type = 'error'""",
)
def _stream_messages(t: Tables) -> DataFrame:
    landed, out = shared_path(t.spark, "messages"), shared_path(t.spark, "parsed")
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), "event_id")).otherwise(F.col("props"))
    t.events.select(value.alias("value")).write.text(landed)
    parsed = parse_messages(message_stream(t.spark, landed)).select(
        F.coalesce(F.try_variant_get("message", "$.k", "bigint"), F.lit(-1)).alias("k"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    streaming.drain(parsed, out, shared_path(t.spark, "parsed-state"))
    return t.spark.read.parquet(out)


@register("stream_candles_1m", f"WITH {candles_cte('minute')} {rounded_sql('candles')}")
def _stream_open_candles(t: Tables) -> DataFrame:
    """All minute bars, those still open included: each batch upserts the bars it changed."""
    out, checkpoint = shared_path(t.spark, "open-bars"), shared_path(t.spark, "open-bars-state")
    bars = streaming.live_candles(_stream(t), KEYS, "1m")
    bars = bars.withColumn("date", F.to_date("datetime"))
    streaming.upsert_stream(
        bars, out, checkpoint, [*KEYS, "datetime"], ["last_trade_timestamp"], ["date"], "update", "bars"
    ).awaitTermination()
    stored = read_table(t.spark, out).drop("date")
    return rounded(streaming.closed_candles(stored, KEYS, "1m"))


@register("stream_resume", f"WITH {TRADES_SQL} SELECT *, CAST(ts AS DATE) AS date FROM trades")
def _stream_resume(t: Tables) -> DataFrame:
    """Trades landing in three parts, the last one a repeat, picked up by three runs of one checkpoint."""
    landed, out, state = (shared_path(t.spark, n) for n in ("landed", "resumed", "resumed-state"))
    rows = trades(t).withColumn("date", F.to_date("ts"))
    for part in ("seq % 2 = 0", "seq % 2 = 1", "seq % 4 = 0"):
        rows.where(part).write.mode("append").parquet(landed)
        stream = streaming.open_trade_stream(t.spark, landed, rows.schema)
        streaming.upsert_stream(
            stream, out, state, [*KEYS, "seq"], ["ts"], ["date"], name="trades"
        ).awaitTermination()
    return read_table(t.spark, out)
