from datetime import timedelta

from pyspark.sql import functions as F

from moments import at
from marketlake import streaming
from marketlake.operators import series

KEYS = ["market", "instrument"]
TRADE = "market string, instrument string, ts timestamp_ntz, seq bigint, price double, quantity double, side string"


def trades(rows, start, n):
    return rows(
        [("m", "i", at("2024-01-01T00:00:00") + timedelta(minutes=17 * k), k, float(k % 13 + 1), 1.0, "BUY") for k in range(start, n)],
        TRADE,
    )


def test_stream_continues_from_its_checkpoint(spark, rows, tmp_path):
    """Two deliveries give the closed bars of a batch over both."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = trades(rows, 0, 1).schema
    for start, end in ((0, 100), (100, 200)):
        trades(rows, start, end).write.mode("append").parquet(source)
        stream = streaming.open_trade_stream(spark, source, schema)
        streaming.drain(streaming.live_candles(stream, KEYS, "1h"), out, state)
    got = streaming.closed_candles(spark.read.parquet(out), KEYS, "1h")
    want = series.candles(trades(rows, 0, 200), KEYS, "1h")
    last = want.agg(F.max("datetime")).first()[0]
    closed = want.where(F.col("datetime") < F.lit(last - timedelta(hours=1)))
    columns = want.columns
    assert got.select(*columns).exceptAll(closed).where(F.col("datetime") < F.lit(last - timedelta(hours=1))).count() == 0
    assert closed.exceptAll(got.select(*columns)).count() == 0


def test_open_bars_by_update_and_upsert(spark, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    trades(rows, 0, 50).write.parquet(source)
    stream = streaming.open_trade_stream(spark, source, trades(rows, 0, 1).schema)
    live = streaming.live_candles(stream, KEYS, "1h")
    query = streaming.upsert_stream(
        live, out, str(tmp_path / "state"), [*KEYS, "datetime"], ["last_trade_timestamp"], output_mode="update"
    )
    query.awaitTermination()
    want = series.candles(trades(rows, 0, 50), KEYS, "1h", carry=False)
    got = spark.read.parquet(out).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
