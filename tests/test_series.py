from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from moments import at
from marketlake.operators import ranking, series

TRADE = "market string, instrument string, ts timestamp_ntz, seq bigint, price double, quantity double, side string"
KEYS = ["market", "instrument"]


@pytest.fixture
def trades(rows):
    def make(*items):
        return rows([("m", "i", at(t), s, float(p), float(q), side) for t, s, p, q, side in items], TRADE)

    return make


def bars(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("datetime").collect()]


def test_candle_carries_open_and_extends_range(trades):
    df = trades(
        ("2024-01-01T00:00:10", 1, 10, 1, "BUY"),
        ("2024-01-01T00:00:50", 2, 12, 2, "sell"),
        ("2024-01-01T00:03:00", 3, 15, 1, None),
        ("2024-01-01T00:03:30", 4, 14, 1, "BUY"),
    )
    got = bars(series.candles(df, KEYS, "1m"), "open", "high", "low", "close", "first_trade_price", "total_trades_unknown")
    assert got == [(10, 12, 10, 12, 10, 0), (12, 15, 12, 14, 15, 1)]
    sides = series.candles(df, KEYS, "1m").select("volume", "volume_buy", "volume_sell", "volume_unknown").collect()
    assert all(r[0] == r[1] + r[2] + r[3] for r in sides)


def test_first_and_last_use_sequence_on_equal_times(trades):
    df = trades(
        ("2024-01-01T00:00:10", 7, 3, 1, "BUY"),
        ("2024-01-01T00:00:10", 5, 1, 1, "BUY"),
        ("2024-01-01T00:00:10", 6, 2, 1, "BUY"),
    )
    assert bars(series.candles(df, KEYS, "1h"), "open", "close") == [(1, 3)]


def test_high_time_is_the_first_time_of_the_price(trades):
    df = trades(
        ("2024-01-01T00:00:10", 1, 5, 1, "BUY"),
        ("2024-01-01T00:00:20", 2, 9, 1, "BUY"),
        ("2024-01-01T00:00:30", 3, 9, 1, "BUY"),
        ("2024-01-01T00:00:40", 4, 5, 1, "BUY"),
    )
    got = bars(series.candles(df, KEYS, "1m"), "high_trade_timestamp", "low_trade_timestamp")
    assert got == [(at("2024-01-01T00:00:20"), at("2024-01-01T00:00:10"))]


def test_neighbour_across_blocks_matches_a_plain_window(spark, rows):
    data = [
        (f"k{k}", at("2024-01-01T00:00:00") + timedelta(minutes=step * 37 * (k + 1)), float(step))
        for k in range(3)
        for step in range(300)
    ]
    data += [("null", at("2024-01-01T00:00:00"), None), ("null", at("2024-01-05T00:00:00"), 2.0)]
    df = rows(data, "k string, datetime timestamp_ntz, close double")
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy("datetime")
    want = df.withColumns({"p": F.lag("close").over(w), "n": F.lead("close").over(w)})
    got = series.neighbour(df, ["k"], "1m", "close", "p", -1)
    got = series.neighbour(got, ["k"], "1m", "close", "n", 1)
    order = ["k", "datetime"]
    assert got.orderBy(*order).collect() == want.orderBy(*order).collect()


def test_hot_instrument_is_split_over_partitions(spark):
    """One instrument with most bars still spreads over the window partitions."""
    hot = spark.range(40 * 1440).select(
        F.lit("hot").alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id"))).alias("datetime"),
        F.col("id").cast("double").alias("close"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = series.neighbour(hot, ["k"], "1m", "close", "p").withColumn("pid", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("pid").count().collect()]
        assert max(sizes) < 40 * 1440 / 2
        assert out.where("not (p <=> close - 1) and close > 0").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_fill_start_middle_end(trades):
    df = series.candles(
        trades(
            ("2024-01-01T23:58:10", 1, 10, 1, "BUY"),
            ("2024-01-02T00:01:10", 2, 12, 2, "BUY"),
        ),
        KEYS,
        "1m",
    )
    filled = series.fill_gaps(df, KEYS, "1m", F.lit("2024-01-02 00:03:59").cast("timestamp_ntz"))
    got = bars(filled, "datetime", "open", "close", "total_trades", "first_trade_price")
    assert [g[0].strftime("%H:%M") for g in got] == ["23:58", "23:59", "00:00", "00:01", "00:02", "00:03"]
    assert [g[1:] for g in got] == [
        (10, 10, 1, 10),
        (10, 10, 0, None),
        (10, 10, 0, None),
        (10, 12, 1, 12),
        (12, 12, 0, None),
        (12, 12, 0, None),
    ]
    assert series.without_inactive(filled).count() == 2
    assert series.fill_gaps(df.where("false"), KEYS, "1m").count() == 0
    # an end before the last bar adds nothing after it
    early = series.fill_gaps(df, KEYS, "1m", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert early.count() == 4


def test_reaggregate_keeps_the_bucket_of_to_ts(trades):
    df = series.candles(
        trades(*[(f"2024-01-01T{h:02d}:00:00", h, h + 1, 1, "BUY") for h in range(8)]), KEYS, "1h"
    )
    to_ts = F.lit("2024-01-01 05:10:00").cast("timestamp_ntz")
    got = bars(series.reaggregate(df, KEYS, "1h", 4, to_ts), "datetime", "open", "close", "total_trades")
    assert got == [(at("2024-01-01T00:00:00"), 1, 4, 4), (at("2024-01-01T04:00:00"), 4, 8, 4)]
    assert bars(series.reaggregate(df, KEYS, "1h", 4, to_ts, limit=4), "datetime") == [(at("2024-01-01T04:00:00"),)]


def test_mapping_inverts(trades, rows):
    df = series.candles(
        trades(("2024-01-01T00:00:00", 1, 2, 3, "BUY"), ("2024-01-01T00:30:00", 2, 4, 1, "SELL")), KEYS, "1h"
    )
    mapping = rows([("m", "i", "J", True)], "market string, instrument string, mapped_instrument string, inverted boolean")
    got = series.apply_mapping(df, mapping).first()
    assert (got["open"], got["high"], got["low"], got["close"]) == (0.5, 0.5, 0.25, 0.25)
    assert (got["volume"], got["quote_volume"], got["mapped_instrument"]) == (10, 4, "J")
    assert got["high_trade_timestamp"] == at("2024-01-01T00:00:00")
    same = series.apply_mapping(df, mapping.where("false")).first()
    assert (same["open"], same["mapped_instrument"]) == (2, "i")


def test_tick_windows(trades):
    df = trades(
        ("2023-06-01T00:00:00", 1, 1, 1, "BUY"),
        ("2024-03-03T12:00:00", 2, 8, 1, "BUY"),  # a Sunday: the day before the current week
        ("2024-03-04T00:00:00", 3, 10, 2, "SELL"),
        ("2024-03-05T10:00:00", 4, 11, 1, "BUY"),
        ("2024-03-05T10:30:00", 5, 12, 1, "BUY"),
        ("2024-03-06T00:00:00", 6, 99, 1, "BUY"),  # after as_of
    )
    got = series.latest_tick(df, KEYS, F.lit("2024-03-05 10:30:00")).first()
    assert (got["price"], got["current_hour_open"], got["current_day_open"]) == (12, 11, 11)
    assert (got["current_week_open"], got["current_week_volume"], got["current_month_open"]) == (10, 4, 8)
    assert got["moving_24_hour_total_trades"] == 2
    assert got["moving_180_day_open"] == 8 and got["moving_365_day_open"] == 1
    assert (got["lifetime_low"], got["lifetime_high"], got["lifetime_change"]) == (1, 12, 11)
    assert got["lifetime_change_percentage"] == 1100
    assert got["current_day_volume_sell"] == 0


def test_tick_window_without_trades(trades):
    got = series.latest_tick(trades(("2024-01-01T00:00:00", 1, 5, 1, "BUY")), KEYS, F.lit("2024-03-05 10:30:00")).first()
    assert got["current_hour_open"] is None and got["current_hour_total_trades"] == 0 and got["price"] == 5


def test_trade_pages(trades):
    df = trades(
        ("2024-01-01T00:00:01.100", 1, 1, 1, "BUY"),
        ("2024-01-01T00:00:01.200", 2, 1, 1, "BUY"),
        ("2024-01-01T00:00:02", 1, 1, 1, "BUY"),
        ("2024-01-01T00:00:00", 9, 1, 1, "BUY"),
    )
    page = series.trades_after(df, F.lit("2024-01-01 00:00:01").cast("timestamp_ntz"), F.lit(1), 10)
    assert [(r["seq"], r["ts"].second) for r in page.collect()] == [(2, 1), (1, 2)]
    assert series.valid_trades(df.withColumn("price", F.col("price") - 1)).count() == 0
    assert series.unique_trades(df.unionByName(df), KEYS).count() == 3


def test_groups(trades):
    df = series.candles(trades(("2024-01-01T00:00:01", 1, 1, 1, "BUY")), KEYS, "1d")
    assert series.select_groups(df, ["ID", "OHLC"]).columns == [*KEYS, "datetime", "open", "high", "low", "close"]
    assert series.select_groups(df).columns == df.columns
    with pytest.raises(ValueError):
        series.select_groups(df, ["BOOK"])


def test_metric_ranks_match_window_rank(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 500 / 3).alias("x"),
    )
    want = df.withColumn("x_rank", F.rank().over(Window.orderBy(F.col("x").desc_nulls_last())).cast("bigint"))
    got = ranking.metric_ranks(df, ["x"])
    assert got.orderBy("id").collect() == want.orderBy("id").collect()
    assert ranking.metric_ranks(df.where("false"), ["x"]).count() == 0
    assert ranking.metric_ranks(df.where("x is null"), ["x"]).select("x_rank").distinct().collect()[0][0] == 1
    # types side by side, beyond what a double can tell apart
    exact = df.select(
        "id",
        "x",
        (F.lit(2**60) - F.col("id") % 40).alias("big"),
        F.col("id").cast("string").alias("text"),
        (F.col("id") % 7).cast("decimal(30,10)").alias("amount"),
    )
    metrics = ["x", "big", "text", "amount"]
    want = exact
    for m in metrics:
        want = want.withColumn(f"{m}_rank", F.rank().over(Window.orderBy(F.col(m).desc_nulls_last())).cast("bigint"))
    got = ranking.metric_ranks(exact, metrics)
    assert got.orderBy("id").collect() == want.orderBy("id").collect()


def test_positions_use_no_window_over_rows(spark, capsys):
    df = spark.range(3000).select("id", (F.col("id") % 500).alias("x"), (F.col("id") % 77).alias("y"))
    ranking.metric_ranks(df, ["x", "y"]).explain()
    plan = capsys.readouterr().out
    above_window = [line for line in plan.splitlines() if "Window" in line]
    assert above_window and all("range_" in line or "in_range_" in line for line in above_window)


def test_pages(spark):
    df = spark.range(50).select("id", (F.col("id") % 5).alias("v"))
    got = ranking.ranked_page(df, "v", ["id"], page=2, page_size=4, descending=False)
    assert [(r["position"], r["id"]) for r in got.orderBy("position").collect()] == [(5, 20), (6, 25), (7, 30), (8, 35)]
    with pytest.raises(ValueError):
        ranking.ranked_page(df, "v", ["id"], page_size=0)
    # every page against the whole list: nulls, repeated rows, a hot value, both directions
    mixed = spark.range(60).select(
        F.when(F.col("id") % 4 == 0, 1.5).when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 6 / 1.0).alias("v"),
        F.when(F.col("id") % 13 != 0, (F.col("id") % 10).cast("string")).alias("t"),
        F.timestamp_seconds(F.col("id") % 17).cast("timestamp_ntz").alias("at"),
    )
    for descending in (True, False):
        by = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
        whole = [tuple(r) for r in mixed.orderBy(by, "t", "at").collect()]
        for page in (1, 2, 5, 9, 10):
            got = ranking.ranked_page(mixed, "v", ["t", "at"], page, 7, descending).orderBy("position").collect()
            assert [tuple(r)[:3] for r in got] == whole[(page - 1) * 7 : page * 7]
            assert [r["position"] for r in got] == list(range(page * 7 - 6, min(page * 7, 60) + 1))
    assert ranking.first_n(df, ["id"], None).count() == 50
