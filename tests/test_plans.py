from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from moments import at
from marketlake.operators import select
from marketlake.operators.select import top_assets
from marketlake.plans import linking, selection, transfer
from marketlake.plans.store import Store
from marketlake.schemas import TABLES
from marketlake.sources import conform_records, scan


def test_top_pairs(rows):
    assets = rows([(1, "BTC"), (2, "ETH"), (3, "XRP")], "asset_id bigint, symbol string")
    snapshots = rows(
        [(1, at("2024-01-01"), 900.0), (1, at("2024-01-02"), 5.0), (2, at("2024-01-01"), 50.0), (3, at("2024-01-01"), None)],
        "asset_id bigint, snapshot_ts timestamp_ntz, spot_moving_30_day_quote_volume_usd double",
    )
    top = top_assets(assets, snapshots, 2)
    assert [r["symbol"] for r in top.collect()] == ["ETH", "BTC"]
    exchanges = rows([("good", "AA"), ("also", "BB"), ("poor", "B"), ("none", None)], "internal_name string, grade string")
    instruments = rows(
        [("good", "ETH", "USD", 2, "ACTIVE"), ("good", "ETH", "EUR", 2, "RETIRED"), ("poor", "ETH", "USD", 2, "ACTIVE"),
         ("also", "XRP", "USD", 3, "ACTIVE"), ("also", "BTC", "USD", 1, "ACTIVE"), ("also", "BTC", "GBP", 77, "ACTIVE")],
        "exchange_internal_name string, base_asset_symbol string, quote_asset_symbol string, base_asset_id bigint, "
        "instrument_status_on_exchange string",
    )
    got = selection.top_pairs(assets, snapshots, exchanges, instruments, 2)
    assert sorted(map(tuple, got.collect())) == [("also", "BTC", "USD"), ("good", "ETH", "USD")]
    one = selection.top_pairs(assets, snapshots, exchanges, instruments, 2, exchange_limit=1)
    assert [tuple(r) for r in one.collect()] == [("also", "BTC", "USD")]
    assert selection.top_pairs(assets, snapshots, exchanges, instruments, 2, pair_limit=1).count() == 1


def test_collation_option(rows):
    df = rows([("a", "bbb"), ("b", "BBB"), ("c", "c")], "internal_name string, grade string")
    assert select.qualified_exchanges(df).count() == 1
    assert select.qualified_exchanges(df, "UTF8_LCASE").count() == 2


def test_filters_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-06"))
    plan = select.time_range(events, start, end, "ts").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_scan_binds_parameters(rows):
    df = rows([(1, "x"), (2, "y' OR '1'='1")], "k int, s string")
    got = scan(df.sparkSession, "SELECT k FROM {t} WHERE s = :s", {"s": "y' OR '1'='1"}, t=df)
    assert [r["k"] for r in got.collect()] == [2]


@pytest.fixture
def funding(rows):
    data = [(at("2024-01-01T00:00:00") + timedelta(hours=h), "m", f"i{k}", float(h)) for h in range(24 * 70) for k in range(2)]
    df = rows(data, "datetime timestamp_ntz, market string, mapped_instrument string, open_fr double")
    return conform_records(df.withColumn("collected_at", F.col("datetime")), "futures_funding_rate_ohlc_1h")


def test_transfer(spark, funding, tmp_path):
    report = transfer.transfer(spark, funding, str(tmp_path / "out"), str(tmp_path / "new"), 30)
    got = report.orderBy("chunk").collect()
    assert [(r["source_rows"], r["target_rows"], r["running_rows"]) for r in got] == [
        (1440, 1440, 1440), (1440, 1440, 2880), (480, 480, 3360)
    ]
    names = sorted(p.name for p in (tmp_path / "out").glob("chunk=*"))
    assert names == ["chunk=20240101_to_20240131", "chunk=20240131_to_20240301", "chunk=20240301_to_20240310"]
    back = spark.read.parquet(str(tmp_path / "new")).select(*funding.columns)
    assert back.exceptAll(funding).count() == 0 and back.count() == funding.count()


def test_transfer_of_a_range_reports_that_range(spark, funding, tmp_path):
    lo, hi = F.lit("2024-01-10"), F.lit("2024-01-12")
    report = transfer.transfer(spark, funding, str(tmp_path / "out"), str(tmp_path / "new"), 30, lo=lo, hi=hi)
    got = report.collect()
    assert [(r["source_rows"], r["missing_rows"]) for r in got] == [(2 * 49, 0)]


def test_coin_map_is_stored(spark, rows, tmp_path):
    store = Store(str(tmp_path / "store"))
    assets = rows([(1, "BTC", "Bitcoin"), (2, "QQ", "Nothing")], "asset_id bigint, symbol string, name string")
    stamped = assets.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    store.upsert(conform_records(stamped, "assets"), "assets")
    coins = rows([("c", "BTC", "Bitcoin", None, None)], "coin_uid string, ticker string, name string, coingecko_id string, coinmarketcap_id string")
    mapping = linking.refresh_coin_map(spark, store, coins, F.lit("2024-02-01"))
    assert mapping.count() == 2
    assert [(r["asset_id"], r["coin_uid"]) for r in store.read(spark, "asset_coin_uid_map").collect()] == [(1, "c")]


def test_hot_join_key_is_split(spark):
    """A symbol held by most assets is looked up by several tasks."""
    from marketlake.operators import link

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assets = spark.range(0, 200000, 1, 8).selectExpr(
            "id as asset_id", "if(id % 3 > 0, 'HOT', concat('s', id)) as symbol", "sha2(cast(id as string), 256) as name"
        )
        coins = spark.range(5000).selectExpr("concat('c', id) as coin_uid", "if(id = 7, 'HOT', concat('s', id)) as ticker")
        out = link._lookup(assets, F.col("symbol"), coins, F.col("ticker"), "hit")
        parts = out.groupBy(F.spark_partition_id(), "hit").agg(F.count("name").alias("n"), F.max("name"))
        sizes = [r["n"] for r in parts.where("hit = 'c7'").collect()]
        assert sum(sizes) == 200000 - 66667 and len(sizes) > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_shuffles_lie_directly_below_a_lookup_join(spark, rows):
    """With an aggregated lookup side, AQE still sees both shuffles of the join."""
    from marketlake.operators.fetchplan import newer_than_stored

    df = rows([("m", "i", at("2024-01-01"), 1)], "market string, mapped_instrument string, datetime timestamp_ntz, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = newer_than_stored(df, df, ["market", "mapped_instrument"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = plan.split("SortMergeJoin")[1]
        assert "tag_" in below.split("\n")[0]
        assert below.count("Exchange hashpartitioning(market") == 3  # both sides of the join and the aggregate
        assert out.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_missing_keys(rows):
    from marketlake.operators.lookup import lookup

    left = rows([(1, "a", None), (2, None, "b"), (3, "a", "b"), (4, "z", "b")], "id int, k string, l string")
    right = rows([("a", "b", 9), (None, "b", 7)], "k string, l string, v int")
    got = lookup(left, right, ["k", "l"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a", None, None), (2, None, "b", None), (3, "a", "b", 9), (4, "z", "b", None)]


def test_range_read_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from marketlake.plans.store import Store
    from marketlake.schemas import TABLES

    spec, store = TABLES["futures_ohlcv_1m"], Store(str(tmp_path))
    day = F.timestamp_seconds(F.col("id") * 86_400 + 1_700_000_000).cast("timestamp_ntz")
    columns = [day.alias(f.name) if f.name == spec.partition_source else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    store.append(spark.range(5).select(*columns), "futures_ohlcv_1m")
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2023-11-15 22:13:20", "2023-11-16 23:00:00"))
    found = store.read(spark, "futures_ohlcv_1m", start, end)
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert store.read(spark, "futures_ohlcv_1m").count() == 5


def test_marks_spare_the_series(spark, rows, tmp_path):
    """Plans and batches read the marks of a series, not its folders."""
    store = Store(str(tmp_path))
    spec = TABLES["futures_ohlcv_1h"]

    def bars(data):
        given = rows(data, "datetime timestamp_ntz, market string, mapped_instrument string, collected_at timestamp_ntz")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields if f.name not in given.columns]
        return given.select("*", *empty)

    now = at("2024-05-01 00:00:00")
    store.upsert(bars([(at("2024-03-01 05:00:00"), "m", "a", now), (at("2024-04-01 01:00:00"), "m", "b", now)]), "futures_ohlcv_1h")
    store.upsert(bars([(at("2024-02-01 05:00:00"), "m", "a", now), (at("2024-04-02 01:00:00"), "m", "c", now)]), "futures_ohlcv_1h")
    marks = store.marks(spark, "futures_ohlcv_1h")
    assert sorted((r.mapped_instrument, r.datetime) for r in marks.collect()) == [
        ("a", at("2024-03-01 05:00:00")),
        ("b", at("2024-04-01 01:00:00")),
        ("c", at("2024-04-02 01:00:00")),
    ]
    files = marks.inputFiles()
    assert files and all(".marks/" in f for f in files)
    with pytest.raises(ValueError):
        store.marks(spark, "assets")


def test_marks_of_a_series_stored_before(spark, rows, tmp_path):
    store = Store(str(tmp_path))
    assert store.marks(spark, "futures_ohlcv_1d").count() == 0


def test_transfer_of_a_stored_range_opens_its_folders_only(spark, funding, tmp_path, capsys):
    store = Store(str(tmp_path / "store"))
    table = "futures_funding_rate_ohlc_1h"
    store.upsert(funding, table)
    start, end = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")
    report = transfer.transfer_stored(spark, store, table, str(tmp_path / "out"), str(tmp_path / "new"), start, end, 30)
    assert [(r["source_rows"], r["missing_rows"]) for r in report.collect()] == [(2 * 49, 0)]
    report.explain("formatted")
    assert "PartitionFilters: [isnotnull(date" in capsys.readouterr().out


def test_newest_record(rows):
    from marketlake.operators import checks

    batch = rows([(1, 5, None), (2, 7, "a"), (3, 7, "b"), (4, None, "z")], "id int, ts bigint, note string")
    assert [tuple(r) for r in checks.newest_record(batch, "ts", ["note"]).collect()] == [(3, 7, "b")]
    assert checks.newest_record(batch.where("false"), "ts").collect() == []
