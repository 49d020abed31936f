import pytest
from pyspark.sql import functions as F

from moments import at
from marketlake import schemas as S
from marketlake.operators import checks, fetchplan, maintain
from marketlake.operators.latest import last_n_points, latest_per_key
from marketlake.session import shared_path


def test_latest_per_key_ties_and_nulls(rows):
    df = rows(
        [("a", None, 9), ("a", 1, 1), ("a", 1, 2), (None, 5, 1), (None, 4, 2), ("c", None, 1)],
        "k string, ts int, tie int",
    )
    got = latest_per_key(df, ["k"], ["ts", "tie"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(None, 5, 1), ("a", 1, 2), ("c", None, 1)]


def test_hot_key_is_limited_before_the_shuffle(spark):
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    df = latest_per_key(hot, ["k"], ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert df.where("k = 1").collect()[0]["id"] == 29997
    assert df.count() == hot.select("k").distinct().count()


def test_last_n_points_of_a_hot_key(spark):
    """100,000 of the 300,000 rows of one key: whole keys are ranked nowhere, and old days leave before the shuffle."""
    df = spark.range(301_000).select(
        F.when(F.col("id") < 300_000, "hot").when(F.col("id") < 300_500, F.lit(None)).otherwise("cold").alias("rank"),
        F.when(F.col("id") % 1000 != 1, F.timestamp_seconds(F.col("id") * 60)).alias("ts"),
        F.col("id").alias("room"),
    )
    got = last_n_points(df, ["rank"], "ts", 100_000, ties=["room"])
    counts = {r["rank"]: (r["n"], r["low"]) for r in got.groupBy("rank").agg(F.count("*").alias("n"), F.min("ts").alias("low")).collect()}
    # one row in a thousand has no time and counts as oldest
    low = df.where("rank = 'hot' and ts is not null").orderBy(F.col("ts").desc()).limit(100_000).agg(F.min("ts")).first()[0]
    assert counts == {"hot": (100_000, low), None: (500, counts[None][1]), "cold": (500, counts["cold"][1])}
    assert got.columns == df.columns and got.select("room").distinct().count() == 101_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    ranking = next(line for line in plan.splitlines() if "row_number()" in line and "Window" in line)
    assert "block" in ranking.split("windowspecdefinition(")[1].split("ts")[0]


def test_last_n_points_upto(rows):
    df = rows([("a", i) for i in range(10)], "k string, ts int")
    got = last_n_points(df, ["k"], "ts", 3, F.lit(7)).orderBy("ts").collect()
    assert [r["ts"] for r in got] == [5, 6, 7]


def test_upsert_duplicates_nulls_and_empty(rows):
    ddl = "k string, d string, v int, at int"
    existing = rows([("a", "x", 1, 0), ("b", "x", 2, 0), (None, "x", 3, 0)], ddl)
    incoming = rows([("a", "x", 10, 1), ("a", "x", 11, 2), (None, "x", 30, 1), ("c", "x", 4, 1)], ddl)
    got = maintain.upsert(existing, incoming, ["k", "d"], ["at"]).orderBy("v").collect()
    assert [(r["k"], r["v"]) for r in got] == [("b", 2), ("c", 4), ("a", 11), (None, 30)]
    same = maintain.upsert(existing, incoming.where("false"), ["k", "d"], ["at"])
    assert same.count() == 3


def test_upsert_table_touches_only_its_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k int, d string, v int"
    maintain.append(rows([(1, "x", 1), (2, "y", 1), (3, "z", 1)], ddl), path, ["d"])
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=y").glob("*.parquet")}
    maintain.upsert_table(rows([(1, "x", 9), (4, "x", 9), (5, "w", 9)], ddl), path, ["k", "d"], ["v"], ["d"])
    got = spark.read.parquet(path).select("k", "d", "v").orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "x", 9), (2, "y", 1), (3, "z", 1), (4, "x", 9), (5, "w", 9)]
    assert before == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=y").glob("*.parquet")}
    assert not list(tmp_path.glob("t.staged*"))


def test_partition_names_keep_their_type(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k int, d string, v int"
    for v in (1, 2):
        maintain.upsert_table(rows([(1, "001", v), (2, "1", v)], ddl), path, ["k", "d"], ["v"], ["d"])
    assert sorted(p.name for p in (tmp_path / "t").glob("d=*")) == ["d=001", "d=1"]
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [2, 2]


def test_heavy_partition_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(300000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 5)).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        maintain.upsert_table(df, path, ["k", "d"], ["v"], ["d"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "d=hot").glob("*.parquet"))) > 1
    assert len(list((tmp_path / "t" / "d=d1").glob("*.parquet"))) == 1
    assert spark.read.parquet(path).count() == 300000


def test_create_and_deduplicate_catalog_table(spark, tmp_path):
    name = "series_dedup"
    S.create_table(spark, "futures_funding_rate_ohlc_1d", name, str(tmp_path / "v1"))
    columns = S.TABLES["futures_funding_rate_ohlc_1d"].names
    assert spark.table(name).columns == [*columns, "date"]
    base = spark.sql(
        "SELECT timestamp_ntz'2024-01-01' AS datetime, 'm' AS market, 'i' AS mapped_instrument, "
        "timestamp_ntz'2024-01-02' AS collected_at, 1.0D AS open_fr UNION ALL "
        "SELECT timestamp_ntz'2024-01-01', 'm', 'i', timestamp_ntz'2024-01-03', 2.0D"
    ).withColumn("date", F.to_date("datetime"))
    types = dict(spark.table(name).dtypes)
    full = base.select(
        *[(F.col(c) if c in base.columns else F.lit(None)).cast(types[c]).alias(c) for c in spark.table(name).columns]
    )
    full.write.insertInto(name)
    maintain.deduplicate_table(
        spark, name, ["datetime", "market", "mapped_instrument"], ["collected_at"], str(tmp_path / "v2")
    )
    assert [r["open_fr"] for r in spark.table(name).collect()] == [2.0]


def test_all_tables_have_valid_ddl(spark, tmp_path):
    assert len(S.TABLES) == 26
    for table, spec in S.TABLES.items():
        assert spec.schema.names == spec.names
        assert set(spec.key) <= set(spec.names)
        S.create_table(spark, table, f"ddl_{table}", str(tmp_path / table))
        assert spark.table(f"ddl_{table}").columns[: len(spec.names)] == spec.names
    assert "market" in S.required_columns("futures_ohlcv_1m")


def test_export_import_zero_dates(spark, rows):
    df = rows([(1, "0000-00-00 00:00:00"), (2, "2024-01-02 03:04:05"), (3, None)], "id int, first_trade_timestamp string")
    text = maintain.timestamps_to_text(df, ["first_trade_timestamp"])
    assert text.columns == ["id", "first_trade_timestamp_str"]
    back = maintain.text_to_timestamps(text).orderBy("id").collect()
    assert [r["first_trade_timestamp"] for r in back] == [None, at("2024-01-02T03:04:05"), None]


def test_hot_chunk_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(20000).select("id", F.when(F.col("id") < 15000, "hot").otherwise("cold").alias("chunk_start"))
    maintain.export_chunks(df, str(tmp_path / "e"), ["id"], partitions=4)
    assert len(list((tmp_path / "e" / "chunk_start=hot").glob("*.parquet"))) >= 3
    assert spark.read.parquet(str(tmp_path / "e")).count() == 20000


def test_csv_nulls_and_quotes(spark, rows, tmp_path):
    from marketlake.sources import read_csv

    df = rows([(1, 'say "hi", ok'), (2, None)], "id int, text string")
    maintain.write_csv(df, str(tmp_path / "c"), ["text", "id"])
    raw = sorted(line for p in (tmp_path / "c").glob("*.csv") for line in p.read_text().splitlines())
    assert raw == ['"say ""hi"", ok",1', ",2"]
    back = read_csv(spark, str(tmp_path / "c"), "text string, id int", header=False)
    assert sorted(back.collect(), key=lambda r: r["id"])[1]["text"] is None


def test_checks(rows):
    df = rows([(1, "a", 5), (1, "a", None), (2, None, 7)], "k int, s string, v int")
    assert [tuple(r) for r in checks.duplicate_keys(df, ["k", "s"]).collect()] == [(1, "a", 2)]
    nulls = {r["column_name"]: r["nulls"] for r in checks.null_counts(df, ["k", "s", "v"]).collect()}
    assert nulls == {"k": 0, "s": 1, "v": 1}
    prof = {r["column_name"]: (r["nulls"], r["min_value"], r["max_value"]) for r in checks.profile(df, ["v", "s"]).collect()}
    assert prof == {"v": (1, "5", "7"), "s": (1, "a", "a")}
    got = checks.reconcile(df, df.where("k = 1"), ["k"]).orderBy("k").collect()
    assert [(r["k"], r["missing_rows"], r["matches"]) for r in got] == [(1, 0, True), (2, 1, False)]


def test_chunks_boundaries(spark, rows):
    days = [("2024-01-01",), ("2024-01-30",), ("2024-01-31",), ("2024-03-01",)]
    df = rows(days, "s string").select(F.col("s").cast("timestamp_ntz").alias("datetime"))
    got = fetchplan.chunk_counts(df, 30).orderBy("chunk").collect()
    # 2024-03-01 is exactly 60 days after the start: it opens a last chunk of one second
    assert [(str(r["chunk_start"]), str(r["chunk_end"]), r["rows"]) for r in got] == [
        ("2024-01-01 00:00:00", "2024-01-31 00:00:00", 2),
        ("2024-01-31 00:00:00", "2024-03-01 00:00:00", 1),
        ("2024-03-01 00:00:00", "2024-03-01 00:00:01", 1),
    ]
    assert fetchplan.chunk_counts(df.where("false"), 30).count() == 0


def test_fetch_plan_cases(spark, rows):
    instruments = rows(
        [
            ("m", "seen", None, None, "ACTIVE"),
            ("m", "new", "2024-01-30 22:00:00", None, "ACTIVE"),
            ("m", "blank", None, None, "ACTIVE"),
            ("m", "ended", "2024-01-01 00:00:00", "2024-01-01 02:30:00", "EXPIRED"),
            ("m", "fresh", None, None, "ACTIVE"),
        ],
        "market string, mapped_instrument string, f string, l string, status string",
    ).select(
        "market",
        "mapped_instrument",
        F.col("f").cast("timestamp_ntz").alias("first_update"),
        F.col("l").cast("timestamp_ntz").alias("last_update"),
        "status",
    )
    stored = rows(
        [("m", "seen", "2024-01-31 05:00:00"), ("m", "fresh", "2024-01-31 09:00:00")],
        "market string, mapped_instrument string, d string",
    ).select("market", "mapped_instrument", F.col("d").cast("timestamp_ntz").alias("datetime"))
    now = F.lit("2024-01-31 10:15:00")
    got = fetchplan.fetch_plan(instruments, stored, "1h", now, max_points=6).collect()
    plan = {}
    for r in sorted(got, key=lambda r: r["batch"]):
        plan.setdefault(r["mapped_instrument"], []).append((str(r["batch_start"]), str(r["batch_end"]), r["points"]))
    assert plan["seen"] == [("2024-01-31 06:00:00", "2024-01-31 09:00:00", 4)]
    assert plan["new"] == [
        ("2024-01-30 22:00:00", "2024-01-31 03:00:00", 6),
        ("2024-01-31 04:00:00", "2024-01-31 09:00:00", 6),
    ]
    assert plan["ended"] == [("2024-01-01 00:00:00", "2024-01-01 02:00:00", 3)]
    # without any bound: midnight, six days back
    assert plan["blank"][0][0] == "2024-01-25 00:00:00" and sum(p[2] for p in plan["blank"]) == 154
    # the truncated hour count of an up-to-date series is 0, so its last period is asked for again
    assert plan["fresh"] == [("2024-01-31 10:00:00", "2024-01-31 09:59:59", 1)]


def test_shared_path_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_path(spark, "x")
    if configured:
        assert path.startswith(configured.rstrip("/"))
    assert path != shared_path(spark, "x")


@pytest.mark.parametrize("n", [0, -1])
def test_aggregate_bounds(rows, n):
    from marketlake.operators.series import reaggregate

    with pytest.raises(ValueError):
        reaggregate(rows([], "k string, datetime timestamp_ntz"), ["k"], "1h", n)


def test_export_keeps_microseconds_and_other_text(rows):
    from marketlake.operators import maintain

    df = rows(
        [(1, at("2024-01-01T00:00:00.123456"), "x"), (2, at("2024-01-02T00:00:00"), None)],
        "id int, datetime timestamp_ntz, note_str string",
    )
    text = maintain.timestamps_to_text(df, ["datetime"])
    back = maintain.text_to_timestamps(text, columns=df.columns).orderBy("id").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.orderBy("id").collect()]
    with pytest.raises(Exception, match="no timestamp"):
        maintain.text_to_timestamps(text).collect()


class Stop(Exception):
    pass


@pytest.mark.parametrize("partition_by", [[], ["day"]])
@pytest.mark.parametrize("step", ["before the commit", "before moving in", "between two folders", "before the release"])
def test_upsert_stopped_between_steps(spark, rows, tmp_path, monkeypatch, partition_by, step):
    """Whatever step a job stops at, readers find the old or the new table, and the next writer goes on."""
    path = str(tmp_path / "t")
    ddl = "id int, v string, at int, day string"
    old = [(i, "old", 1, f"d {i % 4}") for i in range(8)]
    new = [(i, "new", 2, f"d {i % 4}") for i in (0, 1, 2, 9)]
    maintain.upsert_table(rows(old, ddl), path, ["id", "day"], ["at"], partition_by)

    moved = []

    def stop(*_, **__):
        raise Stop

    def rename(spark_, source, target, real=maintain._rename):
        if "/merged" in source:
            moved.append(target)
            if len(moved) == (2 if partition_by else 1):
                raise Stop  # the folder to be replaced is gone by now
        return real(spark_, source, target)

    with monkeypatch.context() as patch:
        name = {"before the commit": "_commit", "before moving in": "_move_in", "before the release": "_write_note"}
        if step == "between two folders":
            patch.setattr(maintain, "_rename", rename)
        elif step == "before the release":
            real = maintain._write_note
            patch.setattr(
                maintain, "_write_note", lambda s, p, n: stop() if ".batches" in p else real(s, p, n)
            )
        else:
            patch.setattr(maintain, name[step], stop)
        with pytest.raises(Stop):
            maintain.upsert_table(rows(new, ddl), path, ["id", "day"], ["at"], partition_by, ("s", 3))

    def held():
        table = maintain.read_table(spark, path).select("id", "v", "at", "day")
        return sorted(map(tuple, table.collect()))

    merged = sorted({**{r[0]: r for r in old}, **{r[0]: r for r in new}}.values())
    done = step != "before the commit"
    assert held() == (merged if done else sorted(old))
    assert maintain.last_batch(spark, path, "s") == (3 if done else -1)
    maintain.upsert_table(rows([(20, "more", 3, "d 1")], ddl), path, ["id", "day"], ["at"], partition_by)
    assert held() == sorted([*(merged if done else old), (20, "more", 3, "d 1")])
    assert maintain.last_batch(spark, path, "s") == (3 if done else -1)
    assert sorted(p.name for p in tmp_path.iterdir() if "pending" in p.name or "staged" in p.name) == []


def test_published_table_changes_in_one_step(spark, rows, tmp_path, monkeypatch):
    ddl = "id int, at int, part string"
    maintain.publish_table(spark, "shown_parts", rows([(1, 1, "a"), (1, 2, "a"), (2, 1, "b")], ddl), f"{tmp_path}/v1", ["part"])

    def held():
        return sorted(map(tuple, spark.table("shown_parts").collect()))

    before = held()
    with monkeypatch.context() as patch:
        # everything but the last step is done: partitions included
        patch.setattr(maintain, "publish_table", lambda s, n, r, p, by: maintain._write_version(s, n, r, p, by))
        maintain.deduplicate_table(spark, "shown_parts", ["id"], ["at"], f"{tmp_path}/v2")
    assert held() == before
    maintain.deduplicate_table(spark, "shown_parts", ["id"], ["at"], f"{tmp_path}/v3")
    assert held() == [(1, 2, "a"), (2, 1, "b")]
    maintain.migrate_table(spark, "shown_parts", ["at"], f"{tmp_path}/v4")
    assert dict(spark.table("shown_parts").dtypes)["at"] == "timestamp_ntz"


def test_stream_ledger(spark, rows, tmp_path):
    """A batch delivered again is not applied; an empty batch is only noted."""
    path = str(tmp_path / "t")
    write = maintain.upsert_batches(path, ["id"], ["at"], stream="s")
    write(rows([(1, 1)], "id int, at int"), 0)
    write(rows([(1, 2)], "id int, at int"), 0)
    write(rows([], "id int, at int"), 1)
    assert [tuple(r) for r in maintain.read_table(spark, path).collect()] == [(1, 1)]
    assert maintain.last_batch(spark, path, "s") == 1
