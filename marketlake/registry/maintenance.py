"""Dedup, upsert, append, checks, chunks, exports and imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake.operators import checks, fetchplan, maintain
from marketlake.operators.latest import concat, drop_repeated_boundaries, latest_per_key
from marketlake.plans.transfer import export_series, import_series, transfer, transfer_stored
from marketlake.plans.store import Store
from marketlake.registry.base import Tables, register, rounded
from marketlake.session import shared_path
from marketlake.schemas import TABLES
from marketlake.sources import conform_records, read_csv, read_json_records, read_parquet

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINE_LATEST_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEYS)}
            ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1
"""


@register("latest_per_key", LINE_LATEST_SQL)
def _latest(t: Tables) -> DataFrame:
    return latest_per_key(t.lineitem, LINE_KEYS, LINE_ORDER)


@register(
    "dup_keys",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS copies FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def _dup_keys(t: Tables) -> DataFrame:
    return checks.duplicate_keys(t.lineitem, LINE_KEYS)


PROFILE_COLUMNS = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_suppkey"]


@register(
    "profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS nulls, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem"
        for c in PROFILE_COLUMNS
    ),
)
def _profile(t: Tables) -> DataFrame:
    return checks.profile(t.lineitem, PROFILE_COLUMNS)


@register(
    "required_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (nullif({c}, {v}) IS NULL) AS BIGINT) AS nulls FROM orders"
        for c, v in (("o_custkey", "7"), ("o_orderstatus", "'P'"), ("o_orderpriority", "'5-LOW'"))
    ),
)
def _required(t: Tables) -> DataFrame:
    with_nulls = t.orders.select(
        F.nullif("o_custkey", F.lit(7)).alias("o_custkey"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return checks.null_counts(with_nulls, with_nulls.columns)


@register(
    "series_bounds",
    "SELECT min(ts) AS min_ts, max(ts) AS max_ts, CAST(count(*) AS BIGINT) AS rows FROM events",
)
def _bounds(t: Tables) -> DataFrame:
    return checks.series_bounds(t.events, "ts")


@register("newest_record", "SELECT * FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 1")
def _newest_record(t: Tables) -> DataFrame:
    return checks.newest_record(t.events, "ts", ["event_id"])


@register(
    "reconcile",
    f"""WITH d AS ({LINE_LATEST_SQL}),
    s AS (SELECT date_trunc('month', l_shipdate) AS month, count(*) AS n FROM lineitem GROUP BY 1),
    g AS (SELECT date_trunc('month', l_shipdate) AS month, count(*) AS n FROM d GROUP BY 1)
    SELECT CAST(month AS TIMESTAMP) AS month, CAST(coalesce(s.n, 0) AS BIGINT) AS source_rows,
           CAST(coalesce(g.n, 0) AS BIGINT) AS target_rows,
           CAST(coalesce(s.n, 0) - coalesce(g.n, 0) AS BIGINT) AS missing_rows,
           coalesce(s.n, 0) = coalesce(g.n, 0) AS matches
    FROM s FULL JOIN g USING (month)""",
)
def _reconcile(t: Tables) -> DataFrame:
    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    source = t.lineitem.withColumn("month", month)
    target = latest_per_key(t.lineitem, LINE_KEYS, LINE_ORDER).withColumn("month", month)
    return checks.reconcile(source, target, ["month"])


@register(
    "reconcile_totals",
    f"""WITH d AS ({LINE_LATEST_SQL})
    SELECT CAST((SELECT count(*) FROM lineitem) AS BIGINT) AS source_rows,
           CAST((SELECT count(*) FROM d) AS BIGINT) AS target_rows,
           CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM d) AS BIGINT) AS missing_rows""",
)
def _reconcile_totals(t: Tables) -> DataFrame:
    return checks.reconcile_totals(t.lineitem, latest_per_key(t.lineitem, LINE_KEYS, LINE_ORDER))


@register(
    "status_counts",
    """SELECT o_orderpriority, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS f_count,
       CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS o_count,
       CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS p_count,
       CAST(count(*) AS BIGINT) AS total_count FROM orders GROUP BY 1""",
)
def _status_counts(t: Tables) -> DataFrame:
    return checks.status_counts(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])


def _updates(t: Tables) -> DataFrame:
    """Every customer in two updates; every order's customer number shifted past the known ones."""
    known = t.customer.where("c_acctbal < 5000").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        (F.col("c_acctbal") + 100).alias("c_acctbal"),
        "c_mktsegment",
    )
    later = known.withColumn("c_acctbal", F.col("c_acctbal") * 2).where("c_nationkey < 12")
    unseen = t.orders.select(
        (F.col("o_custkey") + 1_000_000_000).alias("c_custkey"),
        F.concat(F.lit("new "), "o_orderstatus").alias("c_name"),
        F.lit(1).alias("c_nationkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.lit("BUILDING").alias("c_mktsegment"),
    )
    return concat([known.withColumn("v", F.lit(1)), later.withColumn("v", F.lit(2)), unseen.withColumn("v", F.lit(1))])


UPSERT_SQL = """
WITH known AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
               FROM customer WHERE c_acctbal < 5000),
incoming AS (
  SELECT *, 1 AS v FROM known
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal * 2, c_mktsegment, 2 FROM known WHERE c_nationkey < 12
  UNION ALL SELECT o_custkey + 1000000000, 'new ' || o_orderstatus, 1, o_totalprice, 'BUILDING', 1 FROM orders),
fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey
            ORDER BY v DESC, c_acctbal DESC, c_name DESC) AS rn FROM incoming) WHERE rn = 1)
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 4) AS c_acctbal, c_mktsegment, v FROM (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 0 AS v FROM customer
  WHERE c_custkey NOT IN (SELECT c_custkey FROM fresh)
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, v FROM fresh)
"""
UPSERT_LATEST = ["v", "c_acctbal", "c_name"]


@register("upsert", UPSERT_SQL)
def _upsert(t: Tables) -> DataFrame:
    existing = t.customer.withColumn("v", F.lit(0))
    return rounded(maintain.upsert(existing, _updates(t), ["c_custkey"], UPSERT_LATEST))


@register("upsert_table", UPSERT_SQL)
def _upsert_table(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "upsert")
    maintain.append(t.customer.withColumn("v", F.lit(0)), path)
    maintain.upsert_table(_updates(t), path, ["c_custkey"], UPSERT_LATEST)
    return rounded(t.spark.read.parquet(path))


@register(
    "upsert_partitions",
    """WITH incoming AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice,
                         o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')
       SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, o_orderdate,
              o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS y
       FROM (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)
             UNION ALL SELECT * FROM incoming)""",
)
def _upsert_partitions(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "upsert-partitions")
    dated = t.orders.withColumn("y", F.year("o_orderdate"))
    maintain.append(dated, path, ["y"])
    incoming = dated.where("o_orderdate >= timestamp_ntz'2000-01-01'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}
    )
    maintain.upsert_table(incoming, path, ["o_orderkey"], ["o_orderdate"], ["y"])
    return rounded(t.spark.read.parquet(path))


@register(
    "append_union",
    """SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01'
       UNION SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def _append_union(t: Tables) -> DataFrame:
    pages = [
        t.orders.where("o_orderdate < timestamp_ntz'1998-07-01'"),
        t.orders.where("o_orderdate >= timestamp_ntz'1998-01-01'"),
    ]
    return drop_repeated_boundaries(pages, ["o_orderkey"])


@register("append_table", "SELECT * FROM nation UNION ALL SELECT * FROM nation")
def _append_table(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "append")
    for _ in range(2):
        maintain.append(t.nation, path)
    return t.spark.read.parquet(path)


@register("dedup_swap", LINE_LATEST_SQL)
def _dedup_swap(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "dedup")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    t.lineitem.write.parquet(f"{path}/v1")
    t.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}/v1'")
    maintain.deduplicate_table(t.spark, name, LINE_KEYS, LINE_ORDER, f"{path}/v2")
    return t.spark.table(name)


@register("dedup_swap_partitioned", LINE_LATEST_SQL)
def _dedup_swap_partitioned(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "dedup_parts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    maintain.publish_table(t.spark, name, t.lineitem, f"{path}/v1", ["l_returnflag"])
    maintain.deduplicate_table(t.spark, name, LINE_KEYS, LINE_ORDER, f"{path}/v2")
    return t.spark.table(name)


@register(
    "migrate_swap",
    """SELECT event_id, event_type, CASE WHEN event_type <> 'view'
         THEN to_timestamp(CAST(floor(epoch(ts)) AS BIGINT)) AT TIME ZONE 'UTC' END AS seen FROM events""",
)
def _migrate_swap(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "migrated")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    raw = t.events.select("event_id", "event_type", F.when(F.col("event_type") != "view", seconds).alias("seen"))
    maintain.publish_table(t.spark, name, raw, f"{path}/v1", ["event_type"])
    maintain.migrate_table(t.spark, name, ["seen"], f"{path}/v2")
    return t.spark.table(name)


@register(
    "csv_roundtrip",
    "SELECT o_orderdate, o_orderkey, o_orderpriority, o_totalprice FROM orders",
)
def _csv_roundtrip(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "csv")
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"]
    maintain.write_csv(t.orders, path, columns)
    ddl = "o_orderkey bigint, o_orderpriority string, o_totalprice double, o_orderdate timestamp_ntz"
    return read_csv(t.spark, path, ddl, header=False)


@register(
    "typed_records",
    """SELECT c_custkey AS asset_id, c_name AS symbol, CAST(NULL AS VARCHAR) AS coin_uid,
       c_mktsegment AS match_type, c_acctbal AS match_score, CAST(NULL AS TIMESTAMP) AS mapped_at FROM customer""",
)
def _typed_records(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "records")
    t.customer.select(
        F.col("c_acctbal").alias("match_score"),
        F.col("c_mktsegment").alias("match_type"),
        F.col("c_name").alias("symbol"),
        F.col("c_custkey").alias("asset_id"),
    ).write.json(path)
    ddl = "match_score double, match_type string, symbol string, asset_id bigint"
    return conform_records(read_json_records(t.spark, path, ddl), "asset_coin_uid_map")


@register("inferred_records", "SELECT * FROM region")
def _inferred_records(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "inferred")
    t.region.write.json(path)
    return read_json_records(t.spark, path).select(F.col("r_regionkey").cast("int"), "r_name")


@register(
    "epoch_migration",
    """SELECT event_id, CAST(to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' AS TIMESTAMP) AS first_trade_timestamp,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE CAST(to_timestamp(floor(epoch(ts)) + user_id) AT TIME ZONE 'UTC' AS TIMESTAMP) END AS last_trade_timestamp,
       value FROM events""",
)
def _epoch_migration(t: Tables) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    stored = t.events.select(
        "event_id",
        seconds.alias("first_trade_timestamp"),
        F.when(F.col("event_type") != "error", seconds + F.col("user_id")).alias("last_trade_timestamp"),
        "value",
    )
    return maintain.migrate_epochs(stored, ["first_trade_timestamp", "last_trade_timestamp"])


CHUNKS_SQL = """
b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
chunks AS (
  SELECT CAST(i AS BIGINT) AS chunk, lo + to_days(CAST(30 * i AS INTEGER)) AS chunk_start,
         CASE WHEN lo + to_days(CAST(30 * (i + 1) AS INTEGER)) > hi THEN hi + INTERVAL 1 SECOND
              ELSE lo + to_days(CAST(30 * (i + 1) AS INTEGER)) END AS chunk_end
  FROM b, range(0, 1000) r(i) WHERE lo + to_days(CAST(30 * i AS INTEGER)) <= hi),
counted AS (
  SELECT chunk, chunk_start, chunk_end, CAST(count(o_orderkey) AS BIGINT) AS rows
  FROM chunks LEFT JOIN orders ON o_orderdate >= chunk_start AND o_orderdate < chunk_end GROUP BY ALL)
"""


@register("date_chunks", f"WITH {CHUNKS_SQL} SELECT * FROM counted")
def _date_chunks(t: Tables) -> DataFrame:
    return fetchplan.chunk_counts(t.orders, 30, "o_orderdate")


@register(
    "running_totals",
    f"""WITH {CHUNKS_SQL}
    SELECT *, CAST(sum(rows) OVER (ORDER BY chunk) AS BIGINT) AS running_rows FROM counted WHERE rows > 0""",
)
def _running_totals(t: Tables) -> DataFrame:
    chunked = fetchplan.assign_chunks(t.orders, 30, "o_orderdate")
    return checks.running_totals(chunked, ["chunk_start", "chunk_end"], "chunk")


@register("chunk_export_import", "SELECT * FROM orders")
def _export_import(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "export")
    export_series(t.orders, path, 90, ["o_orderdate", "o_orderkey"])
    return import_series(t.spark, path, t.orders.columns)


@register("parquet_scan", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _parquet_scan(t: Tables) -> DataFrame:
    return read_parquet(t.spark, t.path("part"), "p_partkey bigint, p_name string, p_retailprice double")


@register(
    "transfer_report",
    f"""WITH {CHUNKS_SQL}
    SELECT chunk, chunk_start, chunk_end, rows AS source_rows, rows AS target_rows, CAST(0 AS BIGINT) AS missing_rows,
           true AS matches, CAST(sum(rows) OVER (ORDER BY chunk) AS BIGINT) AS running_rows
    FROM counted WHERE rows > 0""",
)
def _transfer(t: Tables) -> DataFrame:
    order = ["o_orderdate", "o_custkey", "o_orderkey"]
    export, target = shared_path(t.spark, "transfer"), shared_path(t.spark, "transfer-target")
    return transfer(t.spark, t.orders, export, target, 30, order, partition_unit="YEAR")


@register(
    "transfer_range",
    """WITH s AS (
      SELECT DISTINCT 'm' || (user_id % 5) AS market, event_type AS mapped_instrument, date_trunc('day', ts) AS day
      FROM events WHERE ts IS NOT NULL),
    b AS (SELECT date_trunc('day', min(ts)) + INTERVAL 3 DAY AS lo, date_trunc('day', min(ts)) + INTERVAL 20 DAY AS hi FROM events),
    c AS (
      SELECT CAST(date_diff('day', lo, day) // 7 AS BIGINT) AS chunk, lo, hi FROM s, b WHERE day >= lo AND day <= hi),
    n AS (
      SELECT chunk, any_value(lo) + to_days(CAST(7 * chunk AS INTEGER)) AS chunk_start,
             least(any_value(lo) + to_days(CAST(7 * (chunk + 1) AS INTEGER)), any_value(hi) + INTERVAL 1 SECOND) AS chunk_end,
             CAST(count(*) AS BIGINT) AS source_rows
      FROM c GROUP BY chunk)
    SELECT *, source_rows AS target_rows, CAST(0 AS BIGINT) AS missing_rows, true AS matches,
           CAST(sum(source_rows) OVER (ORDER BY chunk) AS BIGINT) AS running_rows FROM n""",
)
def _transfer_range(t: Tables) -> DataFrame:
    """A stored daily series, of which only the folders of a range are read and transferred."""
    spec = TABLES["futures_ohlcv_1d"]
    bars = t.events.where("ts is not null").select(
        F.concat(F.lit("m"), F.col("user_id") % 5).alias("market"),
        F.col("event_type").alias("mapped_instrument"),
        F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("datetime"),
    ).distinct()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields if f.name not in bars.columns]
    store = Store(shared_path(t.spark, "store"))
    store.upsert(bars.select("*", *empty), "futures_ohlcv_1d")
    first = t.events.agg(F.date_trunc("DAY", F.min("ts")).cast("timestamp_ntz").alias("first")).first()["first"]
    lo, hi = (F.lit(str(first)).cast("timestamp_ntz") + F.expr(f"INTERVAL {d} DAYS") for d in (3, 20))
    export, target = shared_path(t.spark, "transfer"), shared_path(t.spark, "transfer-target")
    return transfer_stored(t.spark, store, "futures_ohlcv_1d", export, target, lo, hi, chunk_days=7)
