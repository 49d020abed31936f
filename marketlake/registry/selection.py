"""Top assets, qualified exchanges, pairs, instruments, ranks and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlake.operators import ranking, select
from marketlake.plans.selection import index_instruments, top_pairs
from marketlake.registry.base import Tables, register
from marketlake.sources import scan

VOLUME = "spot_moving_30_day_quote_volume_usd"


def _assets(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("asset_id"), F.col("c_name").alias("symbol"))


def _snapshots(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("asset_id"),
        F.col("o_orderdate").alias("snapshot_ts"),
        F.col("o_totalprice").alias(VOLUME),
        F.col("o_orderkey").alias("snapshot_id"),
    )


def _choice(c: Column, *cases: tuple[object, str], default: str | None = None) -> Column:
    out = F.when(c == F.lit(cases[0][0]), F.lit(cases[0][1]))
    for value, result in cases[1:]:
        out = out.when(c == F.lit(value), F.lit(result))
    return out.otherwise(F.lit(default))


LATEST_SQL = """
latest AS (SELECT * FROM (SELECT o_custkey, o_totalprice, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
"""


@register(
    "top_assets",
    f"""WITH {LATEST_SQL}
    SELECT c_custkey AS asset_id, c_name AS symbol, o_totalprice AS {VOLUME}
    FROM customer JOIN latest ON c_custkey = o_custkey ORDER BY o_totalprice DESC NULLS LAST, c_custkey LIMIT 50""",
)
def top_assets(t: Tables) -> DataFrame:
    return select.top_assets(_assets(t), _snapshots(t), 50, VOLUME, snapshot_ties=[VOLUME, "snapshot_id"])


@register(
    "graded_filter",
    """SELECT c_name AS internal_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')""",
)
def _graded(t: Tables) -> DataFrame:
    grade = _choice(F.col("c_mktsegment"), ("BUILDING", "AAA"), ("HOUSEHOLD", "A"), ("MACHINERY", "BB"), default="B")
    return select.qualified_exchanges(t.customer.select(F.col("c_name").alias("internal_name"), grade.alias("grade")))


@register(
    "graded_filter_ci",
    """SELECT c_name AS internal_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')""",
)
def _graded_ci(t: Tables) -> DataFrame:
    grade = _choice(F.col("c_mktsegment"), ("BUILDING", "aaa"), ("HOUSEHOLD", "A"), ("MACHINERY", "Bb"), default="b")
    frame = t.customer.select(F.col("c_name").alias("internal_name"), grade.alias("grade"))
    return select.qualified_exchanges(frame, collation="UTF8_LCASE")


@register(
    "trading_pairs",
    """SELECT p_brand AS exchange_internal_name, p_type AS base_asset_symbol, p_name AS quote_asset_symbol
       FROM part JOIN (SELECT n_nationkey FROM nation UNION ALL SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
       ON p_size = n_nationkey
       WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_type IN ('ECONOMY', 'SMALL') AND p_retailprice > 950""",
)
def _trading_pairs(t: Tables) -> DataFrame:
    instruments = t.part.select(
        F.col("p_brand").alias("exchange_internal_name"),
        F.col("p_type").alias("base_asset_symbol"),
        F.col("p_name").alias("quote_asset_symbol"),
        F.col("p_size").alias("base_asset_id"),
        F.when(F.col("p_retailprice") > 950, "ACTIVE").otherwise("RETIRED").alias("instrument_status_on_exchange"),
    )
    ids = t.nation.select(F.col("n_nationkey").alias("asset_id"), "n_regionkey")
    stored_twice = ids.unionByName(ids.where("n_regionkey = 1"))
    return select.trading_pairs(
        instruments, stored_twice, ["Brand#1", "Brand#2", "Brand#3"], ["ECONOMY", "SMALL"]
    )


TOP_PAIRS_SQL = f"""
WITH {LATEST_SQL},
top AS (SELECT c_name FROM customer JOIN latest ON c_custkey = o_custkey
        ORDER BY o_totalprice DESC NULLS LAST, c_custkey LIMIT 200)
SELECT n_name AS exchange_internal_name, a.c_name AS base_asset_symbol, o_orderpriority AS quote_asset_symbol
FROM orders JOIN customer a ON o_custkey = a.c_custkey JOIN nation ON a.c_nationkey = n_nationkey
WHERE o_orderstatus = 'O' AND a.c_name IN (SELECT c_name FROM top) AND n_regionkey IN (0, 2)
"""


def _pair_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshots, exchanges and instruments."""
    venues = t.nation.select(
        F.col("n_name").alias("internal_name"),
        _choice(F.col("n_regionkey"), (0, "AA"), (1, "B"), (2, "BBB"), (3, "C"), default="D").alias("grade"),
    )
    listed = t.orders.join(t.customer, t.orders["o_custkey"] == t.customer["c_custkey"]).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    instruments = listed.select(
        F.col("n_name").alias("exchange_internal_name"),
        F.col("c_name").alias("base_asset_symbol"),
        F.col("o_orderpriority").alias("quote_asset_symbol"),
        F.col("o_custkey").alias("base_asset_id"),
        _choice(F.col("o_orderstatus"), ("O", "ACTIVE"), default="RETIRED").alias("instrument_status_on_exchange"),
    )
    # one snapshot row per asset, so that ties of the snapshot time cannot occur
    snapshots = _snapshots(t).groupBy("asset_id").agg(
        F.max(F.struct("snapshot_ts", VOLUME, "snapshot_id")).alias("s")
    ).select("asset_id", "s.snapshot_ts", f"s.{VOLUME}")
    return snapshots, venues, instruments


@register("top_pairs", TOP_PAIRS_SQL)
def _top_pairs(t: Tables) -> DataFrame:
    return top_pairs(_assets(t), *_pair_tables(t), asset_limit=200)


@register(
    "top_pairs_ci",
    TOP_PAIRS_SQL.replace("SELECT n_name AS", "SELECT CASE WHEN c_nationkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS").replace(
        "a.c_name AS base_asset_symbol", "upper(a.c_name) AS base_asset_symbol"
    ),
)
def _top_pairs_ci(t: Tables) -> DataFrame:
    """Instruments spell exchanges, symbols and status in other cases than the lists."""
    snapshots, venues, instruments = _pair_tables(t)
    lower_case = venues.withColumn("grade", F.lower("grade"))
    even = t.nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("exchange_internal_name"), F.lit(True).alias("even"))
    spelled = instruments.join(even, "exchange_internal_name", "left").withColumns(
        {
            "exchange_internal_name": F.when(F.col("even"), F.lower("exchange_internal_name")).otherwise(F.col("exchange_internal_name")),
            "base_asset_symbol": F.upper("base_asset_symbol"),
            "instrument_status_on_exchange": F.lower("instrument_status_on_exchange"),
        }
    )
    return top_pairs(_assets(t), snapshots, lower_case, spelled, asset_limit=200, collation="UTF8_LCASE")


@register(
    "futures_exchanges",
    "SELECT n_name AS exchange_internal_name FROM nation",
)
def _futures_exchanges(t: Tables) -> DataFrame:
    return select.futures_exchanges(t.nation.select(F.col("n_name").alias("exchange_internal_name"), "n_nationkey"))


def _futures(t: Tables) -> DataFrame:
    """Orders as futures instruments: status and priority decide what data they have."""
    day = F.expr("INTERVAL 1 DAY")
    frame = t.orders.select(
        F.col("o_orderpriority").alias("exchange_internal_name"),
        F.concat(F.lit("I-"), F.col("o_orderkey")).alias("mapped_instrument_symbol"),
        _choice(F.col("o_orderstatus"), ("O", "ACTIVE"), ("F", "EXPIRED"), default="RETIRED").alias(
            "instrument_status_on_exchange"
        ),
        (F.col("o_totalprice") > 100000).alias("has_trades"),
        F.nullif(F.col("o_totalprice") > 200000, F.lit(False)).alias("has_funding_rate_updates"),
        (F.col("o_totalprice") < 300000).alias("has_open_interest_updates"),
        "o_orderdate",
    )
    for kind in ("trade", "funding_rate_update", "open_interest_update"):
        frame = frame.withColumns(
            {f"first_{kind}_datetime": F.col("o_orderdate"), f"last_{kind}_datetime": F.col("o_orderdate") + day}
        )
    return frame


def _selection_sql(kind: str, condition: str) -> str:
    return f"""SELECT o_orderpriority AS exchange_internal_name, 'I-' || o_orderkey AS mapped_instrument_symbol,
      o_orderdate + INTERVAL 1 DAY AS last_{kind}_datetime, o_orderdate AS first_{kind}_datetime,
      CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'RETIRED' END AS instrument_status_on_exchange
      FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('O', 'F') AND {condition}"""


_SELECTIONS = {
    "instrument_selection": ("ohlcv", "trade", "o_totalprice > 100000"),
    "instrument_selection_funding": ("funding-rate", "funding_rate_update", "o_totalprice > 200000"),
    "instrument_selection_open_interest": ("open-interest", "open_interest_update", "o_totalprice < 300000"),
}
for _name, (_type, _kind, _condition) in _SELECTIONS.items():

    @register(_name, _selection_sql(_kind, _condition))
    def _instrument_selection(t: Tables, data_type: str = _type) -> DataFrame:
        return select.futures_instruments(_futures(t), ["1-URGENT", "2-HIGH"], ["ACTIVE", "EXPIRED"], data_type)


@register(
    "instrument_list",
    _selection_sql("trade", "o_totalprice > 100000 AND o_orderkey IN (3, 17, 255, 1024)")
    .replace("('1-URGENT', '2-HIGH')", "(SELECT o_orderpriority FROM orders)"),
)
def _instrument_list(t: Tables) -> DataFrame:
    venues = t.orders.select(F.col("o_orderpriority").alias("exchange_internal_name"))
    symbols = ["I-3 ", "I-17", " I-255", "I-1024"]
    return select.futures_instruments(_futures(t), venues, ["ACTIVE", "EXPIRED"], "ohlcv", symbols)


@register(
    "index_instruments",
    f"""WITH {LATEST_SQL}
    SELECT 'index' AS market, c_name AS asset, 'USD' AS quote, c_name || '-USD' AS instrument
    FROM customer JOIN latest ON c_custkey = o_custkey ORDER BY o_totalprice DESC NULLS LAST, c_custkey LIMIT 50""",
)
def _index_instruments(t: Tables) -> DataFrame:
    return index_instruments(top_assets(t), "index")


@register(
    "time_range",
    """SELECT event_id, ts, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20 12:00:00'""",
)
def _time_range(t: Tables) -> DataFrame:
    start, end = F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return select.time_range(t.events, start, end, "ts").select("event_id", "ts", "value")


@register(
    "bound_scan",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 250000",
)
def _bound_scan(t: Tables) -> DataFrame:
    sql = "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status AND o_totalprice >= :floor"
    return scan(t.spark, sql, {"status": "F", "floor": 250000.0}, orders=t.orders)


@register(
    "ranked_page",
    """SELECT c_custkey, c_name, c_acctbal, CAST(position AS INTEGER) AS position FROM (
         SELECT *, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS position
         FROM customer WHERE c_mktsegment = 'BUILDING')
       WHERE position BETWEEN 21 AND 40""",
)
def _ranked_page(t: Tables) -> DataFrame:
    page = ranking.ranked_page(
        t.customer, "c_acctbal", ["c_custkey"], page=2, page_size=20, where=F.col("c_mktsegment") == "BUILDING"
    )
    return page.select("c_custkey", "c_name", "c_acctbal", "position")


@register(
    "ranked_page_deep",
    """SELECT l_orderkey, l_linenumber, l_quantity, position FROM (
         SELECT *, row_number() OVER (ORDER BY nullif(l_quantity, 7), l_shipdate NULLS FIRST, l_orderkey, l_linenumber, l_extendedprice) AS position
         FROM lineitem)
       WHERE position BETWEEN 30 * 500 + 1 AND 31 * 500""",
)
def _ranked_page_deep(t: Tables) -> DataFrame:
    """A page far down a list by a value that many rows share."""
    lines = t.lineitem.withColumn("quantity", F.nullif("l_quantity", F.lit(7)))
    ties = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    page = ranking.ranked_page(lines, "quantity", ties, page=31, page_size=500, descending=False)
    return page.select("l_orderkey", "l_linenumber", "l_quantity", F.col("position").cast("bigint").alias("position"))


@register("first_n", "SELECT s_suppkey, s_name FROM supplier ORDER BY s_name, s_suppkey LIMIT 25")
def _first_n(t: Tables) -> DataFrame:
    return ranking.first_n(t.supplier.select("s_suppkey", "s_name"), ["s_name", "s_suppkey"], 25)


@register(
    "metric_ranks",
    """SELECT p_partkey, p_retailprice, p_size, rank() OVER (ORDER BY p_retailprice DESC) AS p_retailprice_rank,
       rank() OVER (ORDER BY nullif(p_size, 7) DESC NULLS LAST) AS p_size_rank
       FROM part""",
)
def _metric_ranks(t: Tables) -> DataFrame:
    frame = t.part.select("p_partkey", "p_retailprice", F.nullif("p_size", F.lit(7)).alias("p_size"))
    ranked = ranking.metric_ranks(frame, ["p_retailprice", "p_size"])
    return ranked.withColumn("p_size", F.coalesce("p_size", F.lit(7)))
