"""Whole refresh jobs: payloads are landed, refreshed into stored tables twice, and the tables read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marketlake.plans import refresh
from marketlake.plans.store import Store
from marketlake.registry import payloads as P
from marketlake.registry.base import Tables, register
from marketlake.session import shared_path

RUNS = ("2024-03-01", "2024-03-02")


def _runs() -> list[Column]:
    return [F.lit(run).cast("timestamp_ntz") for run in RUNS]


def _land(rows: DataFrame, sql: str) -> str:
    """Folder with one payload per line."""
    path = shared_path(rows.sparkSession, "landed")
    rows.select(F.expr(sql).alias("value")).write.text(path)
    return path


def _store(t: Tables) -> Store:
    return Store(shared_path(t.spark, "store"))


# The second delivery names another market segment: rows of that key stay, the others are replaced.
_ASSET_VALUES = {
    "assets": "asset_type",
    "asset_alternative_ids": "cmc_id",
    "asset_industries_map": "industry_name",
    "asset_consensus_mechanisms_map": "mechanism_name",
    "asset_consensus_algorithm_types_map": "algorithm_name",
    "asset_hashing_algorithm_types_map": "algorithm_name",
    "asset_previous_symbols_map": "previous_symbol",
    "asset_market_data": "date_format(created_at, 'yyyy-MM-dd')",
}
_BOTH_SEGMENTS = "(VALUES (c_mktsegment, 1), (c_mktsegment || '2', 2)) s(seg, run)"


@register(
    "refresh_assets",
    f"""
WITH a AS (SELECT * FROM customer WHERE c_acctbal >= 0 AND c_custkey <> 5),
r AS (
  SELECT 'assets' AS tbl, c_custkey AS asset_id, c_mktsegment || '2' AS val, 2 AS run FROM a
  UNION ALL SELECT 'asset_alternative_ids', c_custkey,
    CASE WHEN c_nationkey = 2 THEN 'old' ELSE 'cmc' END || c_custkey, 2 FROM a WHERE c_custkey <> 0
  UNION ALL SELECT 'asset_industries_map', c_custkey, seg, run FROM a, {_BOTH_SEGMENTS} WHERE c_nationkey <> 4
  UNION ALL SELECT 'asset_industries_map', c_custkey, 'ALL', 2 FROM a WHERE c_nationkey <> 4
  UNION ALL SELECT 'asset_consensus_mechanisms_map', c_custkey, seg, run FROM a, {_BOTH_SEGMENTS} WHERE c_nationkey <> 6
  UNION ALL SELECT 'asset_consensus_mechanisms_map', c_custkey, 'POW', 2 FROM a WHERE c_nationkey <> 6
  UNION ALL SELECT 'asset_consensus_algorithm_types_map', c_custkey, 'A1', 2 FROM a
  UNION ALL SELECT 'asset_hashing_algorithm_types_map', c_custkey, 'H' || c_nationkey, 2 FROM a
  UNION ALL SELECT 'asset_previous_symbols_map', c_custkey, seg, run FROM a, {_BOTH_SEGMENTS}
  UNION ALL SELECT 'asset_previous_symbols_map', c_custkey, unnest(['[' || c_nationkey || ',"x"]', c_name,
    CAST(c_custkey AS VARCHAR), 'true', '{{"A":' || c_nationkey || ',"SYMBOL":""}}']), 2 FROM a
  UNION ALL SELECT 'asset_market_data', c_custkey, '2024-03-0' || run, run FROM a, {_BOTH_SEGMENTS})
SELECT tbl, asset_id, val, CASE run WHEN 1 THEN TIMESTAMP '{RUNS[0]}' ELSE TIMESTAMP '{RUNS[1]}' END AS updated_at FROM r
""",
)
def _refresh_assets(t: Tables) -> DataFrame:
    store = _store(t)
    later = t.customer.withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit("2")))
    for rows, run in zip((t.customer, later), _runs()):
        refresh.refresh_assets(t.spark, _land(rows, P._ASSET_JSON), store, run, per_file=False)
    tables = [
        store.read(t.spark, table).select(F.lit(table).alias("tbl"), "asset_id", F.expr(value).alias("val"), "updated_at")
        for table, value in _ASSET_VALUES.items()
    ]
    return reduce(DataFrame.unionByName, tables).where("asset_id is not null")


# An active venue of the first delivery has other counts in the second one.
def _refresh_exchanges(t: Tables, kind: str, sql: str, details: str, instruments: str) -> DataFrame:
    store = _store(t)
    later = t.supplier.withColumn("s_acctbal", -F.col("s_acctbal"))
    for rows, run in zip((t.supplier, later), _runs()):
        refresh.refresh_exchanges(t.spark, _land(rows, sql), store, run, kind, per_file=False)
    venues = store.read(t.spark, details).select("exchange_internal_name", "instruments_active_count")
    return venues.join(store.read(t.spark, instruments), "exchange_internal_name", "left").select(
        "exchange_internal_name",
        "instruments_active_count",
        "mapped_instrument_symbol",
        "instrument_status_on_exchange",
        "has_trades",
        "first_trade_datetime",
        "updated_at",
    )


_EXCHANGES_SQL = f"""
SELECT s_name AS exchange_internal_name, s_nationkey AS instruments_active_count, i.symbol AS mapped_instrument_symbol,
  CASE WHEN i.symbol IS NULL THEN NULL WHEN -s_acctbal > 5000 THEN 'ACTIVE' ELSE 'RETIRED' END AS instrument_status_on_exchange,
  CASE WHEN i.symbol IS NOT NULL THEN -s_acctbal > 0 END AS has_trades, i.first AS first_trade_datetime,
  CASE WHEN i.symbol IS NOT NULL THEN TIMESTAMP '{RUNS[1]}' END AS updated_at
FROM supplier LEFT JOIN (SELECT 'X-USD' AS symbol, CAST(NULL AS TIMESTAMP) AS first
  UNION ALL SELECT 'Y-USD', to_timestamp(1600000000) AT TIME ZONE 'UTC') i ON s_nationkey <> 7
"""


@register("refresh_exchanges_spot", _EXCHANGES_SQL)
def _refresh_spot(t: Tables) -> DataFrame:
    return _refresh_exchanges(t, "spot", P._SPOT_TREE, "exchange_spot_details", "instruments_spot")


@register("refresh_exchanges_futures", _EXCHANGES_SQL)
def _refresh_futures(t: Tables) -> DataFrame:
    return _refresh_exchanges(t, "futures", P._FUTURES_TREE, "exchanges_futures_details", "instruments_futures")


@register(
    "refresh_gradings",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS exchange_api_id, c_name AS name, -c_acctbal AS grade_points,
        c_nationkey AS rating_total_users, TIMESTAMP '{RUNS[1]}' AS updated_at FROM customer""",
)
def _refresh_gradings(t: Tables) -> DataFrame:
    store = _store(t)
    later = t.customer.withColumn("c_acctbal", -F.col("c_acctbal"))
    for rows, run in zip((t.customer, later), _runs()):
        refresh.refresh_gradings(t.spark, _land(rows, P._GENERAL_JSON), store, run, per_file=False)
    return store.read(t.spark, "exchanges_general").select(
        "exchange_api_id", "name", "grade_points", "rating_total_users", "updated_at"
    )


@register(
    "record_usage",
    f"""SELECT r.ts AS timestamp, 'job' AS use_case, r.timing AS record_timing,
        CAST(o_orderkey % 1000 AS INTEGER) AS api_key_used_second, CAST(o_orderkey % 1000 + 2 AS INTEGER) AS auth_key_max_month
        FROM orders, (VALUES (TIMESTAMP '{RUNS[0]}', 'pre'), (TIMESTAMP '{RUNS[1]}', 'post')) r(ts, timing)""",
)
def _record_usage(t: Tables) -> DataFrame:
    store, path = _store(t), _land(t.orders, P._LIMIT_JSON)
    for run, timing in zip(_runs(), ("pre", "post")):
        refresh.record_usage(t.spark, path, store, "job", timing, run, per_file=False)
    return store.read(t.spark, "rate_limit_status").select(
        "timestamp", "use_case", "record_timing", "api_key_used_second", "auth_key_max_month"
    )
