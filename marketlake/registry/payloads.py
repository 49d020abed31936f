"""Flattening: every payload is built row by row from a table, as JSON text, and parsed back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlake import schemas as S
from marketlake.operators import flatten
from marketlake.registry.base import Tables, register
from marketlake.sources import is_complete, parse_messages, parse_payload, payload_entries, payload_records, table_columns

RUN = "2024-03-01 00:00:00"
RUN_SQL = f"TIMESTAMP '{RUN}'"
AUDIT_SQL = f"{RUN_SQL} AS created_at, {RUN_SQL} AS updated_at"


def run_ts() -> Column:
    return F.lit(RUN).cast("timestamp_ntz")


def _with_payload(df: DataFrame, sql: str) -> DataFrame:
    return df.select(F.expr(sql).alias("payload"))


# --- assets: one page per customer; overdrawn customers answer with an error ----

_ASSET_JSON = """
concat('{"Response":"', if(c_acctbal < 0, 'Error', 'Success'), '","Data":{"STATS":{"PAGE":1,"PAGE_SIZE":1,"TOTAL_ASSETS":1},"LIST":[',
  rtrim('}', to_json(named_struct(
    'ID', nullif(c_custkey, 5), 'SYMBOL', concat('S', c_custkey), 'NAME', c_name, 'TYPE', '162', 'ASSET_TYPE', c_mktsegment,
    'ID_LEGACY', c_nationkey, 'CREATED_ON', 1700000000 + c_custkey, 'UPDATED_ON', if(c_nationkey = 3, null, 1700000000),
    'LAUNCH_DATE', 0, 'ASSET_DECIMAL_POINTS', c_nationkey, 'PRICE_USD', c_acctbal,
    'PRICE_USD_LAST_UPDATE_TS', if(c_nationkey < 5, 0, 1700000000 + c_nationkey),
    'SPOT_MOVING_30_DAY_QUOTE_VOLUME_USD', c_acctbal * 2,
    'ASSET_ALTERNATIVE_IDS', array(
      named_struct('NAME', 'CMC', 'ID', concat('old', c_custkey)),
      named_struct('NAME', if(c_nationkey = 1, 'OTHER', 'cg'), 'ID', c_name),
      named_struct('NAME', 'CMC', 'ID', if(c_nationkey = 2, '', concat('cmc', c_custkey))),
      named_struct('NAME', 'ISIN', 'ID', cast(null as string))),
    'ASSET_INDUSTRIES', if(c_nationkey = 4, null, array(
      named_struct('ASSET_INDUSTRY', c_mktsegment, 'JUSTIFICATION', c_name),
      named_struct('ASSET_INDUSTRY', 'ALL', 'JUSTIFICATION', cast(null as string)))),
    'CONSENSUS_MECHANISMS', if(c_nationkey = 6, array(), array(named_struct('NAME', 'POW'), named_struct('NAME', c_mktsegment))),
    'CONSENSUS_ALGORITHM_TYPES', array(named_struct('NAME', 'A1', 'DESCRIPTION', c_name)),
    'HASHING_ALGORITHM_TYPES', array(named_struct('NAME', concat('H', c_nationkey)))))),
  ',"PREVIOUS_ASSET_SYMBOLS":[{"SYMBOL":"', c_mktsegment, '","X":1},[', c_nationkey, ',"x"],"', c_name, '",', c_custkey,
  ',true,{"SYMBOL":"","A":', c_nationkey, '}]}]}}')
"""


def _pages(t: Tables) -> DataFrame:
    return parse_payload(_with_payload(t.customer, _ASSET_JSON), S.ASSET_PAGE)


def _records(t: Tables) -> DataFrame:
    return payload_records(_pages(t), "body.Data.LIST")


GOOD = "FROM (SELECT *, nullif(c_custkey, 5) AS id FROM customer WHERE c_acctbal >= 0)"
STRINGS = ("uri", "asset_issuer_name", "parent_asset_symbol", "public_notice", "logo_url")


@register(
    "asset_core",
    f"""SELECT id AS asset_id, 'S' || c_custkey AS symbol, c_name AS name, {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in STRINGS)},
    c_mktsegment AS asset_type, '162' AS cc_internal_type, CAST(c_nationkey AS BIGINT) AS id_legacy,
    CAST(NULL AS BIGINT) AS id_parent_asset, CAST(NULL AS BIGINT) AS id_asset_issuer,
    to_timestamp(1700000000 + c_custkey) AT TIME ZONE 'UTC' AS cc_created_on,
    CASE WHEN c_nationkey = 3 THEN NULL ELSE to_timestamp(1700000000) AT TIME ZONE 'UTC' END AS cc_updated_on,
    TIMESTAMP '1970-01-01' AS launch_date, CAST(NULL AS VARCHAR) AS description_summary, c_nationkey AS decimal_points,
    CAST(NULL AS VARCHAR) AS symbol_glyph, {AUDIT_SQL} {GOOD} WHERE id IS NOT NULL""",
)
def _asset_core(t: Tables) -> DataFrame:
    return flatten.asset_rows(_records(t), run_ts()).where("asset_id is not null")


@register(
    "kv_pivot",
    f"""SELECT id AS asset_id,
    CASE WHEN c_nationkey = 2 THEN 'old' || c_custkey ELSE 'cmc' || c_custkey END AS cmc_id,
    CASE WHEN c_nationkey = 1 THEN NULL ELSE c_name END AS cg_id,
    {', '.join(f'CAST(NULL AS VARCHAR) AS {n}_id' for n in ('isin', 'valor', 'dti', 'chain'))}, {AUDIT_SQL}
    {GOOD} WHERE id IS NOT NULL AND id <> 0""",
)
def _kv_pivot(t: Tables) -> DataFrame:
    return flatten.asset_alternative_id_rows(_records(t), run_ts())


_CHILD_SQL = {
    "asset_industries_map": f"""SELECT coalesce(id, -1) AS asset_id, c_mktsegment AS industry_name, c_name AS justification, {AUDIT_SQL}
      {GOOD} WHERE c_nationkey <> 4 UNION ALL SELECT coalesce(id, -1), 'ALL', NULL, {AUDIT_SQL} {GOOD} WHERE c_nationkey <> 4""",
    "asset_consensus_mechanisms_map": f"""SELECT coalesce(id, -1) AS asset_id, unnest(['POW', c_mktsegment]) AS mechanism_name, {AUDIT_SQL}
      {GOOD} WHERE c_nationkey <> 6""",
    "asset_consensus_algorithm_types_map": f"""SELECT coalesce(id, -1) AS asset_id, 'A1' AS algorithm_name, c_name AS description, {AUDIT_SQL} {GOOD}""",
    "asset_hashing_algorithm_types_map": f"""SELECT coalesce(id, -1) AS asset_id, 'H' || c_nationkey AS algorithm_name, {AUDIT_SQL} {GOOD}""",
}
for _table, _sql in _CHILD_SQL.items():

    @register(f"array_children_{_table}", _sql)
    def _children(t: Tables, table: str = _table) -> DataFrame:
        rows = flatten.asset_child_rows(_records(t), table, run_ts())
        return rows.withColumn("asset_id", F.coalesce("asset_id", F.lit(-1)))


@register(
    "hetero_strings",
    f"""SELECT coalesce(id, -1) AS asset_id, unnest([c_mktsegment, '[' || c_nationkey || ',"x"]', c_name, CAST(c_custkey AS VARCHAR),
    'true', '{{"A":' || c_nationkey || ',"SYMBOL":""}}']) AS previous_symbol, {AUDIT_SQL} {GOOD}""",
)
def _hetero(t: Tables) -> DataFrame:
    rows = flatten.asset_previous_symbol_rows(_records(t), run_ts())
    return rows.withColumn("asset_id", F.coalesce("asset_id", F.lit(-1)))


_MISSING_METRICS = ["mkt_cap_penalty", "circulating_mkt_cap_usd", "total_mkt_cap_usd"] + [
    f"spot_moving_{w}_quote_volume{tier}_usd"
    for w in S.MOVING_WINDOWS
    for tier in ("_top_tier", "")
    if (w, tier) != ("30_day", "")
]


@register(
    "asset_market",
    f"""SELECT coalesce(id, -1) AS asset_id,
    CASE WHEN c_nationkey < 5 THEN NULL ELSE to_timestamp(1700000000 + c_nationkey) AT TIME ZONE 'UTC' END AS snapshot_ts,
    c_acctbal AS price_usd, CAST(NULL AS VARCHAR) AS price_usd_source, c_acctbal * 2 AS spot_moving_30_day_quote_volume_usd,
    {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in _MISSING_METRICS)}, {AUDIT_SQL} {GOOD}""",
)
def _asset_market(t: Tables) -> DataFrame:
    rows = flatten.asset_market_rows(_records(t), run_ts())
    return rows.withColumn("asset_id", F.coalesce("asset_id", F.lit(-1)))


@register(
    "page_completeness",
    """SELECT CAST(count(*) AS BIGINT) AS pages, CAST(count(*) AS BIGINT) AS collected, CAST(1 AS BIGINT) AS announced,
       true AS complete FROM customer WHERE c_acctbal >= 0""",
)
def _completeness(t: Tables) -> DataFrame:
    return is_complete(_pages(t))


# --- exchanges: one tree per supplier -----------------------------------------------

_MAPPING = {
    "SPOT": """named_struct('BASE', concat('B', s_nationkey), 'BASE_ID', s_nationkey, 'QUOTE', 'USD', 'QUOTE_ID', 5,
                'TRANSFORM_FUNCTION', '', 'CREATED_ON', 1600000000)""",
    "FUTURES": """named_struct('INDEX_UNDERLYING', concat('B', s_nationkey), 'INDEX_UNDERLYING_ID', s_nationkey,
                'QUOTE_CURRENCY', 'USD', 'QUOTE_CURRENCY_ID', 5, 'SETTLEMENT_CURRENCY', 'USDT', 'SETTLEMENT_CURRENCY_ID', 7,
                'CONTRACT_CURRENCY', 'USD', 'CONTRACT_CURRENCY_ID', 5, 'DENOMINATION_TYPE', 'VANILLA',
                'TRANSFORM_FUNCTION', '', 'CREATED_ON', 0)""",
}


def _tree_sql(kind: str, flag: str) -> str:
    extra = ""
    if kind == "FUTURES":
        extra = """, 'HAS_FUNDING_RATE_UPDATES', 'True', 'FIRST_FUNDING_RATE_UPDATE_TIMESTAMP', 1650000000,
          'LAST_FUNDING_RATE_UPDATE_TIMESTAMP', 0, 'TOTAL_FUNDING_RATE_UPDATES', s_suppkey,
          'HAS_OPEN_INTEREST_UPDATES', cast(null as string), 'CONTRACT_EXPIRATION_TS', 1760000000 + s_suppkey"""

    def instrument(raw: str, first: str) -> str:
        return f"""named_struct('TYPE', '1', 'INSTRUMENT_STATUS', if(s_acctbal > 5000, 'ACTIVE', 'RETIRED'), 'INSTRUMENT', {raw},
          'INSTRUMENT_MAPPING', {_MAPPING[kind]}, 'HAS_TRADES_{kind}', {flag}, 'FIRST_TRADE_{kind}_TIMESTAMP', {first},
          'LAST_TRADE_{kind}_TIMESTAMP', 1700000000 + s_suppkey, 'TOTAL_TRADES_{kind}', s_suppkey * 10 {extra})"""

    totals = f", 'TOTAL_TRADES_{kind}', s_suppkey * 100"
    if kind == "FUTURES":
        totals += ", 'TOTAL_OPEN_INTEREST_UPDATES', s_suppkey * 3, 'TOTAL_FUNDING_RATE_UPDATES', s_suppkey * 2"
    return f"""to_json(named_struct('Response', 'Success', 'Data', map(s_name, named_struct('TYPE', '9', 'EXCHANGE_STATUS', 'ACTIVE',
      'MAPPED_INSTRUMENTS_TOTAL', 2, 'UNMAPPED_INSTRUMENTS_TOTAL', s_nationkey,
      'INSTRUMENT_STATUS', map('ACTIVE', s_nationkey, 'EXPIRED', 1),
      'HAS_ORDERBOOK_L2_MINUTE_SNAPSHOTS_ENABLED', s_nationkey < 10 {totals},
      'instruments', if(s_nationkey = 7, null, map('X-USD', {instrument("'xusd'", "0")}, 'Y-USD', {instrument("'yusd'", "1600000000")}))))))"""


_SPOT_TREE = _tree_sql("SPOT", "s_acctbal > 0")
_FUTURES_TREE = _tree_sql("FUTURES", "if(s_acctbal > 0, 'True', 'no')")


def _entries(t: Tables, sql: str, schema: str) -> DataFrame:
    return payload_entries(parse_payload(_with_payload(t.supplier, sql), schema))


_EXCHANGE_SQL = f"""s_name AS exchange_internal_name, '9' AS api_exchange_type, 'ACTIVE' AS exchange_status,
  2 AS mapped_instruments_total, s_nationkey AS unmapped_instruments_total, s_nationkey AS instruments_active_count,
  CAST(NULL AS INTEGER) AS instruments_ignored_count, CAST(NULL AS INTEGER) AS instruments_retired_count,
  1 AS instruments_expired_count, CAST(NULL AS INTEGER) AS instruments_retired_unmapped_count,
  s_suppkey * 100 AS total_trades_exchange_level, s_nationkey < 10 AS has_orderbook_l2_snapshots,
  {RUN_SQL} AS api_data_retrieved_datetime, {AUDIT_SQL}"""


@register("map_children_spot_exchanges", f"SELECT {_EXCHANGE_SQL} FROM supplier")
def _spot_exchanges(t: Tables) -> DataFrame:
    return flatten.spot_exchange_rows(_entries(t, _SPOT_TREE, S.SPOT_TREE), run_ts())


@register(
    "map_children_futures_exchanges",
    f"""SELECT {_EXCHANGE_SQL}, s_suppkey * 3 AS total_open_interest_updates,
        s_suppkey * 2 AS total_funding_rate_updates FROM supplier""",
)
def _futures_exchange_details(t: Tables) -> DataFrame:
    return flatten.futures_exchange_rows(_entries(t, _FUTURES_TREE, S.FUTURES_TREE), run_ts())


_INSTRUMENT_SQL = f"""s_name AS exchange_internal_name, i.symbol AS mapped_instrument_symbol, '1' AS api_instrument_type,
  CASE WHEN s_acctbal > 5000 THEN 'ACTIVE' ELSE 'RETIRED' END AS instrument_status_on_exchange,
  i.raw AS exchange_instrument_symbol_raw, '' AS transform_function, s_acctbal > 0 AS has_trades,
  i.first AS first_trade_datetime, to_timestamp(1700000000 + s_suppkey) AT TIME ZONE 'UTC' AS last_trade_datetime,
  s_suppkey * 10 AS total_trades_instrument_level, {AUDIT_SQL}"""
_INSTRUMENT_FROM = """FROM supplier, (SELECT 'X-USD' AS symbol, 'xusd' AS raw, CAST(NULL AS TIMESTAMP) AS first
  UNION ALL SELECT 'Y-USD', 'yusd', to_timestamp(1600000000) AT TIME ZONE 'UTC') i WHERE s_nationkey <> 7"""


@register(
    "map_children_spot_instruments",
    f"""SELECT {_INSTRUMENT_SQL}, 'B' || s_nationkey AS base_asset_symbol, CAST(s_nationkey AS BIGINT) AS base_asset_id,
    'USD' AS quote_asset_symbol, CAST(5 AS BIGINT) AS quote_asset_id,
    to_timestamp(1600000000) AT TIME ZONE 'UTC' AS instrument_mapping_created_datetime {_INSTRUMENT_FROM}""",
)
def _spot_instruments(t: Tables) -> DataFrame:
    return flatten.spot_instrument_rows(_entries(t, _SPOT_TREE, S.SPOT_TREE), run_ts())


@register(
    "map_children_futures_instruments",
    f"""SELECT {_INSTRUMENT_SQL}, 'B' || s_nationkey AS index_underlying_symbol, CAST(s_nationkey AS BIGINT) AS index_underlying_id,
    'USD' AS quote_currency_symbol, CAST(5 AS BIGINT) AS quote_currency_id, 'USDT' AS settlement_currency_symbol,
    CAST(7 AS BIGINT) AS settlement_currency_id, 'USD' AS contract_currency_symbol, CAST(5 AS BIGINT) AS contract_currency_id,
    'VANILLA' AS denomination_type, CAST(NULL AS TIMESTAMP) AS instrument_mapping_created_datetime,
    true AS has_funding_rate_updates, to_timestamp(1650000000) AT TIME ZONE 'UTC' AS first_funding_rate_update_datetime,
    CAST(NULL AS TIMESTAMP) AS last_funding_rate_update_datetime, s_suppkey AS total_funding_rate_updates,
    false AS has_open_interest_updates, CAST(NULL AS TIMESTAMP) AS first_open_interest_update_datetime,
    CAST(NULL AS TIMESTAMP) AS last_open_interest_update_datetime, CAST(NULL AS BIGINT) AS total_open_interest_updates,
    to_timestamp(1760000000 + s_suppkey) AT TIME ZONE 'UTC' AS contract_expiration_datetime {_INSTRUMENT_FROM}""",
)
def _futures_instruments(t: Tables) -> DataFrame:
    return flatten.futures_instrument_rows(_entries(t, _FUTURES_TREE, S.FUTURES_TREE), run_ts())


_GENERAL_JSON = """to_json(named_struct('Response', 'Success', 'Data', map(cast(c_custkey as string), named_struct(
  'Name', c_name, 'InternalName', concat('ex', c_custkey), 'ItemType', if(c_nationkey = 3, null, array('Spot', c_mktsegment)),
  'Grade', 'AA', 'GradePoints', c_acctbal, 'GradePointsSplit', map('Legal', c_acctbal / 2, 'Security', 1.5),
  'OrderBook', c_nationkey < 5, 'Trades', true, 'Rating', named_struct('Avg', 4.5, 'TotalUsers', c_nationkey),
  'SortOrder', if(c_nationkey = 1, 'x', cast(c_nationkey as string)), 'TOTALVOLUME24H', map('USD', c_acctbal, 'BTC', 1.0)))))"""
_GENERAL_NULL_STRINGS = (
    "api_url_path",
    "logo_url_path",
    "centralization_type",
    "affiliate_url",
    "country",
    "description",
    "full_address",
)
_GENERAL_NULL_SPLITS = [c for c in flatten.GRADE_SPLITS if c not in ("grade_points_legal", "grade_points_security")]


@register(
    "deep_flatten",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS exchange_api_id, c_name AS name, 'ex' || c_custkey AS internal_name,
    CASE WHEN c_nationkey = 3 THEN '[]' ELSE '["Spot","' || c_mktsegment || '"]' END AS item_types, c_acctbal AS grade_points,
    'AA' AS grade, c_acctbal / 2 AS grade_points_legal, CAST(1.5 AS DOUBLE) AS grade_points_security,
    c_nationkey < 5 AS has_orderbook, true AS has_trades, CAST(NULL AS BOOLEAN) AS is_sponsored,
    CAST(NULL AS BOOLEAN) AS is_recommended, CAST(4.5 AS DOUBLE) AS rating_avg, c_nationkey AS rating_total_users,
    CASE WHEN c_nationkey = 1 THEN -1 ELSE c_nationkey END AS sort_order, c_acctbal AS total_volume_24h_usd,
    {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in _GENERAL_NULL_STRINGS)},
    {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in _GENERAL_NULL_SPLITS)}, {AUDIT_SQL} FROM customer""",
)
def _general(t: Tables) -> DataFrame:
    entries = payload_entries(parse_payload(_with_payload(t.customer, _GENERAL_JSON), S.EXCHANGE_GENERAL))
    rows = flatten.exchange_general_rows(entries, run_ts())
    return rows.withColumn("sort_order", F.coalesce("sort_order", F.lit(-1)))


_LIMIT_JSON = (
    "to_json(named_struct('Data', named_struct("
    + ", ".join(
        f"'{k}', named_struct("
        + ", ".join(
            f"'{g}', named_struct(" + ", ".join(f"'{u}', o_orderkey % 1000 + {i + j}" for j, u in enumerate(units)) + ")"
            for i, (g, units) in enumerate({"USED": ("SECOND", "DAY"), "MAX": ("MINUTE", "MONTH")}.items())
        )
        + ")"
        for k in ("API_KEY", "AUTH_KEY")
    )
    + ")))"
)
_LIMIT_FILLED = {"used_second": 0, "used_day": 1, "max_minute": 1, "max_month": 2}


@register(
    "usage_limits",
    f"SELECT {RUN_SQL} AS timestamp, 'job' AS use_case, 'pre' AS record_timing, "
    + ", ".join(
        (
            f"CAST(o_orderkey % 1000 + {_LIMIT_FILLED[f'{g}_{u}']} AS INTEGER)"
            if f"{g}_{u}" in _LIMIT_FILLED
            else "CAST(NULL AS INTEGER)"
        )
        + f" AS {k}_{g}_{u}"
        for k in S.LIMIT_KEYS
        for g in S.LIMIT_GROUPS
        for u in S.LIMIT_UNITS
    )
    + " FROM orders",
)
def _limits(t: Tables) -> DataFrame:
    payloads = parse_payload(_with_payload(t.orders, _LIMIT_JSON), S.RATE_LIMIT)
    return flatten.rate_limit_rows(payloads, "job", "pre", run_ts())


_PAIRS_JSON = """to_json(named_struct('Response', 'Success', 'Data', named_struct('exchanges', map(s_name, named_struct(
  'isActive', true, 'isTopTier', s_nationkey < 12, 'pairs', map(
    'BTC', named_struct('tsyms', map(
      'USD', named_struct('histo_minute_start_ts', 1600000000 + s_suppkey, 'histo_minute_end_ts', 0, 'isActive', true),
      'EUR', named_struct('histo_minute_start_ts', 0, 'histo_minute_end_ts', 1700000000, 'isActive', false))),
    'ETH', named_struct('tsyms', map(
      'USD', named_struct('histo_minute_start_ts', 1500000000, 'histo_minute_end_ts', 1700000000, 'isActive', true)))))))))"""
_TREE_SQL = """
SELECT s_name AS exchange, true AS exchange_active, s_nationkey < 12 AS is_top_tier, base, quote, active AS pair_active,
  CASE WHEN base = 'BTC' AND quote = 'USD' THEN to_timestamp(1600000000 + s_suppkey) AT TIME ZONE 'UTC'
       WHEN base = 'ETH' THEN to_timestamp(1500000000) AT TIME ZONE 'UTC' END AS history_start,
  CASE WHEN base = 'BTC' AND quote = 'USD' THEN NULL ELSE to_timestamp(1700000000) AT TIME ZONE 'UTC' END AS history_end
FROM supplier, (VALUES ('BTC', 'USD', true), ('BTC', 'EUR', false), ('ETH', 'USD', true)) v(base, quote, active)
"""


@register("exchange_tree", _TREE_SQL)
def _exchange_tree(t: Tables) -> DataFrame:
    return flatten.exchange_pair_rows(parse_payload(_with_payload(t.supplier, _PAIRS_JSON), S.EXCHANGE_PAIRS))


@register("exchange_tree_filtered", f"SELECT * FROM ({_TREE_SQL}) WHERE base = 'BTC' AND is_top_tier")
def _exchange_tree_filtered(t: Tables) -> DataFrame:
    payloads = parse_payload(_with_payload(t.supplier, _PAIRS_JSON), S.EXCHANGE_PAIRS)
    return flatten.exchange_pair_rows(payloads, base="BTC", top_tier_only=True)


# --- candles and trades: one envelope per line item or event ------------------------


def _candle_json(kind: str) -> str:
    """Each field gets a value that follows from its type and position."""
    fields = []
    for i, field in enumerate(S.CANDLE_PAYLOADS[kind].split(", ")):
        name, kind_ = field.split(" ")
        if name == "INSTRUMENT":
            value = "concat('A', l_suppkey, '-USD')"
        elif name == "HIGH_TRADE_TIMESTAMP" or name == "HIGH_MESSAGE_TIMESTAMP":
            value = "if(l_linenumber = 1, null, 0)"
        else:
            value = {
                "bigint": f"1700000000 + l_orderkey + {i}",
                "double": f"l_extendedprice + {i}",
                "string": f"concat('v{i}-', l_returnflag)",
            }[kind_]
        fields.append(f"'{name}', {value}")
    return f"to_json(named_struct('Response', 'Success', 'Data', array(named_struct({', '.join(fields)}))))"


def _candle_sql(kind: str) -> str:
    table, names = flatten._CANDLE_FIELDS[kind]
    payload = {f.split(" ")[0]: (i, f.split(" ")[1]) for i, f in enumerate(S.CANDLE_PAYLOADS[kind].split(", "))}
    types = {c.split(" ")[0]: c.split(" ")[1] for c in S.TABLES[table].columns}
    out = []
    for column, field in names.items():
        i, kind_ = payload[field]
        if field == "INSTRUMENT":
            value = "'A' || l_suppkey || '-USD'"
        elif field in ("HIGH_TRADE_TIMESTAMP", "HIGH_MESSAGE_TIMESTAMP"):
            value = "CASE WHEN l_linenumber = 1 THEN NULL ELSE TIMESTAMP '1970-01-01' END"
        elif types[column] == S.TS:
            value = f"to_timestamp(1700000000 + l_orderkey + {i}) AT TIME ZONE 'UTC'"
        elif kind_ == "bigint":
            value = f"1700000000 + l_orderkey + {i}"
        elif kind_ == "double":
            value = f"round(l_extendedprice + {i}, 4)"
        else:
            value = f"'v{i}-' || l_returnflag"
        out.append(f"{value} AS {column}")
    if kind == "index_ohlcv":
        out += ["'A' || l_suppkey AS asset", "'USD' AS quote"]
    return f"SELECT {', '.join(out)}, {RUN_SQL} AS collected_at FROM lineitem"


for _kind in S.CANDLE_PAYLOADS:

    @register(f"conform_{_kind}", _candle_sql(_kind))
    def _conform(t: Tables, kind: str = _kind) -> DataFrame:
        payloads = parse_payload(_with_payload(t.lineitem, _candle_json(kind)), S.candle_envelope(kind))
        rows = flatten.candle_rows(payload_records(payloads), kind, run_ts())
        doubles = [c for c, t_ in rows.dtypes if t_ == "double"]
        return rows.withColumns({c: F.round(c, 4) for c in doubles})


@register(
    "request_columns",
    """SELECT 'A' || l_suppkey AS asset, CASE l_linenumber % 2 WHEN 0 THEN 'EUR' ELSE 'USD' END AS quote,
       to_timestamp(l_orderkey) AT TIME ZONE 'UTC' AS datetime, round(l_extendedprice, 4) AS close FROM lineitem""",
)
def _request_columns(t: Tables) -> DataFrame:
    """Index candles whose instrument name says nothing: asset and quote come from the request."""
    candle = "'UNIT', 'DAY', 'TIMESTAMP', l_orderkey, 'INSTRUMENT', concat('X', l_linenumber), 'CLOSE', l_extendedprice"
    sql = f"to_json(named_struct('Data', array(named_struct({candle}))))"
    requested = t.lineitem.selectExpr("l_suppkey", "l_linenumber", f"{sql} as payload")
    parsed = requested.withColumn("d", F.from_json("payload", S.candle_envelope("index_ohlcv"))["Data"][0])
    quote = F.when(F.col("l_linenumber") % 2 == 0, "EUR").otherwise("USD")
    rows = flatten.candle_rows(parsed, "index_ohlcv", run_ts(), F.concat(F.lit("A"), F.col("l_suppkey")), quote)
    return rows.select("asset", "quote", "datetime", F.round("close", 4).alias("close"))


@register(
    "json_fields",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def _json_fields(t: Tables) -> DataFrame:
    parsed = t.events.withColumn("p", F.from_json("props", "k bigint, inner struct<deep string>"))
    return parsed.select("event_id", "p.k", F.col("p.inner.deep").alias("absent"))


@register(
    "trade_records",
    """SELECT 'm' || (user_id % 5) AS market, event_type AS instrument, event_type || '-X' AS mapped_instrument,
       CAST(NULL AS VARCHAR) AS base, CAST(NULL AS VARCHAR) AS quote, 'BUY' AS side, ts,
       CAST((epoch_us(ts) % 1000000) * 1000 AS BIGINT) AS ts_ns, event_id AS seq, value AS price,
       CAST(2.0 AS DOUBLE) AS quantity FROM events""",
)
def _trade_records(t: Tables) -> DataFrame:
    micros = "unix_micros(cast(ts as timestamp))"
    sql = f"""to_json(named_struct('Data', array(named_struct('MARKET', concat('m', user_id % 5), 'INSTRUMENT', event_type,
      'MAPPED_INSTRUMENT', concat(event_type, '-X'), 'SIDE', 'BUY', 'TIMESTAMP', {micros} div 1000000,
      'TIMESTAMP_NS', ({micros} % 1000000) * 1000, 'QUANTITY', 2.0, 'PRICE', value, 'CCSEQ', event_id))))"""
    return flatten.trade_rows(payload_records(parse_payload(_with_payload(t.events, sql), S.TRADES)))


@register(
    "messages",
    """SELECT event_id, CAST(-1 AS BIGINT) AS k,
       'not json ' || event_id AS text FROM events WHERE event_type = 'error'
       UNION ALL SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT), NULL FROM events WHERE event_type <> 'error'""",
)
def _messages(t: Tables) -> DataFrame:
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), "event_id")).otherwise(F.col("props"))
    parsed = parse_messages(t.events.select("event_id", value.alias("value")))
    return parsed.select("event_id", F.coalesce(F.try_variant_get("message", "$.k", "bigint"), F.lit(-1)).alias("k"), "text")


@register(
    "to_json_text",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN '[]' ELSE '["' || p_brand || '","' || p_type || '"]' END AS items FROM part""",
)
def _to_json_text(t: Tables) -> DataFrame:
    arr = F.when(F.col("p_size") <= 40, F.array("p_brand", "p_type"))
    return t.part.select("p_partkey", flatten.array_json(arr).alias("items"))


@register("column_list", "SELECT * FROM nation")
def _column_list(t: Tables) -> DataFrame:
    ranked = t.nation.withColumn("rn", F.lit(1))
    return ranked.select(*table_columns(ranked))


