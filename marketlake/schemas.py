"""Explicit schemas: the 26 tables, their keys, and the landed payloads.

Repeated column families (trade sides, currency roles, window lengths) are
generated; everything else is listed as DDL text.  The names are fixed values
shared with the data that is already stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

TS = "timestamp_ntz"
INTERVALS = ("1m", "1h", "1d")

SIDES = ("", "_buy", "_sell", "_unknown")
VOLUMES = [f"{kind}{side} double" for side in SIDES for kind in ("volume", "quote_volume")]
TRADE_COUNTS = [f"total_trades{side} bigint" for side in SIDES]
OHLC = ["open double", "high double", "low double", "close double"]
AUDIT = [f"created_at {TS} not null", f"updated_at {TS} not null"]

TRADE_POINTS = [
    f"first_trade_timestamp {TS}",
    f"last_trade_timestamp {TS}",
    "first_trade_price double",
    "high_trade_price double",
    f"high_trade_timestamp {TS}",
    "low_trade_price double",
    f"low_trade_timestamp {TS}",
    "last_trade_price double",
]

SERIES_ID = [
    f"datetime {TS} not null",
    "market string not null",
    "instrument string not null",
    "mapped_instrument string",
    "type string",
    "index_underlying string",
    "quote_currency string",
    "settlement_currency string",
    "contract_currency string",
    "denomination_type string",
]
COLLECTED = [f"collected_at {TS}"]

FUTURES_OHLCV = (
    SERIES_ID + OHLC + ["number_of_contracts double"] + VOLUMES + TRADE_COUNTS + TRADE_POINTS + COLLECTED
)
FUNDING_RATE = (
    SERIES_ID
    + ["interval_ms bigint", "open_fr double", "high_fr double", "low_fr double", "close_fr double"]
    + ["total_funding_rate_updates bigint"]
    + COLLECTED
)
OPEN_INTEREST = (
    SERIES_ID
    + [f"{p}_oi_{u} double" for u in ("contracts", "quote") for p in ("open", "high", "low", "close")]
    + [
        "open_mark_price double",
        "high_oi_mark_price double",
        "high_mark_price double",
        "high_mark_price_oi double",
        "high_quote_mark_price double",
        "low_oi_mark_price double",
        "low_mark_price double",
        "low_mark_price_oi double",
        "low_quote_mark_price double",
        "close_mark_price double",
        "total_open_interest_updates bigint",
    ]
    + COLLECTED
)

SPOT_OHLCV = (
    [
        f"datetime {TS} not null",
        "exchange string not null",
        "symbol_unmapped string not null",
        "symbol string",
        "base string",
        "quote string",
        "base_id bigint",
        "quote_id bigint",
        "transform_function string",
    ]
    + OHLC
    + TRADE_POINTS
    + TRADE_COUNTS
    + VOLUMES
    + [f"collected_at {TS} not null"]
)

INDEX_TIERS = ("", "_top_tier", "_direct", "_top_tier_direct")
INDEX_OHLCV = (
    [
        "unit string",
        f"datetime {TS} not null",
        "type string",
        "market string not null",
        "asset string not null",
        "quote string",
    ]
    + OHLC
    + [
        f"first_message_timestamp {TS}",
        f"last_message_timestamp {TS}",
        "first_message_value double",
        "high_message_value double",
        f"high_message_timestamp {TS}",
        "low_message_value double",
        f"low_message_timestamp {TS}",
        "last_message_value double",
        "total_index_updates bigint",
    ]
    + [f"{kind}{tier} double" for tier in INDEX_TIERS for kind in ("volume", "quote_volume")]
    + [f"collected_at {TS} not null"]
)

ASSETS = [
    "asset_id bigint not null",
    "symbol string",
    "name string",
    "uri string",
    "asset_type string",
    "cc_internal_type string",
    "id_legacy bigint",
    "id_parent_asset bigint",
    "id_asset_issuer bigint",
    "asset_issuer_name string",
    "parent_asset_symbol string",
    f"cc_created_on {TS}",
    f"cc_updated_on {TS}",
    "public_notice string",
    "logo_url string",
    f"launch_date {TS}",
    "description_summary string",
    "decimal_points int",
    "symbol_glyph string",
] + AUDIT

ALT_ID_NAMES = ("cmc", "cg", "isin", "valor", "dti", "chain")
ASSET_ALTERNATIVE_IDS = ["asset_id bigint not null"] + [f"{n}_id string" for n in ALT_ID_NAMES] + AUDIT

MOVING_WINDOWS = ("24_hour", "7_day", "30_day")
ASSET_MARKET_DATA = (
    [
        "asset_id bigint not null",
        f"snapshot_ts {TS}",
        "price_usd double",
        "price_usd_source string",
        "mkt_cap_penalty double",
        "circulating_mkt_cap_usd double",
        "total_mkt_cap_usd double",
    ]
    + [f"spot_moving_{w}_quote_volume{t}_usd double" for w in MOVING_WINDOWS for t in ("_top_tier", "")]
    + AUDIT
)

EXCHANGES_GENERAL = [
    "exchange_api_id string not null",
    "name string",
    "internal_name string",
    "api_url_path string",
    "logo_url_path string",
    "item_types string",
    "centralization_type string",
    "grade_points double",
    "grade string",
    "grade_points_legal double",
    "grade_points_kyc_risk double",
    "grade_points_team double",
    "grade_points_data_provision double",
    "grade_points_asset_quality double",
    "grade_points_market_quality double",
    "grade_points_security double",
    "grade_points_neg_reports_penalty double",
    "affiliate_url string",
    "country string",
    "has_orderbook boolean",
    "has_trades boolean",
    "description string",
    "full_address string",
    "is_sponsored boolean",
    "is_recommended boolean",
    "rating_avg double",
    "rating_total_users int",
    "sort_order int",
    "total_volume_24h_usd double",
] + AUDIT

EXCHANGE_STATUS_COUNTS = ("ACTIVE", "IGNORED", "RETIRED", "EXPIRED", "RETIRED_UNMAPPED")
EXCHANGE_HEAD = [
    "exchange_internal_name string",
    "api_exchange_type string",
    "exchange_status string",
    "mapped_instruments_total int",
    "unmapped_instruments_total int",
] + [f"instruments_{s.lower()}_count int" for s in EXCHANGE_STATUS_COUNTS]
EXCHANGE_TAIL = ["has_orderbook_l2_snapshots boolean", f"api_data_retrieved_datetime {TS}"] + AUDIT

EXCHANGE_SPOT_DETAILS = EXCHANGE_HEAD + ["total_trades_exchange_level bigint"] + EXCHANGE_TAIL
EXCHANGES_FUTURES_DETAILS = (
    EXCHANGE_HEAD
    + [
        "total_trades_exchange_level bigint",
        "total_open_interest_updates bigint",
        "total_funding_rate_updates bigint",
    ]
    + EXCHANGE_TAIL
)

INSTRUMENT_HEAD = [
    "exchange_internal_name string",
    "mapped_instrument_symbol string",
    "api_instrument_type string",
    "instrument_status_on_exchange string",
    "exchange_instrument_symbol_raw string",
]
INSTRUMENT_TRADES = [
    f"instrument_mapping_created_datetime {TS}",
    "has_trades boolean",
    f"first_trade_datetime {TS}",
    f"last_trade_datetime {TS}",
    "total_trades_instrument_level bigint",
]
INSTRUMENTS_SPOT = (
    INSTRUMENT_HEAD
    + [
        "base_asset_symbol string",
        "base_asset_id bigint",
        "quote_asset_symbol string",
        "quote_asset_id bigint",
        "transform_function string",
    ]
    + INSTRUMENT_TRADES
    + AUDIT
)

CURRENCY_ROLES = ("index_underlying", "quote_currency", "settlement_currency", "contract_currency")
UPDATE_KINDS = ("funding_rate", "open_interest")
INSTRUMENTS_FUTURES = (
    INSTRUMENT_HEAD
    + [f"{role}_{part}" for role in CURRENCY_ROLES for part in ("symbol string", "id bigint")]
    + ["denomination_type string", "transform_function string"]
    + INSTRUMENT_TRADES
    + [
        column
        for kind in UPDATE_KINDS
        for column in (
            f"has_{kind}_updates boolean",
            f"first_{kind}_update_datetime {TS}",
            f"last_{kind}_update_datetime {TS}",
            f"total_{kind}_updates bigint",
        )
    ]
    + [f"contract_expiration_datetime {TS}"]
    + AUDIT
)

LIMIT_KEYS = ("api_key", "auth_key")
LIMIT_GROUPS = ("used", "max", "remaining")
LIMIT_UNITS = ("second", "minute", "hour", "day", "month")
RATE_LIMIT_STATUS = [
    f"timestamp {TS} not null",
    "use_case string not null",
    "record_timing string not null",
] + [f"{k}_{g}_{u} int" for k in LIMIT_KEYS for g in LIMIT_GROUPS for u in LIMIT_UNITS]

ASSET_COIN_UID_MAP = [
    "asset_id bigint not null",
    "symbol string",
    "coin_uid string",
    "match_type string",
    "match_score double",
    f"mapped_at {TS}",
]


@dataclass(frozen=True)
class Table:
    """Columns (DDL), identifying key, newest-wins column and layout."""

    columns: tuple[str, ...]
    key: tuple[str, ...] = ()
    latest: str | None = None
    partition_source: str | None = None  # timestamp whose period partitions the files
    partition_unit: str = "DAY"  # how much time one partition folder holds

    @property
    def schema(self) -> T.StructType:
        quoted = [f"`{n}` {t}" for n, t in (c.split(" ", 1) for c in self.columns)]
        return T.StructType.fromDDL(", ".join(quoted))

    @property
    def names(self) -> list[str]:
        return [c.split(" ", 1)[0] for c in self.columns]


def _child(value: str, extra: str | None = None) -> Table:
    columns = ["asset_id bigint not null", f"{value} string"] + ([f"{extra} string"] if extra else []) + AUDIT
    return Table(tuple(columns), ("asset_id", value), "updated_at")


# Folder size follows the bar length, so that daily bars do not end up in tiny files.
PARTITION_UNITS = {"1m": "DAY", "1h": "MONTH", "1d": "YEAR"}


def _series(columns: list[str], interval: str) -> Table:
    key = ("datetime", "market", "mapped_instrument")
    return Table(tuple(columns), key, "collected_at", "datetime", PARTITION_UNITS[interval])


INSTRUMENT_KEY = ("exchange_internal_name", "mapped_instrument_symbol")

TABLES: dict[str, Table] = {
    "ohlcv_spot_1d_raw": Table(tuple(SPOT_OHLCV), ("datetime", "exchange", "symbol"), "collected_at", "datetime", "YEAR"),
    "ohlcv_spot_indices_1d_raw": Table(
        tuple(INDEX_OHLCV), ("datetime", "market", "asset"), "collected_at", "datetime", "YEAR"
    ),
    "assets": Table(tuple(ASSETS), ("asset_id",), "updated_at"),
    "asset_alternative_ids": Table(tuple(ASSET_ALTERNATIVE_IDS), ("asset_id",), "updated_at"),
    "asset_industries_map": _child("industry_name", "justification"),
    "asset_consensus_mechanisms_map": _child("mechanism_name"),
    "asset_consensus_algorithm_types_map": _child("algorithm_name", "description"),
    "asset_hashing_algorithm_types_map": _child("algorithm_name"),
    "asset_previous_symbols_map": _child("previous_symbol"),
    "asset_market_data": Table(tuple(ASSET_MARKET_DATA), (), None, "snapshot_ts"),
    "exchanges_general": Table(tuple(EXCHANGES_GENERAL), ("exchange_api_id",), "updated_at"),
    "exchange_spot_details": Table(tuple(EXCHANGE_SPOT_DETAILS), ("exchange_internal_name",), "updated_at"),
    "instruments_spot": Table(tuple(INSTRUMENTS_SPOT), INSTRUMENT_KEY, "updated_at"),
    "rate_limit_status": Table(tuple(RATE_LIMIT_STATUS), (), None, "timestamp"),
    "exchanges_futures_details": Table(tuple(EXCHANGES_FUTURES_DETAILS), ("exchange_internal_name",), "updated_at"),
    "instruments_futures": Table(tuple(INSTRUMENTS_FUTURES), INSTRUMENT_KEY, "updated_at"),
    "asset_coin_uid_map": Table(tuple(ASSET_COIN_UID_MAP), ("asset_id",), "mapped_at"),
    **{f"futures_ohlcv_{i}": _series(FUTURES_OHLCV, i) for i in INTERVALS},
    **{f"futures_open_interest_ohlc_{i}": _series(OPEN_INTEREST, i) for i in INTERVALS},
    **{f"futures_funding_rate_ohlc_{i}": _series(FUNDING_RATE, i) for i in INTERVALS},
}


def required_columns(table: str) -> list[str]:
    """Columns declared NOT NULL, plus the key columns."""
    spec = TABLES[table]
    declared = [c.split(" ", 1)[0] for c in spec.columns if c.endswith(" not null")]
    return declared + [k for k in spec.key if k not in declared]


def create_table_sql(table: str, name: str | None = None, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for one table, date-partitioned when it is a series."""
    spec = TABLES[table]
    body = ", ".join(f"`{n}` {t.split(' ')[0]}" for n, t in (c.split(" ", 1) for c in spec.columns))
    sql = f"CREATE TABLE IF NOT EXISTS {name or table} ({body}"
    if spec.partition_source:
        sql += ", `date` date"
    sql += ") USING parquet"
    if spec.partition_source:
        sql += " PARTITIONED BY (`date`)"
    if location:
        sql += f" LOCATION '{location}'"
    return sql


def create_table(spark: SparkSession, table: str, name: str | None = None, location: str | None = None) -> None:
    spark.sql(create_table_sql(table, name, location))


# --- payload schemas -------------------------------------------------------
# Payload field names are the upper-case column names unless renamed; the
# renames are fixed values.

_EPOCH_COLUMNS = {"datetime"} | {
    f"{p}_{k}_timestamp" for p in ("first", "last", "high", "low") for k in ("trade", "message")
}

FUTURES_FIELDS = {n: n.upper() for n in TABLES["futures_ohlcv_1d"].names[:-1]} | {"datetime": "TIMESTAMP"}
FUNDING_FIELDS = {n: n.upper() for n in TABLES["futures_funding_rate_ohlc_1d"].names[:-1]} | {
    "datetime": "TIMESTAMP",
    "open_fr": "OPEN",
    "high_fr": "HIGH",
    "low_fr": "LOW",
    "close_fr": "CLOSE",
}
OPEN_INTEREST_FIELDS = {n: n.upper() for n in TABLES["futures_open_interest_ohlc_1d"].names[:-1]} | {
    "datetime": "TIMESTAMP",
    "open_oi_contracts": "OPEN_SETTLEMENT",
    "high_oi_contracts": "HIGH_SETTLEMENT",
    "low_oi_contracts": "LOW_SETTLEMENT",
    "close_oi_contracts": "CLOSE_SETTLEMENT",
    "open_oi_quote": "OPEN_QUOTE",
    "high_oi_quote": "HIGH_QUOTE",
    "low_oi_quote": "LOW_QUOTE",
    "close_oi_quote": "CLOSE_QUOTE",
    "high_oi_mark_price": "HIGH_SETTLEMENT_MARK_PRICE",
    "high_mark_price_oi": "HIGH_MARK_PRICE_SETTLEMENT",
    "low_oi_mark_price": "LOW_SETTLEMENT_MARK_PRICE",
    "low_mark_price_oi": "LOW_MARK_PRICE_SETTLEMENT",
}
SPOT_FIELDS = {n: n.upper() for n in TABLES["ohlcv_spot_1d_raw"].names[:-1]} | {
    "datetime": "TIMESTAMP",
    "exchange": "MARKET",
    "symbol_unmapped": "INSTRUMENT",
    "symbol": "MAPPED_INSTRUMENT",
}
# asset and quote come from the request, not from the payload
INDEX_FIELDS = {n: n.upper() for n in TABLES["ohlcv_spot_indices_1d_raw"].names[:-1] if n not in ("asset", "quote")} | {
    "datetime": "TIMESTAMP",
}


def payload_record(table: str, fields: dict[str, str], extra: str = "") -> str:
    """DDL of one payload record for a series table."""
    types = {c.split(" ")[0]: c.split(" ")[1] for c in TABLES[table].columns}
    record = [f"{src} {'bigint' if dst in _EPOCH_COLUMNS else types[dst]}" for dst, src in fields.items()]
    return ", ".join(record + ([extra] if extra else []))


CANDLE_PAYLOADS = {
    "futures_ohlcv": payload_record("futures_ohlcv_1d", FUTURES_FIELDS, "UNIT string"),
    "funding_rate": payload_record("futures_funding_rate_ohlc_1d", FUNDING_FIELDS, "UNIT string"),
    "open_interest": payload_record("futures_open_interest_ohlc_1d", OPEN_INTEREST_FIELDS, "UNIT string"),
    "spot_ohlcv": payload_record("ohlcv_spot_1d_raw", SPOT_FIELDS, "UNIT string"),
    "index_ohlcv": payload_record("ohlcv_spot_indices_1d_raw", INDEX_FIELDS, "INSTRUMENT string"),
}


def envelope(data_ddl: str) -> str:
    return f"Response string, Message string, Data {data_ddl}"


def candle_envelope(kind: str) -> str:
    return envelope(f"array<{_struct(CANDLE_PAYLOADS[kind])}>")


ASSET_RECORD = (
    "ID bigint, SYMBOL string, NAME string, URI string, ASSET_TYPE string, TYPE string, ID_LEGACY bigint, "
    "ID_PARENT_ASSET bigint, ID_ASSET_ISSUER bigint, ASSET_ISSUER_NAME string, PARENT_ASSET_SYMBOL string, "
    "CREATED_ON bigint, UPDATED_ON bigint, PUBLIC_NOTICE string, LOGO_URL string, LAUNCH_DATE bigint, "
    "ASSET_DESCRIPTION_SUMMARY string, ASSET_DECIMAL_POINTS int, ASSET_SYMBOL_GLYPH string, "
    "PREVIOUS_ASSET_SYMBOLS array<variant>, "
    "ASSET_ALTERNATIVE_IDS array<struct<NAME: string, ID: string>>, "
    "ASSET_INDUSTRIES array<struct<ASSET_INDUSTRY: string, JUSTIFICATION: string>>, "
    "CONSENSUS_MECHANISMS array<struct<NAME: string>>, "
    "CONSENSUS_ALGORITHM_TYPES array<struct<NAME: string, DESCRIPTION: string>>, "
    "HASHING_ALGORITHM_TYPES array<struct<NAME: string>>, "
    "PRICE_USD double, PRICE_USD_SOURCE string, PRICE_USD_LAST_UPDATE_TS bigint, MKT_CAP_PENALTY double, "
    "CIRCULATING_MKT_CAP_USD double, TOTAL_MKT_CAP_USD double, "
    + ", ".join(
        f"SPOT_MOVING_{w.upper()}_QUOTE_VOLUME{t}_USD double" for w in MOVING_WINDOWS for t in ("_TOP_TIER", "")
    )
)


def _struct(ddl: str) -> str:
    """``a int, b string`` -> ``struct<a int, b string>``."""
    return f"struct<{ddl}>"


ASSET_PAGE = envelope(
    f"struct<STATS: struct<PAGE: bigint, PAGE_SIZE: bigint, TOTAL_ASSETS: bigint>, LIST: array<{_struct(ASSET_RECORD)}>>"
)

_EXCHANGE_FIELDS = (
    "TYPE string, EXCHANGE_STATUS string, MAPPED_INSTRUMENTS_TOTAL int, UNMAPPED_INSTRUMENTS_TOTAL int, "
    "INSTRUMENT_STATUS map<string, int>, HAS_ORDERBOOK_L2_MINUTE_SNAPSHOTS_ENABLED string"
)
SPOT_INSTRUMENT = (
    "TYPE string, INSTRUMENT_STATUS string, INSTRUMENT string, "
    "INSTRUMENT_MAPPING struct<BASE: string, BASE_ID: bigint, QUOTE: string, QUOTE_ID: bigint, "
    "TRANSFORM_FUNCTION: string, CREATED_ON: bigint>, HAS_TRADES_SPOT boolean, "
    "FIRST_TRADE_SPOT_TIMESTAMP bigint, LAST_TRADE_SPOT_TIMESTAMP bigint, TOTAL_TRADES_SPOT bigint"
)
SPOT_TREE = envelope(
    "map<string, "
    + _struct(f"{_EXCHANGE_FIELDS}, TOTAL_TRADES_SPOT bigint, instruments map<string, {_struct(SPOT_INSTRUMENT)}>")
    + ">"
)
# Flags arrive as booleans or text, hence string; the conversion decides.
FUTURES_INSTRUMENT = (
    "TYPE string, INSTRUMENT_STATUS string, INSTRUMENT string, INSTRUMENT_MAPPING struct<"
    + ", ".join(f"{r.upper()}: string, {r.upper()}_ID: bigint" for r in CURRENCY_ROLES)
    + ", DENOMINATION_TYPE: string, TRANSFORM_FUNCTION: string, CREATED_ON: bigint>, "
    "HAS_TRADES_FUTURES string, FIRST_TRADE_FUTURES_TIMESTAMP bigint, LAST_TRADE_FUTURES_TIMESTAMP bigint, "
    "TOTAL_TRADES_FUTURES bigint, "
    + ", ".join(
        f"HAS_{k}_UPDATES string, FIRST_{k}_UPDATE_TIMESTAMP bigint, LAST_{k}_UPDATE_TIMESTAMP bigint, "
        f"TOTAL_{k}_UPDATES bigint"
        for k in (kind.upper() for kind in UPDATE_KINDS)
    )
    + ", CONTRACT_EXPIRATION_TS bigint"
)
FUTURES_TREE = envelope(
    "map<string, "
    + _struct(
        f"{_EXCHANGE_FIELDS}, TOTAL_TRADES_FUTURES bigint, TOTAL_OPEN_INTEREST_UPDATES bigint, "
        f"TOTAL_FUNDING_RATE_UPDATES bigint, instruments map<string, {_struct(FUTURES_INSTRUMENT)}>"
    )
    + ">"
)

EXCHANGE_GENERAL = envelope(
    "map<string, "
    + _struct(
        "Name string, InternalName string, Url string, LogoUrl string, ItemType array<string>, "
        "CentralizationType string, Grade string, GradePoints double, GradePointsSplit map<string, double>, "
        "AffiliateURL string, Country string, OrderBook boolean, Trades boolean, Sponsored boolean, "
        "Recommended boolean, Description string, FullAddress string, "
        "Rating struct<Avg: double, TotalUsers: int>, SortOrder string, TOTALVOLUME24H map<string, double>"
    )
    + ">"
)

EXCHANGE_PAIRS = envelope(
    "struct<exchanges: map<string, struct<isActive: boolean, isTopTier: boolean, pairs: map<string, "
    "struct<tsyms: map<string, struct<histo_minute_start_ts: bigint, histo_minute_end_ts: bigint, "
    "isActive: boolean>>>>>>>"
)

RATE_LIMIT = "Data " + _struct(
    ", ".join(
        f"{k.upper()} struct<"
        + ", ".join(
            f"{g.upper()}: struct<" + ", ".join(f"{u.upper()}: int" for u in LIMIT_UNITS) + ">" for g in LIMIT_GROUPS
        )
        + ">"
        for k in LIMIT_KEYS
    )
)

TRADE = (
    "MARKET string, INSTRUMENT string, MAPPED_INSTRUMENT string, BASE string, QUOTE string, SIDE string, ID string, "
    "TIMESTAMP bigint, TIMESTAMP_NS bigint, RECEIVED_TIMESTAMP bigint, RECEIVED_TIMESTAMP_NS bigint, "
    "QUANTITY double, PRICE double, QUOTE_QUANTITY double, SOURCE string, CCSEQ bigint"
)
TRADES = envelope(f"array<{_struct(TRADE)}>")

COIN_MASTER = "coin_uid string, ticker string, name string, coingecko_id string, coinmarketcap_id string"
