"""Nested payloads to typed flat tables.

Each function takes parsed payloads (see ``sources.payloads``) and one run
timestamp, so that a repeated run gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlake import schemas as S
from marketlake.functions import epoch_to_ts, epoch_to_ts_nonzero, flag_to_int
from marketlake.functions.time import NTZ


def conform(df: DataFrame, table: str, values: dict[str, Column]) -> DataFrame:
    """Select the columns of ``table`` in declared order and type."""
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in S.TABLES[table].schema.fields])


def _audit(run_ts: Column) -> dict[str, Column]:
    return {"created_at": run_ts, "updated_at": run_ts}


def last_entry(entries: str | Column, name: str) -> Column:
    """Value of the last usable (NAME, ID) entry with this name; null when there is none."""
    entries = F.col(entries) if isinstance(entries, str) else entries
    usable = F.filter(
        entries,
        lambda e: (F.lower(e["NAME"]) == name) & F.coalesce(e["ID"] != "", F.lit(False)),
    )
    return F.try_element_at(usable, F.lit(-1))["ID"]


def element_text(v: Column, field: str = "SYMBOL") -> Column:
    """Text of a variant element: an object's ``field`` when filled, else its JSON; scalars as text."""
    named = F.nullif(F.try_variant_get(v, f"$.{field}", "string"), F.lit(""))
    return F.coalesce(named, v.cast("string"))


def array_json(arr: str | Column) -> Column:
    """JSON text of an array; null gives ``[]``."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.coalesce(F.to_json(arr), F.lit("[]"))


def explode_children(df: DataFrame, parent: Sequence[str], children: str | Column, name: str = "child") -> DataFrame:
    """One row per array element with its parent columns; null and empty arrays give none."""
    return df.select(*parent, F.explode(children).alias(name))


# --- assets ----------------------------------------------------------------


def asset_rows(records: DataFrame, run_ts: Column) -> DataFrame:
    same_name = ("symbol", "name", "uri", "asset_type", "id_legacy", "id_parent_asset", "id_asset_issuer")
    same_name += ("asset_issuer_name", "parent_asset_symbol", "public_notice", "logo_url")
    present = {n: F.col(f"d.{n.upper()}") for n in same_name}
    return conform(
        records,
        "assets",
        present
        | {
            "asset_id": F.col("d.ID"),
            "cc_internal_type": F.col("d.TYPE"),
            "cc_created_on": epoch_to_ts("d.CREATED_ON"),
            "cc_updated_on": epoch_to_ts("d.UPDATED_ON"),
            "launch_date": epoch_to_ts("d.LAUNCH_DATE"),
            "description_summary": F.col("d.ASSET_DESCRIPTION_SUMMARY"),
            "decimal_points": F.col("d.ASSET_DECIMAL_POINTS"),
            "symbol_glyph": F.col("d.ASSET_SYMBOL_GLYPH"),
        }
        | _audit(run_ts),
    )


def asset_alternative_id_rows(records: DataFrame, run_ts: Column) -> DataFrame:
    """(NAME, ID) entries to one column per known name; assets without an id are skipped."""
    ids = {f"{n}_id": last_entry("d.ASSET_ALTERNATIVE_IDS", n) for n in S.ALT_ID_NAMES}
    identified = records.where(F.col("d.ID").isNotNull() & (F.col("d.ID") != 0))
    return conform(identified, "asset_alternative_ids", {"asset_id": F.col("d.ID")} | ids | _audit(run_ts))


# Child table, payload array and its fields per target column.
ASSET_CHILDREN = {
    "asset_industries_map": (
        "ASSET_INDUSTRIES",
        {"industry_name": "ASSET_INDUSTRY", "justification": "JUSTIFICATION"},
    ),
    "asset_consensus_mechanisms_map": ("CONSENSUS_MECHANISMS", {"mechanism_name": "NAME"}),
    "asset_consensus_algorithm_types_map": (
        "CONSENSUS_ALGORITHM_TYPES",
        {"algorithm_name": "NAME", "description": "DESCRIPTION"},
    ),
    "asset_hashing_algorithm_types_map": ("HASHING_ALGORITHM_TYPES", {"algorithm_name": "NAME"}),
}


def asset_child_rows(records: DataFrame, table: str, run_ts: Column) -> DataFrame:
    field, columns = ASSET_CHILDREN[table]
    children = explode_children(records, [F.col("d.ID").alias("asset_id")], f"d.{field}")
    values = {c: F.col(f"child.{source}") for c, source in columns.items()}
    return conform(children, table, {"asset_id": F.col("asset_id")} | values | _audit(run_ts))


def asset_previous_symbol_rows(records: DataFrame, run_ts: Column) -> DataFrame:
    children = explode_children(records, [F.col("d.ID").alias("asset_id")], "d.PREVIOUS_ASSET_SYMBOLS")
    values = {"asset_id": F.col("asset_id"), "previous_symbol": element_text(F.col("child"))}
    return conform(children, "asset_previous_symbols_map", values | _audit(run_ts))


def asset_market_rows(records: DataFrame, run_ts: Column) -> DataFrame:
    table = "asset_market_data"
    skip = ("asset_id", "snapshot_ts", "created_at", "updated_at")
    values = {n: F.col(f"d.{n.upper()}") for n in S.TABLES[table].names if n not in skip}
    values |= {
        "asset_id": F.col("d.ID"),
        "snapshot_ts": epoch_to_ts_nonzero("d.PRICE_USD_LAST_UPDATE_TS"),
    }
    return conform(records, table, values | _audit(run_ts))


def asset_tables(records: DataFrame, run_ts: Column) -> dict[str, DataFrame]:
    """All eight tables of an asset refresh, from one frame of asset records ``d``."""
    return {
        "assets": asset_rows(records, run_ts),
        "asset_alternative_ids": asset_alternative_id_rows(records, run_ts),
        **{t: asset_child_rows(records, t, run_ts) for t in ASSET_CHILDREN},
        "asset_previous_symbols_map": asset_previous_symbol_rows(records, run_ts),
        "asset_market_data": asset_market_rows(records, run_ts),
    }


# --- exchanges and instruments --------------------------------------------


def _exchange_values(run_ts: Column) -> dict[str, Column]:
    counts = {
        f"instruments_{s.lower()}_count": F.col("d.INSTRUMENT_STATUS")[s] for s in S.EXCHANGE_STATUS_COUNTS
    }
    return (
        {
            "exchange_internal_name": F.col("name"),
            "api_exchange_type": F.col("d.TYPE"),
            "exchange_status": F.col("d.EXCHANGE_STATUS"),
            "mapped_instruments_total": F.col("d.MAPPED_INSTRUMENTS_TOTAL"),
            "unmapped_instruments_total": F.col("d.UNMAPPED_INSTRUMENTS_TOTAL"),
            "api_data_retrieved_datetime": run_ts,
        }
        | counts
        | _audit(run_ts)
    )


def spot_exchange_rows(entries: DataFrame, run_ts: Column) -> DataFrame:
    values = {
        "total_trades_exchange_level": F.col("d.TOTAL_TRADES_SPOT"),
        "has_orderbook_l2_snapshots": F.col("d.HAS_ORDERBOOK_L2_MINUTE_SNAPSHOTS_ENABLED"),
    }
    return conform(entries, "exchange_spot_details", _exchange_values(run_ts) | values)


def futures_exchange_rows(entries: DataFrame, run_ts: Column) -> DataFrame:
    values = {
        "total_trades_exchange_level": F.col("d.TOTAL_TRADES_FUTURES"),
        "total_open_interest_updates": F.col("d.TOTAL_OPEN_INTEREST_UPDATES"),
        "total_funding_rate_updates": F.col("d.TOTAL_FUNDING_RATE_UPDATES"),
        "has_orderbook_l2_snapshots": flag_to_int("d.HAS_ORDERBOOK_L2_MINUTE_SNAPSHOTS_ENABLED"),
    }
    return conform(entries, "exchanges_futures_details", _exchange_values(run_ts) | values)


def exchange_instruments(entries: DataFrame) -> DataFrame:
    """Map of maps to rows (name, symbol, i); an exchange without instruments gives none."""
    return entries.select("name", F.explode("d.instruments").alias("symbol", "i"))


def _instrument_values(kind: str, run_ts: Column) -> dict[str, Column]:
    return {
        "exchange_internal_name": F.col("name"),
        "mapped_instrument_symbol": F.col("symbol"),
        "api_instrument_type": F.col("i.TYPE"),
        "instrument_status_on_exchange": F.col("i.INSTRUMENT_STATUS"),
        "exchange_instrument_symbol_raw": F.col("i.INSTRUMENT"),
        "transform_function": F.col("i.INSTRUMENT_MAPPING.TRANSFORM_FUNCTION"),
        "instrument_mapping_created_datetime": epoch_to_ts_nonzero("i.INSTRUMENT_MAPPING.CREATED_ON"),
        "first_trade_datetime": epoch_to_ts_nonzero(f"i.FIRST_TRADE_{kind}_TIMESTAMP"),
        "last_trade_datetime": epoch_to_ts_nonzero(f"i.LAST_TRADE_{kind}_TIMESTAMP"),
        "total_trades_instrument_level": F.col(f"i.TOTAL_TRADES_{kind}"),
    } | _audit(run_ts)


def spot_instrument_rows(entries: DataFrame, run_ts: Column) -> DataFrame:
    mapping = "i.INSTRUMENT_MAPPING"
    values = {
        "base_asset_symbol": F.col(f"{mapping}.BASE"),
        "base_asset_id": F.col(f"{mapping}.BASE_ID"),
        "quote_asset_symbol": F.col(f"{mapping}.QUOTE"),
        "quote_asset_id": F.col(f"{mapping}.QUOTE_ID"),
        "has_trades": F.col("i.HAS_TRADES_SPOT"),
    }
    return conform(
        exchange_instruments(entries), "instruments_spot", _instrument_values("SPOT", run_ts) | values
    )


def futures_instrument_rows(entries: DataFrame, run_ts: Column) -> DataFrame:
    mapping = "i.INSTRUMENT_MAPPING"
    values = {
        "denomination_type": F.col(f"{mapping}.DENOMINATION_TYPE"),
        "has_trades": flag_to_int("i.HAS_TRADES_FUTURES"),
        "contract_expiration_datetime": epoch_to_ts_nonzero("i.CONTRACT_EXPIRATION_TS"),
    }
    for role in S.CURRENCY_ROLES:
        values[f"{role}_symbol"] = F.col(f"{mapping}.{role.upper()}")
        values[f"{role}_id"] = F.col(f"{mapping}.{role.upper()}_ID")
    for kind in S.UPDATE_KINDS:
        k = kind.upper()
        values[f"has_{kind}_updates"] = flag_to_int(f"i.HAS_{k}_UPDATES")
        values[f"first_{kind}_update_datetime"] = epoch_to_ts_nonzero(f"i.FIRST_{k}_UPDATE_TIMESTAMP")
        values[f"last_{kind}_update_datetime"] = epoch_to_ts_nonzero(f"i.LAST_{k}_UPDATE_TIMESTAMP")
        values[f"total_{kind}_updates"] = F.col(f"i.TOTAL_{k}_UPDATES")
    return conform(
        exchange_instruments(entries), "instruments_futures", _instrument_values("FUTURES", run_ts) | values
    )


# Grade split names per column.
GRADE_SPLITS = {
    "grade_points_legal": "Legal",
    "grade_points_kyc_risk": "KYCAndTransactionRisk",
    "grade_points_team": "Team",
    "grade_points_data_provision": "DataProvision",
    "grade_points_asset_quality": "AssetQualityAndDiversity",
    "grade_points_market_quality": "MarketQuality",
    "grade_points_security": "Security",
    "grade_points_neg_reports_penalty": "NegativeReportsPenalty",
}
# Plain payload fields per column.
GENERAL_FIELDS = {
    "name": "Name",
    "internal_name": "InternalName",
    "api_url_path": "Url",
    "logo_url_path": "LogoUrl",
    "centralization_type": "CentralizationType",
    "grade_points": "GradePoints",
    "grade": "Grade",
    "affiliate_url": "AffiliateURL",
    "country": "Country",
    "has_orderbook": "OrderBook",
    "has_trades": "Trades",
    "description": "Description",
    "full_address": "FullAddress",
    "is_sponsored": "Sponsored",
    "is_recommended": "Recommended",
}


def exchange_general_rows(entries: DataFrame, run_ts: Column) -> DataFrame:
    values = {c: F.col(f"d.{f}") for c, f in GENERAL_FIELDS.items()}
    values |= {c: F.col("d.GradePointsSplit")[f] for c, f in GRADE_SPLITS.items()}
    values |= {
        "exchange_api_id": F.col("name"),
        "item_types": array_json("d.ItemType"),
        "rating_avg": F.col("d.Rating.Avg"),
        "rating_total_users": F.col("d.Rating.TotalUsers"),
        "sort_order": F.expr("try_cast(d.SortOrder as int)"),
        "total_volume_24h_usd": F.col("d.TOTALVOLUME24H")["USD"],
    }
    return conform(entries, "exchanges_general", values | _audit(run_ts))


def exchange_pair_rows(
    payloads: DataFrame,
    base: str | None = None,
    exchange: str | None = None,
    top_tier_only: bool = False,
) -> DataFrame:
    """Three-level map exchange, base, quote to rows with their history bounds."""
    exchanges = payloads.select(F.explode("body.Data.exchanges").alias("exchange", "e"))
    if exchange is not None:
        exchanges = exchanges.where(F.col("exchange") == exchange)
    if top_tier_only:
        exchanges = exchanges.where("e.isTopTier")
    bases = exchanges.select(
        "exchange",
        F.col("e.isActive").alias("exchange_active"),
        F.col("e.isTopTier").alias("is_top_tier"),
        F.explode("e.pairs").alias("base", "b"),
    )
    if base is not None:
        bases = bases.where(F.col("base") == base)
    quotes = bases.select("exchange", "exchange_active", "is_top_tier", "base", F.explode("b.tsyms").alias("quote", "q"))
    return quotes.select(
        "exchange",
        "exchange_active",
        "is_top_tier",
        "base",
        "quote",
        F.col("q.isActive").alias("pair_active"),
        epoch_to_ts_nonzero("q.histo_minute_start_ts").alias("history_start"),
        epoch_to_ts_nonzero("q.histo_minute_end_ts").alias("history_end"),
    )


def rate_limit_rows(payloads: DataFrame, use_case: str, timing: str, run_ts: Column) -> DataFrame:
    """Usage limits as one flat row per payload."""
    values = {
        f"{k}_{g}_{u}": F.col(f"body.Data.{k.upper()}.{g.upper()}.{u.upper()}")
        for k in S.LIMIT_KEYS
        for g in S.LIMIT_GROUPS
        for u in S.LIMIT_UNITS
    }
    values |= {"timestamp": run_ts, "use_case": F.lit(use_case), "record_timing": F.lit(timing)}
    return conform(payloads, "rate_limit_status", values)


# --- candles ---------------------------------------------------------------

_CANDLE_FIELDS = {
    "futures_ohlcv": ("futures_ohlcv_1d", S.FUTURES_FIELDS),
    "funding_rate": ("futures_funding_rate_ohlc_1d", S.FUNDING_FIELDS),
    "open_interest": ("futures_open_interest_ohlc_1d", S.OPEN_INTEREST_FIELDS),
    "spot_ohlcv": ("ohlcv_spot_1d_raw", S.SPOT_FIELDS),
    "index_ohlcv": ("ohlcv_spot_indices_1d_raw", S.INDEX_FIELDS),
}


def candle_rows(
    records: DataFrame, kind: str, run_ts: Column, asset: Column | None = None, quote: Column | None = None
) -> DataFrame:
    """Payload candles ``d`` to the typed series of their kind.

    Index candles take ``asset`` and ``quote`` from the request; without them
    the instrument is split at its first hyphen.
    """
    table, fields = _CANDLE_FIELDS[kind]
    values = {
        c: epoch_to_ts(f"d.{f}") if c == "datetime" or c.endswith("_timestamp") else F.col(f"d.{f}")
        for c, f in fields.items()
    }
    if kind == "index_ohlcv":
        values["asset"] = asset if asset is not None else F.split_part("d.INSTRUMENT", F.lit("-"), F.lit(1))
        values["quote"] = quote if quote is not None else F.split_part("d.INSTRUMENT", F.lit("-"), F.lit(2))
    return conform(records, table, values | {"collected_at": run_ts})


def trade_rows(records: DataFrame) -> DataFrame:
    """Payload trades ``d`` to the trade frame used by ``operators.series``."""
    micros = F.col("d.TIMESTAMP") * 1_000_000 + F.floor(F.coalesce("d.TIMESTAMP_NS", F.lit(0)) / 1000)
    return records.select(
        F.col("d.MARKET").alias("market"),
        F.col("d.INSTRUMENT").alias("instrument"),
        F.col("d.MAPPED_INSTRUMENT").alias("mapped_instrument"),
        F.col("d.BASE").alias("base"),
        F.col("d.QUOTE").alias("quote"),
        F.col("d.SIDE").alias("side"),
        F.timestamp_micros(micros).cast(NTZ).alias("ts"),
        F.col("d.TIMESTAMP_NS").alias("ts_ns"),
        F.col("d.CCSEQ").alias("seq"),
        F.col("d.PRICE").alias("price"),
        F.col("d.QUANTITY").alias("quantity"),
    )
