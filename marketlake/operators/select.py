"""Selections over asset, exchange and instrument tables.

String comparisons are binary by default.  Stored names may follow a
case-insensitive collation; pass ``collation="UTF8_LCASE"`` (or
``"UNICODE_CI_AI"`` to ignore accents too) to compare the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlake.operators.latest import latest_per_key
from marketlake.operators.ranking import top_k

# Grades from BB upwards, and the status of a tradable instrument.
QUALIFIED_GRADES = ("AAA", "AA", "A", "BBB", "BB")
ACTIVE = "ACTIVE"

# Flag, last and first update column per futures data type.
UPDATE_COLUMNS = {
    "ohlcv": ("has_trades", "last_trade_datetime", "first_trade_datetime"),
    "funding-rate": (
        "has_funding_rate_updates",
        "last_funding_rate_update_datetime",
        "first_funding_rate_update_datetime",
    ),
    "open-interest": (
        "has_open_interest_updates",
        "last_open_interest_update_datetime",
        "first_open_interest_update_datetime",
    ),
}


def compared(c: str | Column, collation: str | None = None) -> Column:
    """The column under the collation used for comparisons."""
    c = F.col(c) if isinstance(c, str) else c
    return F.collate(c, collation) if collation else c


def one_of(c: str | Column, values: Sequence[str], collation: str | None = None) -> Column:
    """Membership in a list of bound values."""
    if collation is None:
        return compared(c).isin(*values)
    return compared(c, collation).isin(*[F.collate(F.lit(v), collation) for v in values])


def time_range(df: DataFrame, start: Column, end: Column, ts: str = "datetime") -> DataFrame:
    """Half-open range; pushed to the file scan."""
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def top_assets(
    assets: DataFrame,
    snapshots: DataFrame,
    k: int = 50,
    volume: str = "spot_moving_30_day_quote_volume_usd",
    snapshot_ts: str = "snapshot_ts",
    snapshot_ties: Sequence[str | Column] = (),
    key: str = "asset_id",
) -> DataFrame:
    """The ``k`` assets with the largest volume in their newest snapshot."""
    newest = latest_per_key(snapshots, [key], [snapshot_ts, *snapshot_ties])
    return top_k(assets.join(newest.select(key, volume), key), volume, k, [key])


def qualified_exchanges(exchanges: DataFrame, collation: str | None = None) -> DataFrame:
    """Internal names of exchanges graded BB or better."""
    return exchanges.where(one_of("grade", QUALIFIED_GRADES, collation)).select("internal_name")


def futures_exchanges(details: DataFrame) -> DataFrame:
    return details.select("exchange_internal_name")


PAIR = ("exchange_internal_name", "base_asset_symbol", "quote_asset_symbol")


def trading_pairs(
    instruments: DataFrame,
    assets: DataFrame,
    exchanges: Sequence[str],
    symbols: Sequence[str],
    collation: str | None = None,
) -> DataFrame:
    """Active pairs of the given base symbols on the given exchanges.

    The asset join keeps multiplicity: an asset stored twice gives a pair twice.
    """
    eligible = instruments.where(
        one_of("exchange_internal_name", exchanges, collation)
        & one_of("base_asset_symbol", symbols, collation)
        & (compared("instrument_status_on_exchange", collation) == F.lit(ACTIVE))
    )
    known = assets.select(F.col("asset_id").alias("base_asset_id"))
    return eligible.join(known, "base_asset_id").select(*PAIR)


def pairs_of(
    instruments: DataFrame, assets: DataFrame, top: DataFrame, exchanges: DataFrame, collation: str | None = None
) -> DataFrame:
    """As :func:`trading_pairs`, with the lists given as tables (symbol, internal_name).

    Both restrictions are semi joins; Spark broadcasts either list only when
    its size allows.
    """
    venue, symbol = compared("exchange_internal_name", collation), compared("base_asset_symbol", collation)
    venues = exchanges.select(compared("internal_name", collation).alias("venue_"))
    symbols = top.select(compared("symbol", collation).alias("symbol_"))
    eligible = (
        instruments.where(compared("instrument_status_on_exchange", collation) == F.lit(ACTIVE))
        .join(venues, venue == F.col("venue_"), "left_semi")
        .join(symbols, symbol == F.col("symbol_"), "left_semi")
    )
    known = assets.select(F.col("asset_id").alias("base_asset_id"))
    return eligible.join(known, "base_asset_id").select(*PAIR)


def futures_instruments(
    instruments: DataFrame,
    exchanges: Sequence[str] | DataFrame,
    statuses: Sequence[str],
    data_type: str = "ohlcv",
    symbols: Sequence[str] = (),
    collation: str | None = None,
) -> DataFrame:
    """Instruments with data of the given type, with their update bounds.

    ``exchanges`` is a list of names or a table with ``exchange_internal_name``;
    ``symbols`` optionally restricts to listed instruments.
    """
    if data_type not in UPDATE_COLUMNS:
        raise ValueError(f"Unsupported data type: {data_type}")
    flag, last, first = UPDATE_COLUMNS[data_type]
    wanted = instruments.where(F.col(flag) & one_of("instrument_status_on_exchange", statuses, collation))
    if isinstance(exchanges, DataFrame):
        wanted = wanted.join(exchanges.select("exchange_internal_name"), "exchange_internal_name", "left_semi")
    else:
        wanted = wanted.where(one_of("exchange_internal_name", exchanges, collation))
    if symbols:
        wanted = wanted.where(F.col("mapped_instrument_symbol").isin(*[s.strip() for s in symbols]))
    return wanted.select(
        "exchange_internal_name", "mapped_instrument_symbol", last, first, "instrument_status_on_exchange"
    )
