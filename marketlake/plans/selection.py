"""Universe selection for the daily spot series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake.operators.ranking import first_n
from marketlake.operators.select import PAIR, pairs_of, qualified_exchanges, top_assets


def top_pairs(
    assets: DataFrame,
    snapshots: DataFrame,
    exchanges: DataFrame,
    instruments: DataFrame,
    asset_limit: int = 50,
    exchange_limit: int | None = None,
    pair_limit: int | None = None,
    collation: str | None = None,
) -> DataFrame:
    """Active pairs whose base is a top asset, on exchanges graded BB or better; names compare under ``collation``."""
    top = top_assets(assets, snapshots, asset_limit).select("symbol")
    venues = first_n(qualified_exchanges(exchanges, collation), ["internal_name"], exchange_limit)
    return first_n(pairs_of(instruments, assets, top, venues, collation), list(PAIR), pair_limit)


def index_instruments(top: DataFrame, market: str, quote: str = "USD") -> DataFrame:
    """Index series to request for a list of asset symbols."""
    return top.select(
        F.lit(market).alias("market"),
        F.col("symbol").alias("asset"),
        F.lit(quote).alias("quote"),
        F.concat("symbol", F.lit("-"), F.lit(quote)).alias("instrument"),
    )
