"""Asset to coin map from the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from marketlake.operators.link import MIN_RATIO, assets_with_ids, map_assets, stored_matches
from marketlake.plans.store import Store
from marketlake.session import checkpointed


def refresh_coin_map(
    spark: SparkSession, store: Store, coins: DataFrame, mapped_at: Column, min_ratio: float = MIN_RATIO
) -> DataFrame:
    """Map all stored assets, store the matches and return the full mapping."""
    assets = assets_with_ids(store.read(spark, "assets"), store.read(spark, "asset_alternative_ids"))
    mapping = checkpointed(map_assets(assets, coins, mapped_at, min_ratio))
    store.upsert(stored_matches(mapping), "asset_coin_uid_map")
    return mapping
