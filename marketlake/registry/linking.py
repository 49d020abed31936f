"""Asset to coin resolution: customers against a reshaped copy of themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake.operators import checks, link
from marketlake.registry.base import Tables, register

MAPPED = "2024-03-01"


def _assets(t: Tables) -> DataFrame:
    """Customers with the ids they are known by; every third nation lacks a coingecko id."""
    ids = t.customer.select(
        F.col("c_custkey").alias("asset_id"),
        F.when(F.col("c_nationkey") < 15, F.col("c_name")).alias("cg_id"),
        F.when(F.col("c_nationkey") < 20, F.col("c_custkey").cast("string")).otherwise("").alias("cmc_id"),
        F.lit(MAPPED).cast("timestamp_ntz").alias("updated_at"),
    ).where("c_nationkey <> 9")
    stale = ids.withColumns(
        {"cg_id": F.lit("stale"), "updated_at": F.lit("2020-01-01").cast("timestamp_ntz")}
    )
    assets = t.customer.select(
        F.col("c_custkey").alias("asset_id"),
        F.concat(F.lit("S"), F.col("c_custkey")).alias("symbol"),
        F.col("c_name").alias("name"),
        F.lit(MAPPED).cast("timestamp_ntz").alias("updated_at"),
    )
    return link.assets_with_ids(assets, ids.unionByName(stale))


def _coins(t: Tables) -> DataFrame:
    """Coins that share some ids with customers, each key also held by a later coin."""
    nation = F.col("c_nationkey")
    first = t.customer.select(
        F.concat(F.lit("a"), F.col("c_custkey")).alias("coin_uid"),
        F.when(nation.between(8, 17), F.concat(F.lit("S"), F.col("c_custkey"))).alias("ticker"),
        F.when(nation.between(12, 22), F.upper(F.concat_ws(" - ", F.lit(""), F.col("c_name")))).alias("name"),
        F.when(nation < 8, F.col("c_name")).alias("coingecko_id"),
        F.when(nation.between(5, 12), F.col("c_custkey")).cast("string").alias("coinmarketcap_id"),
    )
    return first.unionByName(first.withColumn("coin_uid", F.concat(F.lit("b"), "coin_uid")))


CASCADE_SQL = f"""
WITH m AS (
  SELECT c_custkey AS asset_id, 'S' || c_custkey AS symbol, 'a' || c_custkey AS uid,
    CASE WHEN c_nationkey < 8 AND c_nationkey <> 9 THEN 'coingecko_id'
         WHEN c_nationkey BETWEEN 5 AND 12 AND c_nationkey <> 9 THEN 'coinmarketcap_id'
         WHEN c_nationkey BETWEEN 8 AND 17 THEN 'symbol' WHEN c_nationkey BETWEEN 12 AND 22 THEN 'name'
    END AS match_type FROM customer)
SELECT asset_id, symbol, CASE WHEN match_type IS NOT NULL THEN uid END AS coin_uid, match_type FROM m
"""


@register("cascade_match", CASCADE_SQL)
def _cascade(t: Tables) -> DataFrame:
    return link.exact_matches(_assets(t), _coins(t)).select("asset_id", "symbol", "coin_uid", "match_type")


@register(
    "match_counts",
    f"""SELECT CAST(count(*) FILTER (match_type IS NOT NULL) AS BIGINT) AS mapped,
        CAST(count(*) FILTER (match_type IS NULL) AS BIGINT) AS unmatched FROM ({CASCADE_SQL})""",
)
def _counts(t: Tables) -> DataFrame:
    return checks.match_counts(link.exact_matches(_assets(t), _coins(t)), "coin_uid")


@register(
    "stored_matches",
    f"""SELECT asset_id, symbol, coin_uid, match_type, CAST(1.0 AS DOUBLE) AS match_score,
        TIMESTAMP '{MAPPED}' AS mapped_at FROM ({CASCADE_SQL}) WHERE match_type IS NOT NULL""",
)
def _stored(t: Tables) -> DataFrame:
    exact = link.exact_matches(_assets(t), _coins(t))
    mapping = exact.select(
        "asset_id",
        "symbol",
        "coin_uid",
        "match_type",
        F.lit(1.0).alias("match_score"),
        F.lit(MAPPED).cast("timestamp_ntz").alias("mapped_at"),
    )
    return link.stored_matches(mapping)


# An inserted letter leaves 2L of 2L + 1 characters matched.  No other coin can
# reach that: it would have to contain the letter or the same characters.
@register(
    "fuzzy_match",
    f"""SELECT c_custkey AS asset_id, 'none' AS symbol, 'a' || c_custkey AS coin_uid,
        CASE WHEN c_nationkey = 3 THEN 'name' ELSE 'fuzzy_name' END AS match_type,
        CASE WHEN c_nationkey = 3 THEN 1.0 ELSE round(2.0 * length(c_name) / (2 * length(c_name) + 1), 6) END AS match_score,
        TIMESTAMP '{MAPPED}' AS mapped_at FROM customer""",
)
def _fuzzy(t: Tables) -> DataFrame:
    misspelt = F.concat(F.substring("c_name", 1, 8), F.lit("x"), F.expr("substring(c_name, 9)"))
    assets = t.customer.select(
        F.col("c_custkey").alias("asset_id"),
        F.lit("none").alias("symbol"),
        F.when(F.col("c_nationkey") == 3, F.col("c_name")).otherwise(misspelt).alias("name"),
        F.lit(None).cast("string").alias("cg_id"),
        F.lit("").alias("cmc_id"),
    )
    coins = t.customer.select(
        F.concat(F.lit("a"), F.col("c_custkey")).alias("coin_uid"),
        F.lit("").alias("ticker"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("coingecko_id"),
        F.lit(None).cast("string").alias("coinmarketcap_id"),
    )
    mapping = link.map_assets(assets, coins, F.lit(MAPPED))
    return mapping.withColumn("match_score", F.round("match_score", 6))


@register(
    "fuzzy_match_rejected",
    """SELECT p_partkey AS asset_id, p_brand AS symbol, CAST(NULL AS VARCHAR) AS coin_uid, 'unmatched' AS match_type,
       CAST(NULL AS DOUBLE) AS match_score, TIMESTAMP '2024-03-01' AS mapped_at FROM part""",
)
def _fuzzy_rejected(t: Tables) -> DataFrame:
    assets = t.part.select(
        F.col("p_partkey").alias("asset_id"),
        F.col("p_brand").alias("symbol"),
        F.concat("p_name", F.lit(" "), "p_type").alias("name"),
        F.lit(None).cast("string").alias("cg_id"),
        F.lit(None).cast("string").alias("cmc_id"),
    )
    coins = t.customer.select(
        F.col("c_custkey").cast("string").alias("coin_uid"),
        F.col("c_mktsegment").alias("ticker"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("coingecko_id"),
        F.lit(None).cast("string").alias("coinmarketcap_id"),
    )
    return link.map_assets(assets, coins, F.lit(MAPPED))


# Names of 40 to 64 characters with four of them replaced by a letter that no other name has.  The pieces in between
# are 12 characters long and more, so no other coin comes near.
@register(
    "fuzzy_match_long",
    f"""SELECT c_custkey AS asset_id, 'none' AS symbol, 'a' || c_custkey AS coin_uid, 'fuzzy_name' AS match_type,
        round((36.0 + c_nationkey) / (40 + c_nationkey), 6) AS match_score, TIMESTAMP '{MAPPED}' AS mapped_at FROM customer""",
)
def _fuzzy_long(t: Tables) -> DataFrame:
    key = F.concat(F.md5("c_name"), F.md5(F.reverse("c_name")))
    named = t.customer.withColumn("long_name", F.substring(key, F.lit(1), F.col("c_nationkey") + 40))
    marked = F.col("long_name")
    for place in (1, 13, 26, 39):
        marked = F.overlay(marked, F.lit("x"), place)
    assets = named.select(
        F.col("c_custkey").alias("asset_id"),
        F.lit("none").alias("symbol"),
        marked.alias("name"),
        F.lit(None).cast("string").alias("cg_id"),
        F.lit("").alias("cmc_id"),
    )
    coins = named.select(
        F.concat(F.lit("a"), F.col("c_custkey")).alias("coin_uid"),
        F.lit("").alias("ticker"),
        F.col("long_name").alias("name"),
        F.lit(None).cast("string").alias("coingecko_id"),
        F.lit(None).cast("string").alias("coinmarketcap_id"),
    )
    return link.map_assets(assets, coins, F.lit(MAPPED)).withColumn("match_score", F.round("match_score", 6))
