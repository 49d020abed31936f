"""Entity resolution of assets against a coin master.

Exact keys first (external ids, symbol, normalised name), then the best fuzzy
name match at or above a similarity floor.  Where several coins share a key or
a best score, the smallest ``coin_uid`` wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marketlake.functions import (
    gram_counts,
    gram_masks,
    gram_size,
    grams_are_even,
    may_have_partner,
    may_reach,
    name_signatures,
    normalise_name,
    similarity_ratio,
)
from marketlake.operators.latest import latest_per_key
from marketlake.operators.lookup import lookup
from marketlake.session import checkpointed

MIN_RATIO = 0.85
TIERS = (0.94, 0.89)

# Match types in order of precedence.
EXACT_STEPS = ("coingecko_id", "coinmarketcap_id", "symbol", "name")
FUZZY, UNMATCHED = "fuzzy_name", "unmatched"


def assets_with_ids(assets: DataFrame, alternative_ids: DataFrame, latest: str = "updated_at") -> DataFrame:
    """Assets with their coingecko and coinmarketcap ids; ids of unknown assets are dropped."""
    newest = latest_per_key(alternative_ids, ["asset_id"], [latest, "cg_id", "cmc_id"])
    unique = latest_per_key(assets, ["asset_id"], [latest, "symbol", "name"])
    return unique.select("asset_id", "symbol", "name").join(
        newest.select("asset_id", "cg_id", "cmc_id"), "asset_id", "left"
    )


def _filled(c: Column) -> Column:
    return F.nullif(c.cast("string"), F.lit(""))


def _lookup(df: DataFrame, key: Column, coins: DataFrame, coin_key: Column, name: str) -> DataFrame:
    """Left lookup of the smallest coin_uid with an equal key."""
    known = (
        coins.select(coin_key.alias("key_"), "coin_uid")
        .where("key_ is not null")
        .groupBy("key_")
        .agg(F.min("coin_uid").alias(name))
    )
    return lookup(df.withColumn("key_", key), known, ["key_"]).drop("key_")


def exact_matches(assets: DataFrame, coins: DataFrame) -> DataFrame:
    """All assets with ``norm_name`` and the first exact hit as (coin_uid, match_type), else nulls.

    Both sides become rows of (step, key) and meet in one join; the first step
    with a hit is an aggregate.  Repeated asset rows come back as often as given.
    """
    norm = F.nullif(normalise_name("name"), F.lit(""))
    own_keys = dict(zip(EXACT_STEPS, ("cg_id", "cmc_id", "symbol", "norm_name")))
    coin_keys = dict(zip(EXACT_STEPS, ("coingecko_id", "coinmarketcap_id", "ticker", "norm_name")))
    last = len(EXACT_STEPS)  # a row without a key, which every asset has

    def by_step(df: DataFrame, keys: dict[str, str], more: Sequence[Column] = ()) -> DataFrame:
        found = [F.struct(F.lit(i).alias("step_"), _filled(F.col(keys[s])).alias("key_")) for i, s in enumerate(EXACT_STEPS)]
        return df.withColumn("norm_name", norm).select("*", F.inline(F.array(*found, *more)))

    known = (
        by_step(coins, coin_keys)
        .where("key_ is not null")
        .groupBy("step_", "key_")
        .agg(F.min("coin_uid").alias("uid_"))
    )
    base = F.struct(F.lit(last).alias("step_"), F.lit(None).cast("string").alias("key_"))
    own = by_step(assets, own_keys, [base]).where((F.col("key_").isNotNull()) | (F.col("step_") == last))
    first = F.min(F.when(F.col("uid_").isNotNull(), F.struct("step_", "uid_")))
    columns = [*assets.columns, "norm_name"]
    matched = (
        lookup(own, known, ["step_", "key_"])
        .where((F.col("uid_").isNotNull()) | (F.col("step_") == last))  # keys without a hit go no further
        .groupBy(*columns)
        .agg(first.alias("first_"), F.count_if(F.col("step_") == last).alias("copies_"))
    )
    kind = F.get(F.array(*[F.lit(s) for s in EXACT_STEPS]), F.col("first_.step_"))
    return matched.select(
        *columns,
        F.col("first_.uid_").alias("coin_uid"),
        kind.alias("match_type"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies_").cast("int"))).alias("copy_"),
    ).drop("copy_")


# --- fuzzy step ------------------------------------------------------------

_NAMES_PER_TASK = 20_000
_UNKNOWN = 0.25  # below this share of grams that the other side lacks, few names can do without a partner


class _Measures(NamedTuple):
    lengths: frozenset[int]
    frequency: dict[int, int]  # grams by bucket


@dataclass
class _Names:
    """Names of one side, which give the same rows each time, with what has been counted of them or of more names."""

    frame: DataFrame
    measures: dict[int, _Measures] = field(default_factory=dict)  # by characters per gram

    @cached_property
    def count(self) -> int:
        return self.frame.count()

    def measured(self, ratio: float) -> _Measures:
        size = gram_size(ratio)
        if size not in self.measures:
            self.measures[size] = _measured(self.frame, ratio)
        return self.measures[size]

    def only(self, frame: DataFrame) -> _Names:
        """These names without some; half and fewer are counted anew, more have the counts of all."""
        some = _Names(checkpointed(frame))
        if 2 * some.count > self.count:
            some.measures.update(self.measures)
        return some

    def with_partners(self, other: _Names, ratio: float) -> _Names:
        """These names without those that can reach ``ratio`` with no name of the other side."""
        lengths, present = other.measured(ratio).lengths, frozenset(other.measured(ratio).frequency)
        own = self.measured(ratio).frequency
        if sum(n for b, n in own.items() if b not in present) < _UNKNOWN * sum(own.values()):
            return self

        @F.pandas_udf("boolean")
        def near(names: pd.Series) -> pd.Series:
            return pd.Series([may_have_partner(name, ratio, lengths, present) for name in names], dtype=bool)

        return self.only(self.frame.where(near("norm_name")))


def _measured(names: DataFrame, ratio: float) -> _Measures:
    """Lengths of the names and how many of their grams fall into each bucket.

    At most one number per length the name column allows, and ``GRAM_BUCKETS``.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths: Counter[int] = Counter()
        seen: Counter[int] = Counter()  # bounded by the number of buckets
        for batch in batches:
            names = batch["norm_name"].tolist()
            lengths.update(map(len, names))
            seen.update(gram_counts(names, ratio))
        rows = [(kind, value, n) for kind, counts in (("length", lengths), ("gram", seen)) for value, n in counts.items()]
        if rows:
            yield pd.DataFrame(rows, columns=["kind", "value", "n"])

    counted = names.select("norm_name").mapInPandas(count, "kind string, value bigint, n bigint")
    rows = counted.groupBy("kind", "value").agg(F.sum("n").alias("n")).collect()
    return _Measures(
        frozenset(row["value"] for row in rows if row["kind"] == "length"),
        {row["value"]: row["n"] for row in rows if row["kind"] == "gram"},
    )


_MASKS = ("mask_0", "mask_1")


def _signed(names: _Names, ratio: float, others: _Measures, frequency: dict[int, int], prefix: str) -> DataFrame:
    """(id, length, masks, 64-bit key) rows: numbers only, as a name has many keys; a hash collision only adds a candidate."""

    even, partners, present = grams_are_even(frequency), others.lengths, frozenset(others.frequency)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["norm_name"].map(lambda name: name_signatures(name, ratio, partners, frequency, present, even))
            found = keys.map(len) > 0
            some = batch.loc[found, ["norm_name"]]
            masks = [gram_masks(name, ratio) for name in some["norm_name"]]
            yield some.assign(keys=keys[found], **{m: [words[i] for words in masks] for i, m in enumerate(_MASKS)})

    # names are small but their keys are many: size the tasks by the keys, not by the bytes read
    tasks = max(names.frame.sparkSession.sparkContext.defaultParallelism, names.count // _NAMES_PER_TASK)
    spread = names.frame.select("norm_name").repartition(tasks)
    signed = spread.mapInPandas(sign, "norm_name string, keys array<string>, mask_0 bigint, mask_1 bigint")
    return signed.select(_id().alias("id"), F.length("norm_name").alias("n"), *_MASKS, F.explode("keys").alias("key")).select(
        F.xxhash64("key").alias("key"), *[F.col(c).alias(f"{prefix}_{c}") for c in ("id", "n", *_MASKS)]
    )


def _id() -> Column:
    return F.xxhash64("norm_name")


def candidate_pairs(left: DataFrame, right: DataFrame, ratio: float) -> DataFrame:
    """Distinct (asset_name, coin_name) that may reach ``ratio``: all that do, and few others.

    Both frames have a column ``norm_name`` without nulls and empty names, and
    must give the same rows each time they are read.
    """
    return _candidates(_Names(left), _Names(right), ratio)


def _candidates(left: _Names, right: _Names, ratio: float) -> DataFrame:
    of_left, of_right = left.measured(ratio), right.measured(ratio)
    frequency = dict(Counter(of_left.frequency) + Counter(of_right.frequency))
    a = _signed(left, ratio, of_right, frequency, "asset")
    b = _signed(right, ratio, of_left, frequency, "coin")
    masks = [[f"{side}_{m}" for m in _MASKS] for side in ("asset", "coin")]
    possible = may_reach(F.col("asset_n"), F.col("coin_n"), *masks, ratio)
    # a side is far larger in memory than its compressed shuffle lets on: sorted, it can spill, and hot keys are split
    ids = a.join(b.hint("merge"), "key").where(possible).select("asset_id", "coin_id").distinct()
    named = [
        names.frame.select(_id().alias(f"{side}_id"), F.col("norm_name").alias(f"{side}_name")).distinct()
        for names, side in ((left, "asset"), (right, "coin"))
    ]
    return ids.join(named[0], "asset_id").join(named[1], "coin_id").select("asset_name", "coin_name")


def _tier(left: _Names, right: _Names, ratio: float) -> DataFrame:
    """Best right name per left name among pairs at or above ``ratio``."""
    pairs = _candidates(left, right, ratio)
    scored = pairs.withColumn("score", similarity_ratio(ratio)("asset_name", "coin_name")).where("score is not null")
    owned = scored.join(right.frame.withColumnRenamed("norm_name", "coin_name"), "coin_name")
    best = F.min(F.struct((-F.col("score")).alias("neg"), "coin_uid"))
    return owned.groupBy("asset_name").agg(best.alias("best")).select(
        F.col("asset_name").alias("norm_name"),
        F.col("best.coin_uid").alias("coin_uid"),
        (-F.col("best.neg")).alias("match_score"),
    )


def fuzzy_matches(
    names: DataFrame, coins: DataFrame, min_ratio: float = MIN_RATIO, tiers: tuple[float, ...] = TIERS
) -> DataFrame:
    """Best coin per distinct ``norm_name``: (norm_name, coin_uid, match_score).

    Higher tiers run first: they have fewer candidates, and a name with a match
    there cannot have its best match in a lower tier, so only the rest go on.
    Names that are too far from all of the other side take no part in any.
    """
    left = names.select("norm_name").where("norm_name is not null and norm_name != ''").distinct()
    right = (
        coins.select(normalise_name("name").alias("norm_name"), "coin_uid")
        .where("norm_name != ''")
        .groupBy("norm_name")
        .agg(F.min("coin_uid").alias("coin_uid"))
    )
    none = right.select("norm_name", "coin_uid", F.lit(None).cast("double").alias("match_score")).limit(0)
    # both are read once per tier and must stay the same rows
    open_names, masters = _Names(checkpointed(left)), _Names(checkpointed(right))
    found: DataFrame | None = None
    for ratio in [*sorted((t for t in tiers if t > min_ratio), reverse=True), min_ratio]:
        if open_names.count and not open_names.measures:  # the first time, and when most have left
            open_names = open_names.with_partners(masters, min_ratio)
            if open_names.count:
                masters = masters.with_partners(open_names, min_ratio)
        if not (open_names.count and masters.count):
            break
        tier = checkpointed(_tier(open_names, masters, ratio))
        found = tier if found is None else found.unionByName(tier)
        open_names = open_names.only(open_names.frame.join(tier.select("norm_name"), "norm_name", "left_anti"))
    return none if found is None else found


def map_assets(
    assets: DataFrame,
    coins: DataFrame,
    mapped_at: Column,
    min_ratio: float = MIN_RATIO,
    tiers: tuple[float, ...] = TIERS,
) -> DataFrame:
    """(asset_id, symbol, coin_uid, match_type, match_score, mapped_at) for every asset.

    ``assets`` has asset_id, symbol, name, cg_id and cmc_id.  Unmatched assets
    keep a null coin and score.
    """
    # read twice: for the names without a hit, and for the result
    exact = checkpointed(exact_matches(assets, coins).select("asset_id", "symbol", "norm_name", "coin_uid", "match_type"))
    open_names = exact.where("coin_uid is null").select("norm_name")
    best = fuzzy_matches(open_names, coins, min_ratio, tiers).withColumnsRenamed(
        {"norm_name": "fuzzy_name_", "coin_uid": "fuzzy_uid_", "match_score": "fuzzy_score_"}
    )
    open_name = F.when(F.col("coin_uid").isNull(), F.col("norm_name"))
    joined = lookup(exact.withColumn("fuzzy_name_", open_name), best, ["fuzzy_name_"])
    is_exact, is_fuzzy = F.col("coin_uid").isNotNull(), F.col("fuzzy_uid_").isNotNull()
    return joined.select(
        "asset_id",
        "symbol",
        F.coalesce("coin_uid", "fuzzy_uid_").alias("coin_uid"),
        F.when(is_exact, F.col("match_type")).when(is_fuzzy, F.lit(FUZZY)).otherwise(F.lit(UNMATCHED)).alias("match_type"),
        F.when(is_exact, F.lit(1.0)).otherwise(F.col("fuzzy_score_")).alias("match_score"),
        mapped_at.cast("timestamp_ntz").alias("mapped_at"),
    )


def stored_matches(mapping: DataFrame) -> DataFrame:
    """Only rows with a coin are stored."""
    return mapping.where("coin_uid is not null and coin_uid != ''")
