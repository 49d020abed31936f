"""Left lookup that stays balanced when keys are hot or missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_SPREAD = 1024


def _hashable(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a side with at most one row per key.

    The join has one more key, ``tag``, with two effects:

    * It is 0 for complete keys, but computed.  A lookup side is usually an
      aggregate over the same keys, and would otherwise share its shuffle with
      the join; AQE splits a hot key only where the shuffle is directly below
      the join.
    * Rows with a missing key never match.  Their tag is spread, so that they do
      not all go to the partition of the null key.
    """
    complete: Column = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    spread = F.pmod(F.xxhash64(*_hashable(left)), F.lit(_SPREAD))
    tagged = left.withColumn("tag_", F.when(complete, zero).otherwise(spread))
    known = right.withColumn("tag_", zero)
    columns = [c for c in right.columns if c not in keys]
    return tagged.join(known, [*keys, "tag_"], "left").select(*left.columns, *columns)
