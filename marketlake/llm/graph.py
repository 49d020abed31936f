"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake.llm.common import saved


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each pair (u, v) with the least of u and all its partners, as ``m``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("_u")).drop("_u")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of ``edges`` (``a``, ``b`` bigint).

    Rounds of a large star (every node hands its larger neighbours to its least
    neighbour) and a small star (every node hands its smaller ones on) until
    nothing changes; each round is written to the shared folder.  Self-loops
    keep their node, repeated edges count once, nulls are dropped.
    """
    given = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    nodes = given.select(F.col("a").alias("node")).union(given.select("b"))
    pairs = saved(
        given.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        downward = _with_least(large)
        handed = downward.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = saved(handed.union(downward.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    roots = pairs.groupBy("u").agg(F.min("v").alias("root"))
    return (
        nodes.distinct()
        .join(roots, F.col("node") == F.col("u"), "left")
        .select("node", F.coalesce("root", "node").alias("component"))
    )
