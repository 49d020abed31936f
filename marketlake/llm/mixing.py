"""Mixing sources to target weights by the cube method.

Targets: every source gets a share of a total by its weight, capped at a
multiple of its own size, the excess reshared by weight.  Selection: each
document of a source is taken ``floor(e)`` or ``floor(e) + 1`` times, e being
target over size.  Which documents get the extra copy is decided by balanced
sampling: fractional inclusion probabilities move along the null space of the
constraints (words and documents), until each is 0 or 1.  The flight runs per
source and block of bounded size; the at most two units a block leaves open
enter the next, much smaller round, until one block per source remains, whose
last open units are rounded to miss the fewest words.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from marketlake.llm.common import WORD_PATTERN, saved, shipped, whole_text

shipped(__name__)

_EPS = 1e-9


def word_count(text_col: str = "text"):
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; 0 for null."""
    return F.regexp_count(whole_text(text_col), F.lit(WORD_PATTERN)).cast("long")


def source_targets(units: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """One row per source: ``source, source_size, source_rows, target``.

    Sources sorted by code point, null last, take the weights in turn.  Capped
    shares are found in closed form: sorted by cap / weight, the sources before
    some point are capped and the others share the rest by weight.  The window
    frames without partition run over one row per source.
    """
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    turn = ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")
    limits = (
        sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("limit", cap * F.col("source_size"))
        .withColumn("fill", F.col("limit") / F.col("weight"))
        .withColumn(
            "level",
            (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / F.sum("weight").over(after),
        )
        # the first level that no later source's cap cuts off; none if all are capped
        .withColumn("final", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(everything))
    )
    target = F.when(F.col("final").isNull(), F.col("limit")).otherwise(
        F.least("limit", F.col("final.level") * F.col("weight"))
    )
    return limits.select("source", "source_size", "source_rows", target.alias("target"))


def _null_vector(sizes: list[float]) -> tuple[float, float, float]:
    """A direction that keeps the sum of three units and their words: orthogonal to (1,1,1) and the sizes."""
    a, b, c = sizes
    u = (b - c, c - a, a - b)
    return (1.0, -1.0, 0.0) if u == (0.0, 0.0, 0.0) else u


def flight(sizes: list[float], probabilities: list[float], random) -> list[float]:
    """Move probabilities to 0 or 1, words and count held; at most two stay between."""
    p = list(probabilities)
    held: list[int] = []
    for i in range(len(p)):
        if not _EPS < p[i] < 1 - _EPS:
            p[i] = round(p[i])
            continue
        held.append(i)
        if len(held) < 3:
            continue
        u = _null_vector([sizes[k] for k in held])
        up = min((1 - p[k]) / v if v > 0 else -p[k] / v for k, v in zip(held, u, strict=True) if v)
        down = min(p[k] / v if v > 0 else (p[k] - 1) / v for k, v in zip(held, u, strict=True) if v)
        step = up if random.random() * (up + down) < down else -down
        for k, v in zip(held, u, strict=True):
            p[k] += step * v
            if p[k] < _EPS or p[k] > 1 - _EPS:
                p[k] = float(round(p[k]))
        held = [k for k in held if 0 < p[k] < 1]
    return p


def landing(sizes: list[float], probabilities: list[float]) -> list[float]:
    """Round the last open units (two at most after a flight) so that words, then documents, miss least."""
    p = list(probabilities)
    open_units = [i for i, x in enumerate(p) if 0 < x < 1]
    best = None
    for choice in range(1 << len(open_units)):
        taken = [(choice >> j) & 1 for j in range(len(open_units))]
        words = abs(sum((t - p[i]) * sizes[i] for t, i in zip(taken, open_units, strict=True)))
        count = abs(sum(t - p[i] for t, i in zip(taken, open_units, strict=True)))
        if best is None or (words, count) < best[0]:
            best = ((words, count), taken)
    for i, t in zip(open_units, best[1], strict=True):
        p[i] = float(t)
    return p


def _fly(block: pd.DataFrame) -> pd.DataFrame:
    import random

    block = block.sort_values(["spread", "size", "id"], kind="stable", na_position="last")
    generator = random.Random(int(block["spread"].iloc[0]))
    sizes, p = block["size"].astype(float).tolist(), block["p"].tolist()
    p = flight(sizes, p, generator)
    if block["blocks"].iloc[0] == 1:
        p = landing(sizes, p)
    block["p"] = p
    return block


def mix(
    units: DataFrame, weights: list[float] | None = None, share: float = 1.5, cap: float = 2.0, block_rows: int = 4096
) -> DataFrame:
    """Choose how often each unit is taken.

    ``units`` has ``id`` (bigint), ``source`` and ``size`` (bigint); other
    columns are dropped.  Returns ``id, source, size, source_size, target,
    copies``; ``copies`` is at most ``ceil(cap)`` and its words come to the
    target of each source within about one document.  Sources of size 0 have
    target 0.  A null source is a source of its own, last in order.  Rows with
    the same id are units of their own; rows equal in all columns are
    interchangeable.  Reruns agree: the order and the random numbers derive from
    ids.  An empty table gives an empty result.
    """
    weights = weights or [3.0, 1.0, 2.0]
    units = units.select(F.col("id").cast("long").alias("id"), F.col("source").cast("string").alias("source"), "size")
    targets = saved(source_targets(units, weights, share, cap), "mix-targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = (
        units.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("sure", F.floor(expected + _EPS).cast("long"))
        .withColumn("p", F.greatest(F.lit(0.0), expected - F.col("sure")))
        .withColumn("spread", F.xxhash64("id", F.lit("mix")))
    )
    columns = ["id", "source", "size", "source_size", "target", "sure", "p", "spread"]
    schema = (
        "id bigint, source string, size bigint, source_size bigint, target double, sure bigint, p double, "
        "spread bigint, blocks bigint, block bigint"
    )
    open_rows = targets.agg(F.max("source_rows")).first()[0] or 0
    remaining, decided, level = joined.select(*columns, "source_rows"), [], 0
    while True:
        blocks = F.ceil(F.col("source_rows") / block_rows).cast("long")
        level += 1
        flown = (
            remaining.withColumn("blocks", F.greatest(blocks, F.lit(1)))
            .withColumn("block", F.pmod(F.xxhash64("spread", "size", F.lit(level)), F.col("blocks")))
            .select(*columns, "blocks", "block")
            .groupBy("source", "block")
            .applyInPandas(_fly, schema)
        )
        flown = saved(flown, f"mix-{level}")
        if open_rows <= block_rows:
            decided.append(flown.select(*columns))
            break
        whole = (F.col("p") == 0) | (F.col("p") == 1)
        decided.append(flown.where(whole).select(*columns))
        left = flown.where(~whole).select(*columns)
        counts = left.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("source_rows"))
        remaining = left.join(counts, F.col("source").eqNullSafe(F.col("_source"))).select(*columns, "source_rows")
        open_rows = counts.agg(F.max("source_rows")).first()[0] or 0
        if not open_rows:
            break
    result = decided[0]
    for part in decided[1:]:
        result = result.unionByName(part)
    copies = (F.col("sure") + F.round("p").cast("long")).alias("copies")
    return result.select("id", "source", "size", "source_size", "target", copies)
