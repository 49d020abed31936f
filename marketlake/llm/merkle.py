"""Merkle manifest of a table, built with lag and lead windows.

Leaves of a group (one per language) are numbered in order.  A level of the
tree needs no regrouping: within a block of ``fanout ** depth`` consecutive
nodes, a node's digest sits in the row of its first leaf, its siblings are found
by lag and lead at the fixed offsets ``fanout ** level``, masked by the node's
slot in its run and by the length of the run, and the first child's row hashes
the parent.  So one shuffle serves ``depth`` levels; the tops of the blocks are
the leaves of the next pass, which has ``fanout ** depth`` times fewer rows.
Proofs run back down by joins on the block number, whose rows are bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.llm.common import saved

DEPTH = 10  # levels per pass: blocks of 1024 rows at a fanout of two


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the fields' concatenation."""
    return F.sha2(F.concat(*(field(v) for v in values)).cast("binary"), 256)


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``i`` (place in its group from 0) and ``n`` (rows of the group).

    Rows are dealt by ranges of (group, order, input place): the last part
    spreads repeated rows, which are interchangeable.  Places come from counts
    per range, so no task sees a whole group.
    """
    kept = rows.columns
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(group, *order, "_tie")
    dealt = saved(dealt.withColumn("_part", F.spark_partition_id()), "merkle-leaves")
    counts = dealt.groupBy("_part", group).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_part").alias("_p"),
        F.col(group).alias("_g"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
    )
    place = Window.partitionBy("_part", group).orderBy(*order, "_tie")
    return (
        dealt.withColumn("_row", F.row_number().over(place))
        .join(offsets, (F.col("_part") == F.col("_p")) & (F.col(group) == F.col("_g")))
        .withColumn("i", (F.col("_offset") + F.col("_row") - 1).cast("long"))
        .select(*kept, "i", F.col("n").cast("long"))
    )


def _climb(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """``nodes`` (``g, i, n, d``) with ``top`` (digest of the block, in its first row) and ``steps``.

    ``steps`` has one entry per level: the digests left and right of the node on
    the way up, both empty in a run of one, null where the group's tree has ended.
    """
    size = fanout**depth
    rows = nodes.withColumn("_block", F.expr(f"i div {size}"))
    along = Window.partitionBy("g", "_block").orderBy("i")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.pmod(F.col("i"), F.lit(size))
    digest, steps = F.col("d"), []
    for level in range(depth):
        step = fanout**level
        first = at % step == 0
        slot = F.floor(at / step) % fanout
        live = F.col("n") > step  # more than one node on this level
        left = [
            F.when(slot >= o, F.lag(digest, o * step).over(along)).otherwise(F.lit("")) for o in range(fanout - 1, 0, -1)
        ]
        # past the end of the run there is no row: the last run is shorter
        right = [
            F.when(slot < fanout - o, F.coalesce(F.lead(digest, o * step).over(along), F.lit(""))).otherwise(F.lit(""))
            for o in range(1, fanout)
        ]
        names = [f"_d{level}", f"_l{level}", f"_r{level}"]
        rows = rows.withColumns({
            names[0]: digest,
            names[1]: F.when(first & live, F.concat(*left)),
            names[2]: F.when(first & live, F.concat(*right)),
        })
        own, before, after = (F.col(c) for c in names)
        parent = F.when(live, _hash(own, after)).otherwise(own)
        rows = rows.withColumn(f"_u{level}", F.when(first & (slot == 0), parent))
        # every leaf takes the siblings of its node, held by the node's first row
        steps.append(
            F.when(
                live,
                F.struct(
                    F.last(before, ignorenulls=True).over(upto).alias("left"),
                    F.last(after, ignorenulls=True).over(upto).alias("right"),
                ),
            )
        )
        digest = F.col(f"_u{level}")
    return rows.withColumn("steps", F.array(*steps)).withColumn("top", digest)


def grow(leaves: DataFrame, fanout: int = 2, depth: int = DEPTH) -> DataFrame:
    """``leaves`` (``g, i, n, d``) with ``steps`` (all live levels, leaf to root) and ``root`` of their group.

    ``fanout`` consecutive nodes become the hash of their concatenation, a last
    run of fewer, even of one, too, until one node is left; a lone leaf is its
    own root.  Groups must not be null.
    """
    base, passes = leaves, []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        levels = 1
        while levels < depth and fanout**levels < most:
            levels += 1
        size = fanout**levels
        passes.append(_climb(base, fanout, levels))
        if most <= size:
            break
        most = -(-most // size)
        tops = passes[-1].where(F.col("i") % size == 0).select(
            "g", F.expr(f"i div {size}").alias("i"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("top").alias("d")
        )
        base = saved(tops, "merkle-tops")
    above = None
    for part in reversed(passes):
        kept = [c for c in part.columns if not c.startswith("_") or c == "_block"]
        part = part.select(*kept)
        if above is None:
            # the highest pass has one block per group, whose first row holds the root
            roots = part.where("i = 0").select(F.col("g").alias("_g"), F.col("top").alias("root"))
            part = part.join(roots, F.col("g") == F.col("_g")).drop("_g")
        else:
            upper = above.select(
                F.col("g").alias("_g"), F.col("i").alias("_i"), F.col("steps").alias("_more"), "root"
            )
            part = part.join(upper, (F.col("g") == F.col("_g")) & (F.col("_block") == F.col("_i"))).withColumn(
                "steps", F.concat("steps", "_more")
            )
            part = part.drop("_g", "_i", "_more")
        above = part.withColumn("steps", F.filter("steps", lambda s: s.isNotNull())).drop("_block", "top")
    return above


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda acc, s: _hash(s["left"], acc, s["right"]))


def proof(steps: Column) -> Column:
    """Digest of all siblings, leaf to root."""
    return _hash(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(
    rows: DataFrame,
    leaf: Column,
    seen: Column | None = None,
    group: str = "lang",
    key: str = "doc_id",
    fanout: int = 2,
    depth: int = DEPTH,
) -> DataFrame:
    """Per row of ``rows``: ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``leaf`` is the digest of a row as it was recorded, ``seen`` as it is found
    now (the same if left out).  Leaves of a group ascend by ``key`` (null
    first; equal keys by digest).  Groups' roots, ordered by group (null first,
    UTF-8 bytewise), make up the tree above.  ``folded_root`` is recomputed from
    the seen leaf and the recorded siblings; ``verified`` says that it is the
    root.  Each row is a leaf of its own, repeated rows too.  An empty table
    gives an empty result.  Other columns, of whatever name, are left out.
    """
    # null becomes '', a name gets a leading +: never null, and in the same order
    g = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    given = rows.select(
        g.alias("g"), F.col(key).alias("key"), leaf.alias("d"), (leaf if seen is None else seen).alias("seen")
    )
    tree = grow(numbered(given, "g", ["key", "d"]), fanout, depth)
    subroots = tree.where("i = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("d"))
    upper = grow(numbered(subroots, "g", ["name"]), fanout, depth)
    upper = upper.select(F.col("name").alias("_g"), F.col("root").alias("_root"), F.col("steps").alias("_more"))
    whole = tree.join(upper, F.col("g") == F.col("_g")).withColumn("_steps", F.concat("steps", "_more"))
    return whole.select(
        F.col("key").alias(key),
        F.col("d").alias("leaf"),
        F.col("root").alias("subroot"),
        F.col("_root").alias("root"),
        proof(F.col("_steps")).alias("proof_sha256"),
        fold(F.col("seen"), F.col("_steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
