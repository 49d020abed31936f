"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the set of 64-bit digests of its paragraphs.  Its sketch has three
tables of ``w`` cells; a digest enters one cell of each with a count, a key sum
and a check sum (both by exclusive or).  Two sketches subtract cell by cell:
what both versions share cancels, and cells holding one digest peel off until
nothing is left.  A difference that does not peel is tried again with twice the
cells and other positions.

Everything is DataFrame operations.  Digests are dealt by document once; cells
are aggregated where they arise and never leave their task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.llm.common import saved, whole_text

BASE_WIDTH = 8  # cells of each table in a fingerprint
ROUNDS = 10  # peeling rounds of one attempt; each peels one of the three tables
BLOCK_ROWS = 4096  # documents of a block whose neighbours are found by a window
TASK_DIGESTS = 400_000
BROADCAST_ROWS = 1_000_000  # pairs to try again that may be broadcast: 12 MB of numbers
_CHECK = 97  # seed of the check sum


def paragraphs(text: Column) -> Column:
    """Non-empty pieces of a text between line breaks and sentence ends, so that one-line texts have parts too."""
    return F.filter(F.split(text, r"[\n.!?]+"), lambda p: p != "")


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs, none of them 0."""
    hashed = F.transform(paragraphs(text), lambda p: F.xxhash64(p))
    return F.array_distinct(F.transform(hashed, lambda d: F.when(d == 0, F.lit(1).cast("long")).otherwise(d)))


def _cell(digest: Column, table: Column | int, width: Column, attempt: int) -> Column:
    """Cell within a table; widths are powers of two, at most 2**20."""
    h = digest if attempt == 0 else F.xxhash64(digest, F.lit(attempt))
    shift = 20 * table
    shifted = F.call_function("shiftright", h, shift if isinstance(shift, Column) else F.lit(shift))
    return shifted.bitwiseAND(width.cast("long") - 1)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(_CHECK))


def fingerprint(found: Column) -> Column:
    """Sketch of a digest array as text: paragraph count, then count, key and check sum of 3 x 8 cells in hex."""

    def within(table: int, place: int) -> Column:
        return F.filter(found, lambda d: _cell(d, table, F.lit(BASE_WIDTH), 0) == place)

    def cell(inside: Column) -> Column:
        key = F.aggregate(inside, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(d))
        check = F.aggregate(inside, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(_check(d)))
        return F.concat_ws("-", F.hex(F.size(inside).cast("long")), F.hex(key), F.hex(check))

    cells = F.array(*[within(table, place) for table in range(3) for place in range(BASE_WIDTH)])
    return F.lower(F.concat_ws(":", F.size(found).cast("string"), F.array_join(F.transform(cells, cell), ",")))


def _first_width(expected: Column) -> Column:
    """A power of two, at least the base width, whose three tables hold ``expected`` digests at a load of a third to two."""
    wanted = F.greatest(F.lit(float(BASE_WIDTH)), expected * 0.75)
    return F.least(F.pow(F.lit(2.0), F.ceil(F.log2(wanted))), F.lit(float(1 << 20))).cast("int")


def differences(pairs: DataFrame, keep_digests: bool = False, dealt: bool = False) -> DataFrame:
    """Set differences of digest arrays by subtracting and peeling sketches.

    ``pairs`` has ``row`` (long), ``kind`` (int), ``a`` and ``b``
    (array<bigint>) and ``share`` (double), the part of all digests expected to
    differ, which sets the first size.  (row, kind) is unique.  Returns ``row,
    kind, only_a, only_b`` (counts, or the recovered digests as arrays).
    ``dealt`` tells that the pairs are already partitioned by row.
    Attempts repeat with twice the cells until every pair has peeled.
    """
    expected = (F.size("a") + F.size("b")) * F.col("share")
    pending = pairs.withColumn("w", _first_width(expected)).drop("share")
    done, attempt = None, 0
    while True:
        spread = pending if dealt and attempt == 0 else _by_row(pending, F.size("a") + F.size("b"))
        peeled = saved(_attempt(spread, attempt, keep_digests), f"peeled-{attempt}")
        good = peeled.where("open = 0").drop("open")
        done = good if done is None else done.unionByName(good)
        failed = peeled.where("open > 0").select("row", "kind")
        count = failed.count()
        if not count:
            return done
        if count <= BROADCAST_ROWS:  # else the pairs are shuffled once more to meet their failures
            failed = F.broadcast(failed)
        again = pending.join(failed, ["row", "kind"], "left_semi")
        pending = saved(again.withColumn("w", F.least(F.col("w") * 2, F.lit(1 << 20))), f"pending-{attempt}")
        attempt += 1


def _by_row(frame: DataFrame, digests_of_row: Column) -> DataFrame:
    """Rows dealt by ``row``, so many that a task has about ``TASK_DIGESTS`` cell entries."""
    weight = frame.agg(F.sum(digests_of_row)).first()[0] or 0
    tasks = max(1, math.ceil(3 * weight / TASK_DIGESTS))
    return frame.repartition(tasks, "row") if tasks > 1 else frame.coalesce(1)


def _attempt(pairs: DataFrame, attempt: int, keep_digests: bool) -> DataFrame:
    """``row, kind, only_a, only_b, open``: open is the number of cells that did not peel."""
    keys = ["row", "kind", "w", "cell"] + (["tag"] if keep_digests else [])
    key, cnt, chk, cell, w, o = (F.col(c) for c in ("key", "cnt", "chk", "cell", "w", "o"))
    zero = F.lit(0).cast("long")

    def ints(*values: int) -> Column:
        return F.array(*[F.lit(v) for v in values])

    def place(table: Column) -> Column:
        return (_cell(key, table, w, attempt) + table * w).cast("int")

    def summed(frame: DataFrame) -> DataFrame:
        added = frame.groupBy(*keys).agg(
            F.sum("cnt").alias("cnt"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk")
        )
        return added.where("cell < 0 OR cnt <> 0 OR key <> 0 OR chk <> 0")

    # one digest more, 0, stands for the pair itself: it goes to cell -1 and keeps pairs without a difference
    digest = F.posexplode(F.concat("a", "b", F.array(zero))).alias("at", "key")
    entries = pairs.select("row", "kind", "w", F.size("a").alias("n"), digest)
    cells = entries.withColumn("o", F.explode(F.when(key == 0, ints(-1)).otherwise(ints(0, 1, 2)))).select(
        "row", "kind", "w",
        F.when(o < 0, F.lit(-1)).otherwise(place(o)).alias("cell"),
        F.when(o < 0, zero).when(F.col("at") < F.col("n"), F.lit(1)).otherwise(F.lit(-1)).cast("long").alias("cnt"),
        "key",
        F.when(o < 0, zero).otherwise(_check(key)).alias("chk"),
        zero.alias("tag"),
    )
    state = summed(cells)
    itself, found = 9, -1
    for step in range(ROUNDS):
        table = step % 3
        pure = (cell >= table * w) & (cell < (table + 1) * w) & (F.abs("cnt") == 1) & (chk == _check(key))
        others = [t for t in range(3) if t != table]
        fan = F.explode(F.when(pure, ints(*others, found)).otherwise(ints(itself)))
        kept = F.col("tag") if keep_digests else zero
        state = summed(
            state.withColumn("o", fan).select(
                "row", "kind", "w",
                F.when(o == itself, cell).when(o == found, F.when(cnt > 0, -1).otherwise(-2)).otherwise(place(o)).alias("cell"),
                F.when(o == itself, cnt).when(o == found, F.lit(1).cast("long")).otherwise(-cnt).alias("cnt"),
                F.when(o == found, zero).otherwise(key).alias("key"),
                F.when(o == found, zero).otherwise(chk).alias("chk"),
                F.when(o == itself, kept).when(o == found, key).otherwise(zero).alias("tag"),
            )
        )
    if keep_digests:
        own = [F.collect_list(F.when((F.col("cell") == -k) & (F.col("cnt") > 0), F.col("tag"))) for k in (1, 2)]
    else:
        own = [F.coalesce(F.sum(F.when(F.col("cell") == -k, F.col("cnt"))), F.lit(0).cast("long")) for k in (1, 2)]
    return state.groupBy("row", "kind").agg(
        own[0].alias("only_a"), own[1].alias("only_b"), F.count(F.when(F.col("cell") >= 0, 1)).alias("open")
    )


def with_next(docs: DataFrame) -> DataFrame:
    """Add ``next_text``: the text of the next row by descending ``id`` (nulls last, ties by text); last to first.

    Ids are cut into blocks of about 4096 rows by value; a window per block
    finds neighbours within it.  Only the last row of a block looks further: to
    the first row of the next block below, over one row per block.
    """
    facts = docs.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("rows")).first()
    lo, hi = facts.lo or 0, facts.hi or 0
    width = max(1.0, (hi - lo + 1) / max(1, math.ceil(facts.rows / BLOCK_ROWS)))
    block = F.coalesce(F.floor((F.col("id").cast("double") - float(lo)) / width), F.lit(-1).cast("long"))
    placed = docs.withColumn("block", block)
    order = Window.partitionBy("block").orderBy(F.col("id").desc_nulls_last(), "text")
    rows = placed.withColumns({"next_text": F.lead("text").over(order), "place": F.row_number().over(order)})
    # one row per block: its first id; nulls sort last, so only the lowest block can lack one
    heads = placed.groupBy("block").agg(F.max("id").alias("head"))
    below = Window.orderBy(F.desc("block"))
    wrapped = Window.partitionBy()
    following = heads.select(
        F.col("block").alias("_block"),
        F.coalesce(F.lead("block").over(below), F.max("block").over(wrapped)).alias("_next_block"),
    )
    chosen = heads.withColumnsRenamed({"block": "_next_block", "head": "_head"})
    if facts.rows / BLOCK_ROWS <= BROADCAST_ROWS:  # a pair of numbers a block; else the texts are shuffled to meet the heads
        chosen = F.broadcast(chosen)
    texts = (
        docs.select(F.col("id").alias("_id"), F.col("text").alias("_text"))
        .join(chosen, F.col("_id").eqNullSafe(F.col("_head")))
        .groupBy("_next_block")
        .agg(F.min("_text").alias("_head_text"))
    )
    ends = following.join(texts, "_next_block").select("_block", "_head_text")
    return (
        rows.join(ends, F.col("block") == F.col("_block"), "left")
        .withColumn("next_text", F.coalesce("next_text", "_head_text"))
        .drop("_block", "_head_text", "block", "place")
    )


def likeness(a: Column, b: Column, different: Column) -> Column:
    """Jaccard likeness of two sets from their sizes and the size of their difference; 1 for two empty sets."""
    return F.when(a + b == 0, F.lit(1.0)).otherwise((a + b - different) / (a + b + different))


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text, an edited version of it, and the next document.

    The edited text has its last ``floor(n_chars / 3)`` code points replaced by
    the first as many (or all) of the next document by descending id; after the
    last comes the first.  Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next`` and the counts
    ``paragraphs, edited_paragraphs, next_paragraphs``.  Null texts are empty;
    an empty text equals another empty one (likeness 1) and nothing else (0).
    Ids may be null (last) or repeat (ordered by text); every row is compared.
    Extra columns are dropped; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - cut).cast("int")), F.substring("next_text", F.lit(1), cut))
    texts = with_next(base).select("id", n.cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    sets = saved(
        texts.select(
            "id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"),
            digests(F.col("edited")).alias("changed"),
            digests(F.col("next_text")).alias("following"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    # an edit touches about a third of either version; a neighbour may share nothing
    pair = [
        F.struct(F.lit(k).alias("kind"), F.col("own").alias("a"), F.col(c).alias("b"), F.lit(share).alias("share"))
        for k, c, share in ((0, "changed", 0.4), (1, "following", 1.0))
    ]
    own_size = 2 * F.size("own") + F.size("changed") + F.size("following")
    spread = _by_row(sets.select("row", "own", "changed", "following"), own_size)
    pairs = spread.select("row", F.explode(F.array(*pair)).alias("p")).select("row", "p.*")
    counts = (
        differences(pairs, dealt=True)
        .groupBy("row")
        .pivot("kind", [0, 1])
        .agg(F.first(F.col("only_a") + F.col("only_b")))
        .select(F.col("row").alias("_row"), F.col("0").alias("_edited"), F.col("1").alias("_next"))
    )
    a, b = F.size("own"), F.size("changed")
    compared = sets.withColumn("n_following", F.size("following")).drop("following")
    return compared.join(counts, F.col("row") == F.col("_row")).select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(a, b, F.col("_edited")).alias("near_edited"),
        likeness(a, F.col("n_following"), F.col("_next")).alias("near_next"),
        a.cast("long").alias("paragraphs"),
        b.cast("long").alias("edited_paragraphs"),
        F.col("n_following").cast("long").alias("next_paragraphs"),
    )
