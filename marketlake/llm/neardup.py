"""Near duplicates by a signature-coordinate inverted join.

1. Every text becomes its set of word shingles and a MinHash signature; texts
   with equal sets collapse to one class.
2. Classes are posted under each (coordinate, value) of their signature.  Two
   sets above the threshold agree on at least ``need`` of the coordinates (but
   for a chance of 1e-5), so they share one of the ``H - need + 1`` rarest
   postings of either: only this prefix is joined, and postings nobody shares
   fill it first at no cost.
3. Within a posting list collisions are counted on whole signatures.  A class
   that has met a component through one member skips its other members; what
   leaves a list is a spanning forest, never all pairs.
4. The forest's components are blocks that hold every candidate pair.  Within a
   block links are confirmed on full shingle sets, again skipping pairs already
   connected.  Large blocks are cut into chunks; chunks meet through their
   roots, and only what is still apart is compared chunk by chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marketlake.llm.common import saved, shipped, whole_text
from marketlake.llm.graph import components

shipped(__name__)

COORDINATES = 64
MISS = 1e-5  # chance that a pair exactly at the threshold has fewer matching coordinates than needed
HOT_LIST = 20_000  # longer lists become blocks as they are: a superset, settled by the exact step
BLOCK_SHINGLES = 2_000_000  # shingles of a block held by a task
_U = np.uint64


def matches_needed(threshold: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Largest number of matches that a pair at the threshold reaches with probability 1 - miss."""
    below = 0.0
    for k in range(coordinates + 1):
        below += math.comb(coordinates, k) * threshold**k * (1 - threshold) ** (coordinates - k)
        if below > miss:
            return max(1, k)
    return coordinates


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _factors() -> tuple[np.ndarray, np.ndarray]:
    seeds = _mix(np.arange(1, 2 * COORDINATES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15 >> 1))
    return seeds[:COORDINATES] | _U(1), seeds[COORDINATES:]


class _Words(dict):
    """Word -> 64-bit hash, kept while it is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, size: int, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z lower-cased, words cut at [\\x20\\x09-\\x0D]."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, _U)
    hashes = np.array([words[w] for w in parts], dtype=_U)
    width = min(size, len(parts))
    count = len(parts) - width + 1
    with np.errstate(over="ignore"):
        joined = np.full(count, _U(width) * _U(0xD6E8FEB86659FD93))
        for i in range(width):
            joined = _mix(joined * _U(0x9E3779B97F4A7C15) + hashes[i : i + count])
    return np.unique(joined)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, 32 bits for each coordinate."""
    factors, offsets = _factors()
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=_U)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 2048):
            part = shingles[start : start + 2048, None] * factors + offsets
            np.minimum(least, part.min(axis=0), out=least)
    return (least >> _U(32)).astype(np.uint32)


class Forest:
    """Union-find over list places."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def collision_forest(marks: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs that agree on ``need`` or more of their marks (one byte a coordinate)."""
    edges: list[tuple[int, int]] = []
    groups: list[list[int]] = []  # members of each component, its first one stands for it
    for j in range(len(marks)):
        met = []
        if groups:
            heads = (marks[[g[0] for g in groups]] == marks[j]).sum(axis=1) >= need
            for g, head in enumerate(heads.tolist()):
                if head:
                    met.append((g, groups[g][0]))
                elif len(groups[g]) > 1:
                    agree = (marks[groups[g]] == marks[j]).sum(axis=1)
                    best = int(agree.argmax())
                    if agree[best] >= need:
                        met.append((g, groups[g][best]))
        edges += [(i, j) for _, i in met]
        if not met:
            groups.append([j])
            continue
        target = groups[met[0][0]]
        for g, _ in reversed(met[1:]):
            target += groups.pop(g)
        target.append(j)
    return edges


def confirmed_links(
    sets: list[np.ndarray], labels: list[int], chunks: list[int] | None, threshold: tuple[int, int]
) -> list[tuple[int, int]]:
    """Links between places that join their labels' components, checked on full sets.

    ``threshold`` is a fraction (a, b): b * intersection >= a * union.  Pairs
    whose labels are already joined are skipped, also pairs of one chunk if
    ``chunks`` is given (they were checked before).
    """
    above, below = threshold
    need = matches_needed(above / below)
    marks = np.array([(signature(s) & 255).astype(np.uint8) for s in sets]).reshape(len(sets), COORDINATES)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    first: dict[int, int] = {}
    forest = Forest(len(sets))
    for i, label in enumerate(labels):
        forest.join(first.setdefault(label, i), i)
    where = np.array(chunks) if chunks is not None else None
    links = []
    for j in range(1, len(sets)):
        agree = (marks[:j] == marks[j]).sum(axis=1)
        small, large = np.minimum(sizes[:j], sizes[j]), np.maximum(sizes[:j], sizes[j])
        possible = (agree >= need) & (below * small >= above * large)
        if where is not None:
            possible &= where[:j] != where[j]
        candidates = np.flatnonzero(possible)
        for i in candidates[np.argsort(-agree[candidates], kind="stable")].tolist():
            if forest.root(i) == forest.root(j):
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if below * shared >= above * (sizes[i] + sizes[j] - shared):
                forest.join(i, j)
                links.append((i, j))
    return links


def _bytes(column: pa.Array) -> list[bytes]:
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with equal first ``keys`` columns, of a sorted stream, one run at a time."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        words = _Words()
        for batch in batches:
            ns, digests, signatures = [], [], []
            for text in _bytes(batch.column(1)):
                shingles = shingle_set(text, size, words)
                ns.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles).view(np.int32) if len(shingles) else None)
            arrays = [batch.column(0), pa.array(ns, pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(signatures, pa.list_(pa.int32()))], names=["id", "n", "digest", "signature"]
            )

    return docs.mapInArrow(run, "id bigint, n bigint, digest binary, signature array<int>")


def _postings(classes: DataFrame, need: int) -> DataFrame:
    """``token, freq, node``: the shared postings within the rarest ``H - need + 1`` of each class."""
    tokens = classes.select("node", F.posexplode("signature").alias("at", "value")).select(
        "node", F.xxhash64("at", "value").alias("token")
    )
    shared = tokens.groupBy("token").agg(F.count("*").alias("freq")).where("freq > 1")
    prefix = COORDINATES - need + 1
    return (
        tokens.join(shared, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("found"))
        .withColumn("slots", F.size("found") - (COORDINATES - prefix))
        .where("slots > 0")
        .select("node", F.explode(F.slice("found", F.lit(1), F.col("slots"))).alias("p"))
        .select("p.token", "p.freq", "node")
    )


def _candidate_edges(classes: DataFrame, need: int) -> DataFrame:
    postings = saved(_postings(classes, need), "postings")

    def run(batches):
        found: list[tuple[int, int]] = []
        for rows in _runs(batches, 1):
            if len(rows) < 2:
                continue
            marks = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), COORDINATES)
            found += [(rows[i][1], rows[j][1]) for i, j in collision_forest(marks, need)]
            if len(found) > 50_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    def low_bytes(batches):
        for batch in batches:
            rows = batch.column("signature").to_pylist()
            packed = [(np.array(s, np.int64) & 255).astype(np.uint8).tobytes() for s in rows]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], names=["node", "marks"])

    marks = classes.select("node", "signature").mapInArrow(low_bytes, "node bigint, marks binary")
    lists = (
        postings.where(F.col("freq") <= HOT_LIST)
        .join(marks, "node")
        .select("token", "node", "marks")
        .repartition("token")
        .sortWithinPartitions("token", "node")
        .mapInArrow(run, "a bigint, b bigint")
    )
    hot = postings.where(F.col("freq") > HOT_LIST)
    stars = hot.join(hot.groupBy("token").agg(F.min("node").alias("b")), "token").select(F.col("node").alias("a"), "b")
    return lists.union(stars.where("a <> b"))


def _link(blocks: DataFrame, size: int, threshold: tuple[int, int], across: bool) -> DataFrame:
    """Exact links of each block; columns ``comp, part, node, label, chunk, text``."""

    def run(batches):
        words = _Words()
        for rows in _runs(batches, 2):
            sets = [shingle_set((r[5] or "").encode("utf-8", "surrogatepass"), size, words) for r in rows]
            chunks = [r[4] for r in rows] if across else None
            links = confirmed_links(sets, [r[3] for r in rows], chunks, threshold)
            yield _edges([(rows[i][1 + 1], rows[j][1 + 1]) for i, j in links])

    return (
        blocks.select("comp", "part", "node", "label", "chunk", "text")
        .repartition("comp", "part")
        .sortWithinPartitions("comp", "part", "node")
        .mapInArrow(run, "a bigint, b bigint")
    )


def _exact_edges(members: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """Links of all blocks.  ``members``: ``comp, node, n, chunks, chunk, text``."""
    own = members.withColumns({"part": F.col("chunk"), "label": F.col("node")})
    edges = saved(_link(own, size, threshold, False), "links")
    large = members.where("chunks > 1")
    if large.isEmpty():
        return edges

    def labelled(found: DataFrame) -> DataFrame:
        roots = components(found).withColumnsRenamed({"node": "_node"})
        joined = large.join(roots, F.col("node") == F.col("_node"), "left")
        return joined.withColumn("label", F.coalesce("component", "node")).drop("_node", "component")

    # one root stands for each chunk's component
    roots = labelled(edges).where("label = node").withColumn("part", F.lit(0).cast("long"))
    weight = roots.groupBy(F.col("comp").alias("_comp")).agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("parts"))
    roots = roots.join(weight, F.col("comp") == F.col("_comp")).withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(1)), "parts")
    )
    edges = saved(edges.union(_link(roots, size, threshold, False)), "links-roots")
    # what is still apart meets chunk by chunk
    current = saved(labelled(edges), "labelled")
    apart = current.groupBy(F.col("comp").alias("_comp")).agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    rest = current.join(apart.where("lo <> hi"), F.col("comp") == F.col("_comp"))
    if rest.isEmpty():
        return edges
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    pairs = (
        rest.select("*", other)
        .where("other <> chunk")
        .withColumn("part", F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other"))
    )
    return edges.union(_link(pairs, size, threshold, True))


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    threshold: tuple[int, int] = (80, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents are linked when ``b * |A & B| >= a * |A | B|`` for ``threshold =
    (a, b)`` on their sets of shingles of ``shingle_words`` words; a component is
    everything reachable over links, named by its smallest id; the document with
    that id is kept.  A text with fewer words is one shingle; a null text or one
    without words has no shingles, links with nothing and is kept.  Rows with
    the same id and different texts are told apart; rows equal in both are
    copies and share their answer.  A null id never names a component.  Extra
    columns are dropped.  An empty table gives no rows.
    """
    above, below = threshold
    need = matches_needed(above / below)
    base = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    sketches = saved(_sketches(base, shingle_words), "sketches")
    classes = saved(
        sketches.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    candidates = saved(components(_candidate_edges(classes, need)), "candidates")

    # whole texts of the classes in blocks, one row per class
    wanted = (
        candidates.join(classes.select("node", "first", "n", "digest"), "node")
        .withColumnRenamed("component", "comp")
        .where(F.col("first").isNotNull())
    )
    weight = wanted.groupBy(F.col("comp").alias("_comp")).agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("chunks"))
    placed = (
        wanted.join(weight, F.col("comp") == F.col("_comp"))
        .drop("_comp")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    )

    def same_text(batches):
        """Where an id occurs with several texts, only the class's own one counts; copies once."""
        words = _Words()
        for batch in batches:
            texts, digests = _bytes(batch.column("text")), batch.column("digest").to_pylist()
            same = [
                xxhash.xxh3_128_digest(shingle_set(t, shingle_words, words).tobytes()) == d
                for t, d in zip(texts, digests, strict=True)
            ]
            yield batch.filter(pa.array(same, pa.bool_())).drop_columns(["digest"])

    members = saved(
        base.join(placed, F.col("id") == F.col("first"))
        .select("comp", "node", "n", "chunks", "chunk", "text", "digest")
        .mapInArrow(same_text, "comp bigint, node bigint, n bigint, chunks bigint, chunk bigint, text string")
        .dropDuplicates(["node"]),
        "members",
    )
    linked = components(_exact_edges(members, shingle_words, threshold)).withColumnRenamed("node", "_node")
    named = saved(
        classes.select("digest", "node", "first")
        .join(linked, F.col("node") == F.col("_node"), "left")
        .select("digest", "first", F.coalesce("component", "node").alias("component")),
        "named",
    )
    smallest = named.groupBy(F.col("component").alias("_c")).agg(F.min("first").alias("component_id"))
    answer = named.join(smallest, F.col("component") == F.col("_c")).select(
        F.col("digest").alias("_digest"), "component_id"
    )
    component = F.coalesce("component_id", "id")
    return sketches.join(answer, F.col("digest") == F.col("_digest"), "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.col("id").isNull()).alias("kept"),
    )
