"""Approximate nearest neighbours by multiprobe p-stable hashing, for the largest inner product.

Vectors are lifted by one coordinate to a common norm, so that the largest
inner product is the smallest distance.  Each table hashes a vector by ``k``
Gaussian (2-stable) projections cut into slots of width ``w``; a bucket is a
tuple of slots.  A query visits buckets in descending estimated probability of
holding a neighbour, until the probabilities sum to a target.  The target is the
smallest one that reaches the wanted recall on a bounded sample; every vector is
indexed.  The tables' candidates are merged and ranked by the exact product.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.llm.common import saved, shipped

shipped(__name__)

SLOTS = 3
SAMPLE_ROWS = 4096  # bound of the sample the index is fitted on
SHARD_ROWS = 16_384  # vectors of a table a task holds
QUERY_ROWS = 2_048  # queries a task holds


@dataclass
class Index:
    """Parameters of the tables; ``planes`` is (tables, k, dimension + 1)."""

    planes: np.ndarray
    offsets: np.ndarray  # (tables, k)
    width: float
    norm: float
    slope: float  # a neighbour's projection is about slope * the query's ...
    spread: float  # ... with this standard deviation
    target: float

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.norm**2 - (vectors**2).sum(axis=1)))
        return np.hstack([vectors, rest[:, None]])

    def codes(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Bucket of each vector: its slots as digits; the outer slots are open to infinity."""
        at = (self.lift(vectors) @ self.planes[table].T + self.offsets[table]) / self.width
        slots = np.clip(np.floor(at).astype(np.int64), 0, SLOTS - 1)
        return slots @ (SLOTS ** np.arange(self.planes.shape[1]))

    def visits(self, queries: np.ndarray, table: int) -> np.ndarray:
        """(queries, buckets): whether the query visits the bucket, likeliest first up to the target."""
        scaled = queries * (self.norm / np.linalg.norm(queries, axis=1))[:, None]
        lifted = np.hstack([scaled, np.zeros((len(queries), 1))])
        centre = self.slope * (lifted @ self.planes[table].T)
        chances = np.ones((len(queries), 1))
        for j in range(self.planes.shape[1]):
            edges = self.width * np.arange(1, SLOTS) - self.offsets[table, j]
            below = _normal_cdf((edges[None, :] - centre[:, j, None]) / self.spread)
            slot = np.diff(np.hstack([np.zeros((len(queries), 1)), below, np.ones((len(queries), 1))]), axis=1)
            chances = (slot[:, :, None] * chances[:, None, :]).reshape(len(queries), -1)
        order = np.argsort(-chances, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(chances, order, axis=1), axis=1)
        reached = sums - np.take_along_axis(chances, order, axis=1) < self.target
        out = np.zeros(chances.shape, dtype=bool)
        np.put_along_axis(out, order, reached, axis=1)
        return out


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """Standard normal distribution function (Abramowitz and Stegun 7.1.26, error below 2e-7)."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * np.exp(-z * z) / 2
    return np.where(x < 0, tail, 1 - tail)


def fit(sample: np.ndarray, norm: float, rows: int, tables: int, top: int, recall: float, seed: int = 7) -> Index:
    """Choose slots and probe target on a sample; about 64 vectors a bucket for ``rows`` vectors."""
    k = min(8, max(1, round(math.log(max(rows / 64, SLOTS), SLOTS))))
    random = np.random.default_rng(seed)
    planes = random.standard_normal((tables, k, sample.shape[1] + 1))
    index = Index(planes, np.zeros((tables, k)), 1.0, norm, 1.0, 1.0, 1.0)
    projected = np.einsum("nd,tkd->ntk", index.lift(sample), planes)
    index.width = float(projected.std(axis=0).mean()) or 1.0
    # the middle slot sits around the median, moved by up to half a width
    shift = random.uniform(-0.5, 0.5, (tables, k)) * index.width
    index.offsets = index.width * SLOTS / 2 - np.median(projected, axis=0) + shift
    queries = sample[: min(len(sample), 200)]
    products = queries @ sample.T
    np.put_along_axis(products, np.arange(len(queries))[:, None], -np.inf, axis=1)
    near = np.argsort(-products, axis=1, kind="stable")[:, : min(top, len(sample) - 1)]
    if near.shape[1] == 0:
        return index
    scale = np.linalg.norm(queries, axis=1)[:, None] * norm
    index.slope = float(np.clip((np.take_along_axis(products, near, axis=1) / scale).mean(), 0.0, 1.0))
    index.spread = max(1e-6, norm * math.sqrt(max(1e-12, 1 - index.slope**2)))
    codes = [index.codes(sample, t)[near] for t in range(tables)]
    for index.target in (0.3, 0.4, 0.5, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.98, 1.1):
        met = np.zeros(near.shape, dtype=bool)
        for t in range(tables):
            met |= np.take_along_axis(index.visits(queries, t), codes[t], axis=1)
        if met.mean() >= recall:
            break
    return index


def _usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    top: int = 20,
    recall: float = 0.94,
    tables: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``top`` rows with the largest inner product for each row where ``is_query`` holds.

    Returns ``query_id, rank, vec_id, score``; a row is no candidate of its own,
    ties go to the smaller id, fewer candidates give fewer rows.  Vectors that
    are null, zero or hold null or non-finite components take no part, nor do
    rows without an id or of another dimension than the commonest one (of
    several, the largest).  Equal vectors are indexed once and keep the ``top +
    1`` smallest ids, which no answer can exceed; rows that repeat id and vector
    count once.  Extra columns are dropped; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    usable = (
        vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), is_query.alias("asks"))
        .where(F.col("id").isNotNull() & _usable(F.col("v")))
        .withColumn("asks", F.coalesce("asks", F.lit(False)))
        .distinct()
    )
    sizes = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if sizes is None:
        return empty
    usable = usable.where(F.size("v") == sizes.d)
    first = Window.partitionBy("v").orderBy("id")
    classes = saved(
        usable.select("id", "v")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= top + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("node", F.col("ids")[0]),
        "vector-classes",
    )
    asking = saved(
        usable.where("asks").select("id", "v").join(classes.select("v", "node"), "v").select("id", "node"), "asking"
    )
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_ROWS).select("v").toPandas()
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = classes.agg(F.count("*").alias("rows"), F.max(length).alias("norm")).first()
    queries = classes.join(asking.select("node").distinct(), "node").select(F.col("node").alias("q"), "v")
    n_queries = queries.count()
    if not n_queries:
        return empty
    index = fit(np.array(sample["v"].tolist()), facts.norm, facts.rows, tables, top, recall)
    shards, blocks = math.ceil(facts.rows / SHARD_ROWS), math.ceil(n_queries / QUERY_ROWS)
    buckets = SLOTS ** index.planes.shape[1]

    def placed(frames):
        for frame in frames:
            x = np.array(frame["v"].tolist()).reshape(len(frame), -1)
            for t in range(tables):
                yield frame.assign(t=t, code=index.codes(x, t))

    # a bucket's vectors lie together; a bucket larger than a shard is dealt over several
    entries = classes.select("node", "v").mapInPandas(placed, "node bigint, v array<double>, t int, code bigint")
    spread = F.floor(F.col("code") * shards / buckets).cast("long")
    load = saved(entries.groupBy("t", spread.alias("s")).agg(F.ceil(F.count("*") / SHARD_ROWS).alias("pieces")), "load")

    def routed(frames):
        """A query goes to the shards that hold a bucket it visits."""
        shard = np.arange(buckets) * shards // buckets
        for frame in frames:
            q = np.array(frame["v"].tolist()).reshape(len(frame), -1)
            for t in range(tables):
                visits = index.visits(q, t)
                for s in range(shards):
                    hit = visits[:, shard == s].any(axis=1)
                    yield frame[hit].assign(t=t, s=s)

    entries = (
        entries.withColumn("s", spread)
        .join(load, ["t", "s"])
        .withColumn("piece", F.pmod(F.xxhash64("node"), "pieces"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    asked = (
        queries.mapInPandas(routed, "q bigint, v array<double>, t int, s bigint")
        .withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))
        .join(load.withColumnsRenamed({"t": "_t", "s": "_s"}), (F.col("t") == F.col("_t")) & (F.col("s") == F.col("_s")))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    )

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["q", "node", "score"]
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in columns})
        table, keep = int(key[0]), top + 1
        x, codes, nodes = np.array(left["v"].tolist()), left["code"].to_numpy(), left["node"].to_numpy()
        order = np.lexsort((nodes, codes))
        x, codes, nodes = x[order], codes[order], nodes[order]
        present, starts = np.unique(codes, return_index=True)
        ends = np.append(starts[1:], len(codes))
        q, asks = np.array(right["v"].tolist()), right["q"].to_numpy()
        out = []
        for begin in range(0, len(q), 128):
            some = q[begin : begin + 128]
            visits = index.visits(some, table)[:, present]
            for i, vector in enumerate(some):
                visited = np.flatnonzero(visits[i])
                if not len(visited):
                    continue
                rows = np.concatenate([np.arange(starts[b], ends[b]) for b in visited])
                scores = x[rows] @ vector
                if len(rows) > keep:  # the keep best and whatever ties with the last of them
                    least = np.partition(scores, len(rows) - keep)[len(rows) - keep]
                    best = np.flatnonzero(scores >= least - abs(least) * 1e-12)
                    best = best[np.lexsort((nodes[rows[best]], -scores[best]))][:keep]
                    rows, scores = rows[best], scores[best]
                out.append((np.full(len(rows), asks[begin + i]), nodes[rows], scores))
        if not out:
            return pd.DataFrame({c: [] for c in columns})
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out, strict=True)), strict=True)))

    found = (
        entries.select("t", "s", "piece", "block", "code", "node", "v")
        .groupBy("t", "s", "piece", "block")
        .cogroup(asked.select("t", "s", "piece", "block", "q", "v").groupBy("t", "s", "piece", "block"))
        .applyInPandas(search, "q bigint, node bigint, score double")
    )
    # merge the tables, then score again on the original vectors, in one order of addition everywhere
    merged = found.groupBy("q", "node").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    short = merged.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top + 1).select("q", "node")
    product = F.aggregate(F.zip_with("a", "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = (
        short.join(queries.select("q", F.col("v").alias("a")), "q")
        .join(classes, "node")
        .select("q", "ids", product.alias("score"))
    )
    listed = scored.select(
        F.col("q").alias("node"), "score", F.explode("ids").alias("vec_id")
    )
    place = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("place", F.row_number().over(place)).where(F.col("place") <= top + 1)
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.withColumnRenamed("id", "query_id")
        .join(listed, "node")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= top)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
