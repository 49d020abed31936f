"""Top-k, pages and ranks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.session import checkpointed


def top_k(df: DataFrame, by: str, k: int, tie_breakers: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows (nulls last, ties in ascending tie-breaker order)."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie_breakers).limit(k)


def first_n(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows in a total order; None keeps everything."""
    return df if n is None else df.orderBy(*order).limit(n)


def positions(counted: DataFrame, order: Sequence[Column], n: str = "n") -> DataFrame:
    """Add ``before``, the sum of ``n`` over all rows ahead in ``order``, and ``total``, the sum over all rows.

    Rows are dealt to ranges of the order and summed within each range in one
    pass; the only window runs over one total per range.  The ranges are drawn
    by sampling, so they are written before anything refers to them.
    """
    schema = ", ".join(f"`{c}` {t}" for c, t in counted.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = 0
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
            ends = ahead + np.cumsum(sizes, dtype=np.int64)
            yield batch.append_column("ahead_", pa.array(ends - sizes, pa.int64()))
            ahead = int(ends[-1]) if len(ends) else ahead

    ranges = counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range_", F.spark_partition_id())
    summed = checkpointed(ranges.mapInArrow(run, f"{schema}, range_ int, ahead_ bigint"))
    # one row per range from here on
    totals = summed.groupBy("range_").agg(F.sum(n).alias("in_range_"))
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "range_",
        F.coalesce(F.sum("in_range_").over(earlier), F.lit(0)).alias("offset_"),
        F.sum("in_range_").over(Window.partitionBy()).alias("total"),
    )
    return summed.join(totals, "range_").select(
        *counted.columns, (F.col("offset_") + F.col("ahead_")).alias("before"), "total"
    )


def _after(name: str, value: Column, missing: bool, descending: bool | None) -> Column:
    """Rows that come after ``value``; ``descending`` None is a tie breaker: ascending with nulls first."""
    c = F.col(name)
    if descending is None:
        return c.isNotNull() if missing else F.coalesce(c > value, F.lit(False))
    if missing:
        return F.lit(False)
    return F.coalesce(c < value if descending else c > value, F.lit(True))


def _from_position(df: DataFrame, order: Sequence[tuple[str, bool | None]], start: int) -> DataFrame | None:
    """Rows from the one at ``start`` (from 0) on, among them those equal to it in all of ``order`` that come earlier.

    The row is found column by column: rows per value, among those that agree
    with it in the columns before, show which value holds the position.  Only
    that value reaches the driver.  None if there are fewer rows.
    """
    same: Column = F.lit(True)
    wanted: Column = F.lit(False)
    left = start
    for name, descending in order:
        counted = df.where(same).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        placed = positions(counted, [_order(name, descending)])
        found = placed.where((F.col("before") <= left) & (F.col("before") + F.col("n") > left)).first()
        if found is None:
            return None
        left -= found["before"]
        value = F.lit(found[name]).cast(df.schema[name].dataType)
        wanted = wanted | (same & _after(name, value, found[name] is None, descending))
        same = same & F.col(name).eqNullSafe(value)
    return df.where(wanted | same).orderBy(*[_order(*o) for o in order]).offset(left)


def _order(name: str, descending: bool | None) -> Column:
    if descending is None:
        return F.col(name).asc()
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def ranked_page(
    df: DataFrame,
    sort_by: str,
    tie_breakers: Sequence[str],
    page: int = 1,
    page_size: int = 100,
    descending: bool = True,
    where: Column | None = None,
) -> DataFrame:
    """One page of a ranked list, with the position as ``position``.

    Later pages seek their first row, so that the rows of earlier pages are
    counted and not sorted: the top-k behind a page holds ``page_size`` rows.
    A page behind the last row is empty.
    """
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size must be positive")
    if where is not None:
        df = df.where(where)
    order: list[tuple[str, bool | None]] = [(sort_by, descending), *((t, None) for t in tie_breakers)]
    by = [_order(*o) for o in order]
    start = (page - 1) * page_size
    rest = _from_position(df, order, start) if start else df.orderBy(*by)
    head = df.limit(0) if rest is None else rest.limit(page_size)
    return head.withColumn("position", F.row_number().over(Window.orderBy(*by)) + F.lit(start))


def metric_ranks(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Add ``<metric>_rank`` (ties share a rank, nulls come last) for each metric.

    A rank is the number of larger rows plus one.  The values of all metrics are
    counted and placed together: rows of (metric, value) with one value column
    per metric, so that every type stays exact.  Equal values are one row there,
    and no step sorts all rows in one task.  ``df`` must give the same rows each
    time it is read.
    """
    values = [f"value{i}_" for i in range(len(metrics))]
    entries = [
        F.struct(
            F.lit(i).alias("metric_"),
            *[(F.col(m) if i == k else F.lit(None).cast(df.schema[m].dataType)).alias(values[k]) for k, m in enumerate(metrics)],
        )
        for i in range(len(metrics))
    ]
    counted = df.select(F.inline(F.array(*entries))).groupBy("metric_", *values).agg(F.count(F.lit(1)).alias("n"))
    placed = positions(counted, [F.col("metric_").asc(), *[F.col(v).desc_nulls_last() for v in values]])
    # each metric holds every row once, so metric i starts at i / metrics of the total
    rank = F.col("before") - F.col("metric_") * F.expr(f"total div {max(len(metrics), 1)}") + 1
    ranked = placed.withColumn("rank_", rank.cast("bigint"))
    out = df
    for i, metric in enumerate(metrics):
        ranks = ranked.where(F.col("metric_") == i).select(
            F.col(values[i]).alias(f"{metric}_v_"), F.col("rank_").alias(f"{metric}_rank")
        )
        out = out.join(ranks, out[metric].eqNullSafe(ranks[f"{metric}_v_"])).drop(f"{metric}_v_")
    return out
