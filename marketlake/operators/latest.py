"""Latest row, last n rows and boundary rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _newest_first(latest: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in latest]


def last_n_per_key(df: DataFrame, keys: Sequence[str], latest: Sequence[str | Column], n: int) -> DataFrame:
    """The ``n`` newest rows per key.

    ``latest`` lists the ordering, newest first; add tie-breakers so that it is
    total.  Spark limits each key to n rows before the shuffle, so a key that
    holds a large share of the table travels as n rows per input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*_newest_first(latest))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], latest: Sequence[str | Column]) -> DataFrame:
    """One row per key: the newest (nulls count as oldest)."""
    return last_n_per_key(df, keys, latest, 1)


def last_n_points(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    limit: int,
    to_ts: Column | None = None,
    ties: Sequence[str] = (),
    block: str = "DAY",
) -> DataFrame:
    """The last ``limit`` points per key up to and including ``to_ts``; null times are the oldest.

    ``ties`` order points of the same time, largest first.  Up to the number of
    rows to which Spark limits a window before its shuffle, that limit serves.
    More are taken by calendar blocks: rows per (key, block), summed from the
    newest block back, show which blocks hold the wanted points and how many of
    them; the other blocks are dropped before the shuffle, and a key is ranked
    block by block, however many rows it has.
    """
    if to_ts is not None:
        df = df.where(F.col(ts) <= to_ts)
    if limit <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return last_n_per_key(df, keys, [ts, *ties], limit)
    free = "_" * (1 + max(len(c) for c in df.columns))  # longer than any column name, so no helper clashes
    own = [f"key_{i}{free}" for i in range(len(keys))]
    block_, rows_, room_, rank_ = (f"{name}{free}" for name in ("block", "rows", "room", "rank"))
    start = F.date_trunc(block, F.col(ts))
    counted = df.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)], start.alias(block_)).agg(
        F.count(F.lit(1)).alias(rows_)
    )
    newer = Window.partitionBy(*own).orderBy(F.col(block_).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(limit) - F.coalesce(F.sum(rows_).over(newer), F.lit(0))
    wanted = counted.withColumn(room_, room).where(F.col(room_) > 0).drop(rows_)
    same = start.eqNullSafe(F.col(block_))
    for key, name in zip(keys, own):
        same &= F.col(key).eqNullSafe(F.col(name))
    in_block = Window.partitionBy(*own, block_).orderBy(*_newest_first([ts, *ties]))
    ranked = df.join(wanted, same).withColumn(rank_, F.row_number().over(in_block))
    return ranked.where(F.col(rank_) <= F.col(room_)).select(*df.columns)


def drop_repeated_boundaries(pages: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Concatenate pages and keep one copy of points shared by neighbours: that of the last page holding it.

    Within a page the largest of the other columns, in column order, settles ties.
    """
    names = pages[0].columns
    place = "_page"
    while place in names:
        place += "_"
    numbered = concat([page.withColumn(place, F.lit(i)) for i, page in enumerate(pages)])
    return latest_per_key(numbered, keys, [place, *[c for c in names if c not in keys]]).select(*names)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
