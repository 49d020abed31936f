"""Row counts, key uniqueness, required columns and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def series_bounds(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """First and last timestamp and row count of a series (one row)."""
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"), F.count(F.lit(1)).alias("rows"))


def newest_record(df: DataFrame, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest record of a batch (one row; none for a batch without records), ties to the largest ``ties``.

    Records without a time count as oldest.  An aggregate: each task sends one row.
    """
    newest = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(F.col(ts), *[F.col(c) for c in ties]))
    return df.agg(newest.alias("newest")).where("newest is not null").select("newest.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per required column as (column_name, nulls), in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "nulls")


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, minimum and maximum (as text) per column, in one pass."""
    entry = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entry).alias("p")).select(F.inline("p"))


def reconcile(source: DataFrame, target: DataFrame, chunk: Sequence[str]) -> DataFrame:
    """Rows per chunk on both sides and how many are missing in the target."""
    left = source.groupBy(*chunk).agg(F.count(F.lit(1)).alias("source_rows"))
    right = target.groupBy(*chunk).agg(F.count(F.lit(1)).alias("target_rows"))
    source_rows = F.coalesce("source_rows", F.lit(0))
    target_rows = F.coalesce("target_rows", F.lit(0))
    return left.join(right, list(chunk), "full").select(
        *chunk,
        source_rows.alias("source_rows"),
        target_rows.alias("target_rows"),
        (source_rows - target_rows).alias("missing_rows"),
        (source_rows == target_rows).alias("matches"),
    )


def reconcile_totals(source: DataFrame, target: DataFrame) -> DataFrame:
    """Whole-table counts on both sides (one row)."""
    counted = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    totals = counted.agg(F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows"))
    return totals.select(
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        (F.coalesce("source_rows", F.lit(0)) - F.coalesce("target_rows", F.lit(0))).alias("missing_rows"),
    )


def status_counts(df: DataFrame, keys: Sequence[str], status: str, statuses: Sequence[str]) -> DataFrame:
    """One count column per status, e.g. instruments per exchange."""

    def counter(value: str) -> Column:
        return F.count_if(F.col(status) == value).alias(f"{value.lower()}_count")

    return df.groupBy(*keys).agg(*[counter(s) for s in statuses], F.count(F.lit(1)).alias("total_count"))


def match_counts(df: DataFrame, value: str) -> DataFrame:
    """How many rows carry a value and how many do not."""
    return df.agg(
        F.count_if(F.col(value).isNotNull()).alias("mapped"),
        F.count_if(F.col(value).isNull()).alias("unmatched"),
    )


def running_totals(df: DataFrame, chunk: Sequence[str], chunk_no: str) -> DataFrame:
    """Rows per chunk with the running total.

    The running sum is over one row per chunk; chunks are date ranges, so their
    number is bounded by the calendar and not by the data.
    """
    counts = df.groupBy(chunk_no, *chunk).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy(chunk_no).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("running_rows", F.sum("rows").over(w))
