"""Chunked transfer of a stored series with reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketlake.operators import checks, maintain
from marketlake.operators.fetchplan import assign_chunks
from marketlake.plans.store import Store
from marketlake.schemas import TABLES

SERIES_ORDER = ("datetime", "market", "mapped_instrument")


def export_series(
    df: DataFrame,
    path: str,
    chunk_days: int = 30,
    order: Sequence[str] = SERIES_ORDER,
    lo: Column | None = None,
    hi: Column | None = None,
) -> None:
    """Write the series as chunk folders ``chunk=<first day>_to_<end day>``.

    Timestamps leave as ISO text, zero dates as null.
    """
    ts = order[0]
    chunked = assign_chunks(df, chunk_days, ts, lo, hi)
    name = F.concat(
        F.date_format("chunk_start", "yyyyMMdd"), F.lit("_to_"), F.date_format("chunk_end", "yyyyMMdd")
    )
    times = [c for c, t in df.dtypes if t.startswith("timestamp")]
    rows = chunked.select(*df.columns, name.alias("chunk"))
    text = maintain.timestamps_to_text(rows, times)
    sort = [f"{c}_str" if c in times else c for c in order]
    maintain.export_chunks(text, path, sort, "chunk")


def import_series(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Exported chunks in table form and declared column order."""
    return maintain.import_chunks(spark, path, "chunk", columns).select(*columns)


def transfer_report(
    source: DataFrame,
    target: DataFrame,
    chunk_days: int = 30,
    ts: str = "datetime",
    lo: Column | None = None,
    hi: Column | None = None,
) -> DataFrame:
    """Rows per chunk on both sides with the running total of transferred rows.

    Both sides are chunked by the bounds of the source, so a partial range is
    compared with the same range.
    """
    if lo is None or hi is None:
        bounds = source.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi")).alias("b")).scalar()
        lo, hi = bounds["lo"], bounds["hi"]
    chunk = ["chunk", "chunk_start", "chunk_end"]
    report = checks.reconcile(
        assign_chunks(source.select(ts), chunk_days, ts, lo, hi),
        assign_chunks(target.select(ts), chunk_days, ts, lo, hi),
        chunk,
    )
    # one row per chunk of the calendar range
    so_far = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return report.withColumn("running_rows", F.sum("target_rows").over(so_far))


def transfer(
    spark: SparkSession,
    source: DataFrame,
    export_path: str,
    target_path: str,
    chunk_days: int = 30,
    order: Sequence[str] = SERIES_ORDER,
    lo: Column | None = None,
    hi: Column | None = None,
    partition_unit: str = "DAY",
) -> DataFrame:
    """Export, load into a new table partitioned by ``date`` and return the reconciliation.

    ``partition_unit`` sets how much time one ``date`` folder holds.
    """
    export_series(source, export_path, chunk_days, order, lo, hi)
    loaded = import_series(spark, export_path, source.columns)
    dated = loaded.withColumn("date", F.to_date(F.date_trunc(partition_unit, F.col(order[0]))))
    maintain.append(dated, target_path, ["date"])
    target = maintain.read_table(spark, target_path).select(*source.columns)
    return transfer_report(source, target, chunk_days, order[0], lo, hi)


def transfer_stored(
    spark: SparkSession,
    store: Store,
    table: str,
    export_path: str,
    target_path: str,
    start: Column,
    end: Column,
    chunk_days: int = 30,
) -> DataFrame:
    """:func:`transfer` of the part of a stored series from ``start`` to ``end`` (inclusive).

    Only the folders of that range are opened, for the export and for the report.
    """
    spec = TABLES[table]
    source = store.read(spark, table, start, end)
    order = [spec.partition_source, *[k for k in spec.key if k != spec.partition_source]]
    return transfer(spark, source, export_path, target_path, chunk_days, order, start, end, spec.partition_unit)
