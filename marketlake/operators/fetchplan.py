"""What to fetch next: high-water marks, incremental plans, date chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlake.functions import (
    add_periods,
    end_of_previous_period,
    periods_between,
    ts_to_epoch,
)
from marketlake.functions.time import NTZ
from marketlake.operators.lookup import lookup

# Most points per request by interval.
MAX_POINTS = {"1d": 5000, "1h": 2000, "1m": 2000}
# Days of history requested for a series without stored rows.
SPOT_BACKFILL_DAYS = 5000
INDEX_BACKFILL_DAYS = 730


def high_water(stored: DataFrame, keys: Sequence[str], ts: str = "datetime", name: str = "high_water") -> DataFrame:
    """Newest stored timestamp per key."""
    return stored.groupBy(*keys).agg(F.max(ts).alias(name))


def with_high_water(
    wanted: DataFrame, stored: DataFrame, keys: Sequence[str], ts: str = "datetime", name: str = "high_water"
) -> DataFrame:
    """Add the newest stored timestamp to each wanted key (null when unseen)."""
    return lookup(wanted, high_water(stored, keys, ts, name), keys)


def newer_than_stored(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str], ts: str = "datetime"
) -> DataFrame:
    """Incoming rows after their key's high-water mark, or of an unseen key."""
    marked = with_high_water(incoming, stored, keys, ts, "high_water_")
    fresh = F.col("high_water_").isNull() | (F.col(ts) > F.col("high_water_"))
    return marked.where(fresh).select(*incoming.columns)


def fetch_plan(
    instruments: DataFrame,
    stored: DataFrame,
    interval: str,
    now: Column,
    keys: Sequence[str] = ("market", "mapped_instrument"),
    max_points: int | None = None,
) -> DataFrame:
    """Requests that bring each instrument up to date.

    ``instruments`` has the keys, ``first_update``, ``last_update`` and
    ``status``; ``stored`` the keys and ``datetime``.  Gives one row per
    request: (keys, batch, batch_start, batch_end, to_ts, points).

    Start: one period after the high-water mark, else the first update, else
    midnight ``max_points`` days ago.  End: the end of the previous period for
    active instruments, else the last update (the former when unknown).
    """
    points = max_points or MAX_POINTS[interval]
    now = now.cast(NTZ)
    previous = end_of_previous_period(now, interval)
    floor = F.date_trunc("day", now - F.make_dt_interval(days=F.lit(points))).cast(NTZ)
    marked = with_high_water(instruments, stored, keys)
    ending = F.when(F.col("status") == "ACTIVE", previous).otherwise(F.coalesce("last_update", previous))
    planned = marked.select(
        *keys,
        F.coalesce(add_periods("high_water", 1, interval), "first_update", floor).alias("start_"),
        ending.alias("end_"),
    ).withColumn("span_", periods_between("start_", "end_", interval))
    batches = planned.where("span_ >= 0").withColumn(
        "batch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("span_") / points)))
    )
    start = add_periods("start_", F.col("batch") * points, interval)
    size = F.least(F.col("span_") - F.col("batch") * points + 1, F.lit(points).cast("bigint"))
    batches = batches.withColumns({"batch_start": start, "points": size})
    # a later request is made only while its start lies before the end and now
    due = (F.col("batch") == 0) | ((F.col("batch_start") <= F.col("end_")) & (F.col("batch_start") <= now))
    last = add_periods("batch_start", F.col("points") - 1, interval)
    batch_end = F.least(last, F.date_trunc("second", F.col("end_")).cast(NTZ))
    return (
        batches.where(due)
        .withColumn("batch_end", batch_end)
        .select(*keys, "batch", "batch_start", "batch_end", ts_to_epoch("batch_end").alias("to_ts"), "points")
    )


def daily_plan(
    wanted: DataFrame, stored: DataFrame, now: Column, keys: Sequence[str], backfill_days: int = SPOT_BACKFILL_DAYS
) -> DataFrame:
    """One daily request per key that is not up to date: (keys, start, to_ts, points).

    A series that ends yesterday asks for that bar again; one without rows asks
    for ``backfill_days - 1`` points.
    """
    now = now.cast(NTZ)
    today = F.to_date(now)
    yesterday = F.date_sub(today, 1)
    marked = with_high_water(wanted.select(*keys).distinct(), stored, keys)
    last = F.to_date("high_water")
    next_day = add_periods("high_water", 1, "1d")
    start = (
        F.when(F.col("high_water").isNull(), now - F.make_dt_interval(days=F.lit(backfill_days)))
        .when(last == yesterday, F.col("high_water"))
        .otherwise(next_day)
    )
    size = (
        F.when(F.col("high_water").isNull(), F.lit(backfill_days - 1))
        .when(last == yesterday, F.lit(1))
        .otherwise(F.date_diff(yesterday, F.to_date(next_day)) + 1)
    )
    end = F.date_trunc("day", now).cast(NTZ) - F.expr("INTERVAL 1 MICROSECOND")
    return marked.where(F.col("high_water").isNull() | (last < today)).select(
        *keys, start.alias("start"), ts_to_epoch(end).alias("to_ts"), size.cast("bigint").alias("points")
    )


# --- date chunks -----------------------------------------------------------


def _bounds(df: DataFrame, ts: str) -> Column:
    return df.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi")).alias("b")).scalar()


def _chunk_number(ts: Column, lo: Column, days: int) -> Column:
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(lo.cast("timestamp"))
    return F.floor(micros / F.lit(days * 86_400_000_000)).cast("bigint")


def _chunk_range(chunk: Column, lo: Column, hi: Column, days: int) -> tuple[Column, Column]:
    start = F.timestamp_add("DAY", (chunk * days).cast("int"), lo)
    stop = F.timestamp_add("DAY", ((chunk + 1) * days).cast("int"), lo)
    # the last chunk reaches one second past the newest row, so that it is included
    return start, F.when(stop > hi, hi + F.expr("INTERVAL 1 SECOND")).otherwise(stop)


def date_chunks(
    df: DataFrame, days: int, ts: str = "datetime", lo: Column | None = None, hi: Column | None = None
) -> DataFrame:
    """Consecutive chunks of ``days`` days that cover the series.

    Bounds are taken from the series unless given.  One row per chunk:
    (chunk, chunk_start, chunk_end), end exclusive.
    """
    if lo is None or hi is None:
        bounds = _bounds(df, ts)
        lo, hi = bounds["lo"], bounds["hi"]
    one = df.sparkSession.range(1).select(lo.cast(NTZ).alias("lo"), hi.cast(NTZ).alias("hi"))
    numbered = one.where("lo is not null").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), _chunk_number(F.col("hi"), F.col("lo"), days)))
    )
    start, stop = _chunk_range(F.col("chunk"), F.col("lo"), F.col("hi"), days)
    return numbered.select("chunk", start.alias("chunk_start"), stop.alias("chunk_end"))


def assign_chunks(
    df: DataFrame, days: int, ts: str = "datetime", lo: Column | None = None, hi: Column | None = None
) -> DataFrame:
    """Add (chunk, chunk_start, chunk_end) to each row of the range by arithmetic, without a join."""
    if lo is None or hi is None:
        bounds = _bounds(df, ts)
        lo, hi = bounds["lo"], bounds["hi"]
    else:
        lo, hi = lo.cast(NTZ), hi.cast(NTZ)
        df = df.where((F.col(ts) >= lo) & (F.col(ts) < hi + F.expr("INTERVAL 1 SECOND")))
    chunk = F.least(_chunk_number(F.col(ts), lo, days), _chunk_number(hi, lo, days))
    numbered = df.withColumn("chunk", chunk)
    start, stop = _chunk_range(F.col("chunk"), lo, hi, days)
    return numbered.withColumns({"chunk_start": start, "chunk_end": stop})


def chunk_counts(df: DataFrame, days: int, ts: str = "datetime") -> DataFrame:
    """Every chunk with its row count, empty chunks included."""
    counts = assign_chunks(df.select(ts), days, ts).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
    return date_chunks(df, days, ts).join(counts, "chunk", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


__all__ = [
    "assign_chunks",
    "chunk_counts",
    "daily_plan",
    "date_chunks",
    "fetch_plan",
    "high_water",
    "newer_than_stored",
    "with_high_water",
]
