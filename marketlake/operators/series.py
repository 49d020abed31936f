"""Candles: build from trades, carry, re-aggregate, fill, map, summarise.

A trade frame has the key columns plus ``ts``, ``seq``, ``price``,
``quantity`` and ``side`` (BUY, SELL or anything else for unknown).  A candle
frame has the key columns, ``datetime`` and the fields of :func:`candles`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.functions import interval_unit, period_start
from marketlake.functions.time import NTZ, UNIT_SECONDS
from marketlake.operators.latest import last_n_points, latest_per_key
from marketlake.operators.lookup import lookup

SIDES = ("BUY", "SELL", "UNKNOWN")

# Bars are looked up within a calendar block first, so that neighbour windows
# stay small (at most 1440 minutes, 744 hours or 366 days) however long or
# heavy one instrument is.
BLOCK_UNIT = {"MINUTE": "DAY", "HOUR": "MONTH", "DAY": "YEAR"}

# The column groups a caller can ask for.
COLUMN_GROUPS = {
    "ID": ("market", "instrument", "datetime"),
    "MAPPING": ("mapped_instrument", "base", "quote", "transform_function"),
    "OHLC": ("open", "high", "low", "close"),
    "OHLC_TRADE": (
        "first_trade_timestamp",
        "last_trade_timestamp",
        "high_trade_timestamp",
        "low_trade_timestamp",
        "first_trade_price",
        "high_trade_price",
        "low_trade_price",
        "last_trade_price",
    ),
    "TRADE": ("total_trades", "total_trades_buy", "total_trades_sell", "total_trades_unknown"),
    "VOLUME": (
        "volume",
        "quote_volume",
        "volume_buy",
        "quote_volume_buy",
        "volume_sell",
        "quote_volume_sell",
        "volume_unknown",
        "quote_volume_unknown",
    ),
}


def select_groups(df: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Project column groups; no groups means every column."""
    if not groups:
        return df
    unknown = [g for g in groups if g not in COLUMN_GROUPS]
    if unknown:
        raise ValueError(f"Unknown column groups: {unknown}")
    present = set(df.columns)
    return df.select(*[c for g in groups for c in COLUMN_GROUPS[g] if c in present])


# --- trades ----------------------------------------------------------------


def valid_trades(df: DataFrame) -> DataFrame:
    """Drop trades without a time or with a price or quantity that is not positive."""
    return df.where((F.col("price") > 0) & (F.col("quantity") > 0) & F.col("ts").isNotNull())


def unique_trades(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """One copy per (key, exchange sequence number): the one with the largest other columns, in column order."""
    return latest_per_key(df, [*keys, seq], [c for c in df.columns if c not in (*keys, seq)] or [seq])


def trades_after(df: DataFrame, after_ts: Column, last_seq: Column, limit: int) -> DataFrame:
    """Next page of trades: later seconds, or the same second with a higher sequence."""
    second = F.date_trunc("second", F.col("ts")).cast(NTZ)
    newer = (second > after_ts) | ((second == after_ts) & (F.col("seq") > last_seq))
    # the plain lower bound reaches the file scan, the page condition cannot
    page = df.where((F.col("ts") >= after_ts) & newer)
    return page.orderBy("ts", "seq").limit(limit)


def trades_of_hour(df: DataFrame, hour: Column) -> DataFrame:
    """All trades of the hour that contains the given time."""
    start = period_start(hour, "HOUR")
    return df.where((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 HOUR")))


# --- candles ---------------------------------------------------------------


def _side(value: str) -> Column:
    known = F.upper("side").isin("BUY", "SELL")
    if value == "UNKNOWN":
        return ~F.coalesce(known, F.lit(False))
    return F.coalesce(F.upper("side") == value, F.lit(False))


def trade_measures() -> list[Column]:
    """Partial-friendly aggregates over trades: extremes with their time, sums, counts."""
    quote = F.col("price") * F.col("quantity")
    out = [
        F.min(F.struct("ts", "seq", "price")).alias("first"),
        F.max(F.struct("ts", "seq", "price")).alias("last"),
        F.min(F.struct((-F.col("price")).alias("neg"), "ts", "seq")).alias("high"),
        F.min(F.struct("price", "ts", "seq")).alias("low"),
        F.sum("quantity").alias("volume"),
        F.sum(quote).alias("quote_volume"),
        F.count(F.lit(1)).alias("total_trades"),
    ]
    for side in SIDES:
        hit, tail = _side(side), side.lower()
        out += [
            F.sum(F.when(hit, F.col("quantity")).otherwise(0.0)).alias(f"volume_{tail}"),
            F.sum(F.when(hit, quote).otherwise(0.0)).alias(f"quote_volume_{tail}"),
            F.count_if(hit).alias(f"total_trades_{tail}"),
        ]
    return out


MEASURE_SUMS = [*COLUMN_GROUPS["VOLUME"], *COLUMN_GROUPS["TRADE"]]


def unfold_measures(df: DataFrame, head: Sequence[str | Column]) -> DataFrame:
    """Candle columns from the structs of :func:`trade_measures`."""
    return df.select(
        *head,
        F.col("first.price").alias("open"),
        (-F.col("high.neg")).alias("high"),
        F.col("low.price").alias("low"),
        F.col("last.price").alias("close"),
        F.col("first.ts").alias("first_trade_timestamp"),
        F.col("last.ts").alias("last_trade_timestamp"),
        F.col("high.ts").alias("high_trade_timestamp"),
        F.col("low.ts").alias("low_trade_timestamp"),
        F.col("first.price").alias("first_trade_price"),
        (-F.col("high.neg")).alias("high_trade_price"),
        F.col("low.price").alias("low_trade_price"),
        F.col("last.price").alias("last_trade_price"),
        *MEASURE_SUMS,
    )


def candles(trades: DataFrame, keys: Sequence[str], interval: str, carry: bool = True) -> DataFrame:
    """1d, 1h or 1m candles per key from trades.

    One partial aggregation; at most one row per key and period leaves each
    input partition.  With ``carry`` the open is the close of the previous
    active bar and the high and low include it.
    """
    unit = interval_unit(interval)
    bars = trades.groupBy(*keys, period_start("ts", unit).alias("datetime")).agg(*trade_measures())
    out = unfold_measures(bars, [*keys, "datetime"])
    return carry_open(out, keys, interval) if carry else out


def neighbour(
    df: DataFrame, keys: Sequence[str], interval: str, value: str, name: str, step: int = -1, ts: str = "datetime"
) -> DataFrame:
    """Add ``value`` of the previous (``step=-1``) or next (``step=1``) bar of the key.

    Windows run inside (key, calendar block).  Only the outermost bar of a
    block has its neighbour in another block; these bars, one per key and
    block, get it from a window over the blocks of the key.  Both branches read
    the same shuffled bars.
    """
    if step not in (-1, 1):
        raise ValueError("step must be -1 or 1")
    block = period_start(ts, BLOCK_UNIT[interval_unit(interval)])
    inner = Window.partitionBy(*keys, "block_").orderBy(ts)
    whole = inner.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    outer = Window.partitionBy(*keys).orderBy("block_")
    shift, far = (F.lag, F.last) if step < 0 else (F.lead, F.first)
    near = df.withColumn("block_", block).withColumns(
        {"near_": shift(F.struct(value)).over(inner), "edge_": far(value).over(whole)}
    )
    inside = near.where("near_ is not null").select(*df.columns, F.col(f"near_.{value}").alias(name))
    border = near.where("near_ is null").select(*df.columns, shift("edge_").over(outer).alias(name))
    return inside.unionByName(border)


def carry_open(df: DataFrame, keys: Sequence[str], interval: str) -> DataFrame:
    """Open at the previous close; high and low include the carried open."""
    chained = neighbour(df, keys, interval, "close", "previous_close_")
    opening = F.coalesce("previous_close_", "open")
    return chained.withColumns(
        {
            "open": opening,
            "high": F.greatest("high", opening),
            "low": F.least("low", opening),
        }
    ).select(*df.columns)


def reaggregate(
    df: DataFrame,
    keys: Sequence[str],
    interval: str,
    n: int,
    to_ts: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Merge ``n`` periods into one bar, aligned to the epoch.

    The bucket that contains ``to_ts`` is returned whole; ``limit`` counts
    source periods, so at most ``limit / n`` merged bars per key come back.
    """
    if n < 1:
        raise ValueError("n must be positive")
    width = n * UNIT_SECONDS[interval_unit(interval)]

    def bucket(ts: Column) -> Column:
        seconds = F.unix_seconds(ts.cast("timestamp"))
        return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(width))).cast(NTZ)

    if to_ts is not None:
        end = bucket(to_ts) + F.make_dt_interval(secs=F.lit(width))
        df = df.where(F.col("datetime") < end)
    sums = [F.sum(c).alias(c) for c in MEASURE_SUMS if c in df.columns]
    merged = df.groupBy(*keys, bucket(F.col("datetime")).alias("bucket_")).agg(
        F.min_by("open", "datetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "datetime").alias("close"),
        *sums,
    )
    merged = merged.withColumnRenamed("bucket_", "datetime")
    if limit is not None:
        merged = last_n_points(merged, keys, "datetime", max(limit // n, 1))
    return merged


def fill_gaps(df: DataFrame, keys: Sequence[str], interval: str, until: Column | None = None) -> DataFrame:
    """Add a flat bar for every inactive period between the bars of a key.

    Each bar emits itself and its own fillers up to the next bar, so neither a
    calendar nor a join is needed.  Filled prices are the last close, volumes
    and counts are 0 and trade times are null.  ``until`` extends the fill after
    the last bar, up to and including that period.
    """
    unit = interval_unit(interval)
    step = F.expr(f"INTERVAL 1 {unit}")
    outer_unit = BLOCK_UNIT[unit]
    outer_step = F.expr(f"INTERVAL 1 {outer_unit}")
    bar = F.col("datetime")
    stop = F.col("next_") - step
    if until is not None:
        stop = F.coalesce(stop, F.greatest(period_start(until, unit), bar))
    spans = neighbour(df, keys, interval, "datetime", "next_", step=1).withColumn("to_", F.coalesce(stop, bar))
    # block by block, so that no row holds more than one block of periods
    blocks = F.sequence(period_start("datetime", outer_unit), period_start("to_", outer_unit), outer_step)
    spans = spans.withColumn("block_", F.explode(blocks))
    first, last = F.greatest("datetime", "block_"), F.least("to_", F.col("block_") + outer_step - step)
    spans = spans.withColumn("at_", F.explode(F.sequence(first, last, step)))

    types = dict(df.dtypes)
    own = F.col("at_") == bar

    def value(name: str) -> Column:
        if name == "datetime":
            return F.col("at_").alias(name)
        if name in keys or name == "close" or name in COLUMN_GROUPS["MAPPING"]:
            return F.col(name)
        if name in COLUMN_GROUPS["OHLC"]:
            flat = F.col("close")
        elif name in MEASURE_SUMS:
            flat = F.lit(0).cast(types[name])
        else:
            flat = F.lit(None).cast(types[name])
        return F.when(own, F.col(name)).otherwise(flat).alias(name)

    return spans.select(*[value(c) for c in df.columns])


def without_inactive(df: DataFrame) -> DataFrame:
    """Drop periods without trading activity."""
    return df.where(F.col("total_trades") > 0)


def apply_mapping(df: DataFrame, mapping: DataFrame, keys: Sequence[str] = ("market", "instrument")) -> DataFrame:
    """Rename instruments to their mapped symbol and invert reversed pairs.

    ``mapping`` has the keys, ``mapped_instrument`` and ``inverted``.  Instruments
    without a mapping keep their name.  Inversion turns prices into 1/price and
    swaps high with low and volume with quote volume.
    """
    base = df.drop("mapped_instrument")
    joined = lookup(base, mapping.select(*keys, "mapped_instrument", "inverted"), keys)
    flip = F.coalesce("inverted", F.lit(False))
    swap = {"high": "low", "low": "high"}
    prices = [c for c in df.columns if c in COLUMN_GROUPS["OHLC"] or c.endswith("_trade_price")]
    for c in df.columns:
        if c.startswith(("high_trade_", "low_trade_")):
            head, tail = c.split("_", 1)
            swap[c] = f"{swap[head]}_{tail}"
        elif c.startswith("quote_volume"):
            swap[c] = c.removeprefix("quote_")
        elif c.startswith("volume"):
            swap[c] = f"quote_{c}"

    def value(c: str) -> Column:
        source = F.col(swap.get(c, c))
        flipped = F.try_divide(F.lit(1.0), source) if c in prices else source
        if c in prices or c in swap:
            return F.when(flip, flipped).otherwise(F.col(c)).alias(c)
        return F.col(c)

    mapped = F.coalesce("mapped_instrument", "instrument").alias("mapped_instrument")
    return joined.select(*[value(c) for c in base.columns], mapped)


# --- latest tick -----------------------------------------------------------

# Period-to-date and moving windows of a tick.
CURRENT_WINDOWS = ("HOUR", "DAY", "WEEK", "MONTH", "YEAR")
MOVING_WINDOWS = {
    "MOVING_24_HOUR": "24 HOUR",
    "MOVING_7_DAY": "7 DAY",
    "MOVING_30_DAY": "30 DAY",
    "MOVING_90_DAY": "90 DAY",
    "MOVING_180_DAY": "180 DAY",
    "MOVING_365_DAY": "365 DAY",
}


def latest_tick(trades: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """Last trade per key with every window's open, high, low, volumes, counts and change.

    All windows end at ``as_of``, so they are nested: a trade belongs to each
    window whose start it has passed.  Trades are aggregated once per (key,
    set of passed starts), which is at most 13 rows per key; the windows
    are then merged from those rows.
    """
    as_of = as_of.cast(NTZ)
    passed: dict[str, Column] = {}
    for unit in CURRENT_WINDOWS:
        passed[f"CURRENT_{unit}"] = F.col("ts") >= period_start(as_of, unit)
    for name, width in MOVING_WINDOWS.items():
        passed[name] = F.col("ts") > as_of - F.expr(f"INTERVAL {width}")
    passed["LIFETIME"] = F.lit(True)

    mask = F.lit(0)
    for i, condition in enumerate(passed.values()):
        mask = mask + F.when(condition, F.lit(1 << i)).otherwise(F.lit(0))
    parts = trades.where(F.col("ts") <= as_of).groupBy(*keys, mask.alias("mask_")).agg(*trade_measures())

    member = [F.when(F.col("mask_").bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(passed)]
    merged = parts.withColumn("window_", F.explode(F.array_compact(F.array(*member)))).groupBy(*keys, "window_").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min("high").alias("high"),
        F.min("low").alias("low"),
        *[F.sum(c).alias(c) for c in MEASURE_SUMS],
    )
    body = F.struct("first", "last", "high", "low", *MEASURE_SUMS)
    wide = merged.groupBy(*keys).agg(*[F.max(F.when(F.col("window_") == n, body)).alias(n) for n in passed])
    price = "LIFETIME.last.price"
    out = ["LIFETIME.last.ts AS last_trade_timestamp", f"{price} AS price"]
    for name in passed:
        prefix, opening = name.lower(), f"{name}.first.price"
        out += [
            f"{opening} AS {prefix}_open",
            f"-{name}.high.neg AS {prefix}_high",
            f"{name}.low.price AS {prefix}_low",
            f"{price} - {opening} AS {prefix}_change",
            f"try_divide(100D * ({price} - {opening}), {opening}) AS {prefix}_change_percentage",
            *[f"coalesce({name}.{c}, 0) AS {prefix}_{c}" for c in MEASURE_SUMS],
        ]
    return wide.selectExpr(*keys, *out)


def price_matrix(prices: DataFrame, base: str, quote: str, quotes: Sequence[str]) -> DataFrame:
    """Latest price per base, one column per quote (null when never quoted)."""
    return prices.groupBy(base).pivot(quote, list(quotes)).agg(F.max_by("price", F.struct("ts", "seq")))
