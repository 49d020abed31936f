"""Candles, re-aggregation, gap fill, mapping, ticks, trade pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake.operators import series
from marketlake.operators.latest import last_n_points
from marketlake.registry.base import KEYS, TRADES_SQL, Tables, register, rounded, trades

SIDE_SQL = {"buy": "side = 'BUY'", "sell": "side = 'SELL'", "unknown": "side NOT IN ('BUY', 'SELL')"}


def _sums(prefix: str = "", where: str = "true", digits: int | None = None) -> list[str]:
    """Volume and count columns over the trades that satisfy ``where``."""

    def total(value: str, condition: str) -> str:
        sql = f"coalesce(sum({value}) FILTER ({condition}), 0.0)"
        return sql if digits is None else f"round({sql}, {digits})"

    out = []
    for tail, side in {"": "true", **{f"_{s}": c for s, c in SIDE_SQL.items()}}.items():
        condition = f"{side} AND {where}"
        out += [
            f"{total('quantity', condition)} AS {prefix}volume{tail}",
            f"{total('price * quantity', condition)} AS {prefix}quote_volume{tail}",
            f"CAST(count(*) FILTER ({condition}) AS BIGINT) AS {prefix}total_trades{tail}",
        ]
    return out


def candles_cte(unit: str) -> str:
    """Common table expressions up to ``bars`` (first trade open) and ``candles`` (carried open)."""
    return f"""{TRADES_SQL},
bars AS (
  SELECT market, instrument, date_trunc('{unit}', ts) AS datetime,
    first(price ORDER BY ts, seq) AS open, max(price) AS high, min(price) AS low,
    last(price ORDER BY ts, seq) AS close,
    first(ts ORDER BY ts, seq) AS first_trade_timestamp, last(ts ORDER BY ts, seq) AS last_trade_timestamp,
    first(ts ORDER BY price DESC, ts, seq) AS high_trade_timestamp,
    first(ts ORDER BY price, ts, seq) AS low_trade_timestamp,
    first(price ORDER BY ts, seq) AS first_trade_price, max(price) AS high_trade_price,
    min(price) AS low_trade_price, last(price ORDER BY ts, seq) AS last_trade_price, {', '.join(_sums())}
  FROM trades GROUP BY ALL),
carried AS (SELECT *, lag(close) OVER (PARTITION BY market, instrument ORDER BY datetime) AS pc FROM bars),
candles AS (
  SELECT * EXCLUDE (pc) REPLACE (coalesce(pc, open) AS open, greatest(high, coalesce(pc, open)) AS high,
                                 least(low, coalesce(pc, open)) AS low) FROM carried)
"""


def rounded_sql(relation: str) -> str:
    """Select everything with the summed columns rounded like :func:`rounded`."""
    volumes = series.COLUMN_GROUPS["VOLUME"]
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in volumes)}) FROM {relation}"


for _interval, _unit in {"1m": "minute", "1h": "hour", "1d": "day"}.items():

    @register(f"candles_{_interval}", f"WITH {candles_cte(_unit)} {rounded_sql('candles')}")
    def _candles(t: Tables, interval: str = _interval) -> DataFrame:
        return rounded(series.candles(trades(t), KEYS, interval))


@register("candles_uncarried", f"WITH {candles_cte('hour')} {rounded_sql('bars')}")
def _uncarried(t: Tables) -> DataFrame:
    return rounded(series.candles(trades(t), KEYS, "1h", carry=False))


_SUMMED = ", ".join(
    f"round(sum({c}), 4) AS {c}" if "volume" in c else f"CAST(sum({c}) AS BIGINT) AS {c}" for c in series.MEASURE_SUMS
)
_BUCKET = "CAST(to_timestamp(CAST(epoch(datetime) AS BIGINT) - CAST(epoch(datetime) AS BIGINT) % 14400) AT TIME ZONE 'UTC' AS TIMESTAMP)"
_MERGED = f"""merged AS (
  SELECT market, instrument, {_BUCKET} AS bucket, first(open ORDER BY datetime) AS open, max(high) AS high,
         min(low) AS low, last(close ORDER BY datetime) AS close, {_SUMMED}
  FROM candles GROUP BY ALL)"""


@register("candles_n", f"WITH {candles_cte('hour')}, {_MERGED} SELECT * RENAME (bucket AS datetime) FROM merged")
def _candles_n(t: Tables) -> DataFrame:
    return rounded(series.reaggregate(series.candles(trades(t), KEYS, "1h"), KEYS, "1h", 4))


@register(
    "candles_n_last",
    f"""WITH {candles_cte('hour')}, {_MERGED}
    SELECT * EXCLUDE (rn) RENAME (bucket AS datetime) FROM (
      SELECT *, row_number() OVER (PARTITION BY market, instrument ORDER BY bucket DESC) AS rn FROM merged
      WHERE bucket < TIMESTAMP '2024-01-20 16:00:00') WHERE rn <= 10""",
)
def _candles_n_last(t: Tables) -> DataFrame:
    bars = series.candles(trades(t), KEYS, "1h")
    to_ts = F.lit("2024-01-20 13:30:00").cast("timestamp_ntz")
    return rounded(series.reaggregate(bars, KEYS, "1h", 4, to_ts, limit=40))


def _filled_sql(unit: str, until: str | None = None) -> str:
    end = f"date_trunc('{unit}', TIMESTAMP '{until}')" if until else "max(datetime)"
    if until:
        end = f"greatest(max(datetime), {end})"
    zeros = ", ".join(f"coalesce({c}, 0) AS {c}" for c in series.MEASURE_SUMS)
    return f"""WITH {candles_cte(unit)},
spans AS (SELECT market, instrument, min(datetime) AS lo, {end} AS hi FROM candles GROUP BY ALL),
spine AS (SELECT market, instrument, unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS datetime FROM spans),
joined AS (
  SELECT s.market, s.instrument, s.datetime, c.* EXCLUDE (market, instrument, datetime),
    last_value(c.close IGNORE NULLS) OVER (PARTITION BY s.market, s.instrument ORDER BY s.datetime) AS prev
  FROM spine s LEFT JOIN candles c USING (market, instrument, datetime)),
filled AS (
  SELECT * EXCLUDE (prev) REPLACE (coalesce(open, prev) AS open, coalesce(high, prev) AS high,
    coalesce(low, prev) AS low, coalesce(close, prev) AS close, {zeros}) FROM joined)
{rounded_sql('filled')}"""


@register("candles_filled", _filled_sql("hour"))
def _filled(t: Tables) -> DataFrame:
    return rounded(series.fill_gaps(series.candles(trades(t), KEYS, "1h"), KEYS, "1h"))


@register(
    "candles_filled_1m",
    f"""SELECT market, instrument, CAST(datetime AS DATE) AS day, CAST(count(*) AS BIGINT) AS bars,
        CAST(count(*) FILTER (total_trades = 0) AS BIGINT) AS filled, round(sum(close), 2) AS close_sum,
        CAST(sum(total_trades) AS BIGINT) AS total_trades FROM ({_filled_sql('minute')}) GROUP BY ALL""",
)
def _filled_1m(t: Tables) -> DataFrame:
    """Every minute of every series, summed up per day."""
    filled = series.fill_gaps(series.candles(trades(t), KEYS, "1m"), KEYS, "1m")
    return filled.groupBy(*KEYS, F.to_date("datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_if(F.col("total_trades") == 0).alias("filled"),
        F.round(F.sum("close"), 2).alias("close_sum"),
        F.sum("total_trades").alias("total_trades"),
    )


@register("candles_filled_until", _filled_sql("day", "2024-02-10 05:00:00"))
def _filled_until(t: Tables) -> DataFrame:
    until = F.lit("2024-02-10 05:00:00").cast("timestamp_ntz")
    return rounded(series.fill_gaps(series.candles(trades(t), KEYS, "1d"), KEYS, "1d", until))


@register("candles_active", f"WITH {candles_cte('hour')} {rounded_sql('candles')}")
def _active(t: Tables) -> DataFrame:
    filled = series.fill_gaps(series.candles(trades(t), KEYS, "1h"), KEYS, "1h")
    return rounded(series.without_inactive(filled))


_PRICES = ["open", "close", "first_trade_price", "last_trade_price"]
_SWAPPED = ["high", "low", "high_trade_price", "low_trade_price"]


def _mapped_sql() -> str:
    def other(c: str) -> str:
        return c.replace("high", "#").replace("low", "high").replace("#", "low") if c in (*_SWAPPED, *_TIMES) else c

    flip = "instrument IN ('click', 'view')"
    items = [f"round(CASE WHEN {flip} THEN 1.0 / {c} ELSE {c} END, 6) AS {c}" for c in _PRICES]
    items += [f"round(CASE WHEN {flip} THEN 1.0 / {other(c)} ELSE {c} END, 6) AS {c}" for c in _SWAPPED]
    items += [f"CASE WHEN {flip} THEN {other(c)} ELSE {c} END AS {c}" for c in _TIMES]
    for c in series.COLUMN_GROUPS["VOLUME"]:
        swap = c.removeprefix("quote_") if c.startswith("quote_") else f"quote_{c}"
        items.append(f"round(CASE WHEN {flip} THEN {swap} ELSE {c} END, 4) AS {c}")
    return f"""WITH {candles_cte('day')}
SELECT * REPLACE ({', '.join(items)}),
  CASE WHEN instrument IN ('click', 'view') THEN 'USD-' || instrument WHEN instrument = 'error' THEN instrument
       ELSE instrument || '-USD' END AS mapped_instrument
FROM candles"""


_TIMES = ["high_trade_timestamp", "low_trade_timestamp"]


@register("mapped_inverted", _mapped_sql())
def _mapped(t: Tables) -> DataFrame:
    frame = trades(t)
    name, flip = F.col("instrument"), F.col("instrument").isin("click", "view")
    mapping = frame.where("instrument <> 'error'").select(*KEYS).distinct().select(
        *KEYS,
        F.when(flip, F.concat(F.lit("USD-"), name)).otherwise(F.concat(name, F.lit("-USD"))).alias("mapped_instrument"),
        flip.alias("inverted"),
    )
    out = series.apply_mapping(series.candles(frame, KEYS, "1d"), mapping)
    prices = [*_PRICES, *_SWAPPED]
    return rounded(out.withColumns({c: F.round(c, 6) for c in prices}), skip=prices)


def _tick_sql() -> str:
    windows = {f"current_{u.lower()}": f"ts >= date_trunc('{u.lower()}', as_of)" for u in series.CURRENT_WINDOWS}
    windows |= {n.lower(): f"ts > as_of - INTERVAL {w}" for n, w in series.MOVING_WINDOWS.items()}
    windows["lifetime"] = "true"
    inner, outer = [], []
    for name, condition in windows.items():
        inner += [
            f"first(price ORDER BY ts, seq) FILTER ({condition}) AS {name}_open",
            f"max(price) FILTER ({condition}) AS {name}_high",
            f"min(price) FILTER ({condition}) AS {name}_low",
        ]
        inner += _sums(f"{name}_", condition, 4)
        outer += [
            f"round(price - {name}_open, 4) AS {name}_change",
            f"round(100.0 * (price - {name}_open) / {name}_open, 4) AS {name}_change_percentage",
        ]
    return f"""WITH {TRADES_SQL},
t AS (SELECT *, (SELECT max(ts) FROM trades) AS as_of FROM trades),
a AS (SELECT market, instrument, max(ts) AS last_trade_timestamp, last(price ORDER BY ts, seq) AS price, {', '.join(inner)}
      FROM t GROUP BY market, instrument)
SELECT *, {', '.join(outer)} FROM a"""


@register("latest_tick", _tick_sql())
def _tick(t: Tables) -> DataFrame:
    frame = trades(t)
    as_of = frame.agg(F.max("ts")).scalar()
    return rounded(series.latest_tick(frame, KEYS, as_of))


@register(
    "price_matrix",
    """SELECT event_type, """
    + ", ".join(
        f"arg_max(value, ts) FILTER (user_id % 5 = {i}) AS m{i}" for i in range(5)
    )
    + ", CAST(NULL AS DOUBLE) AS m9 FROM events GROUP BY 1",
)
def _matrix(t: Tables) -> DataFrame:
    frame = trades(t).withColumnRenamed("instrument", "event_type")
    return series.price_matrix(frame, "event_type", "market", ["m0", "m1", "m2", "m3", "m4", "m9"])


@register(
    "trades_page",
    f"""WITH {TRADES_SQL}
    SELECT * FROM trades WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-10'
       OR (date_trunc('second', ts) = TIMESTAMP '2024-01-10' AND seq > 3000) ORDER BY ts, seq LIMIT 500""",
)
def _page(t: Tables) -> DataFrame:
    return series.trades_after(trades(t), F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(3000), 500)


@register(
    "trades_hour",
    f"WITH {TRADES_SQL} SELECT * FROM trades WHERE date_trunc('hour', ts) = TIMESTAMP '2024-01-12 08:00:00'",
)
def _hour(t: Tables) -> DataFrame:
    return series.trades_of_hour(trades(t), F.lit("2024-01-12 08:20:00").cast("timestamp_ntz"))


@register(
    "trades_valid",
    f"""WITH {TRADES_SQL} SELECT * REPLACE (price - 5 AS price) FROM trades WHERE price - 5 > 0 AND quantity > 0""",
)
def _valid(t: Tables) -> DataFrame:
    return series.valid_trades(trades(t).withColumn("price", F.col("price") - 5))


@register("trades_dedup", f"WITH {TRADES_SQL} SELECT * FROM trades")
def _dedup(t: Tables) -> DataFrame:
    frame = trades(t)
    return series.unique_trades(frame.unionByName(frame.where("instrument = 'view'")), KEYS)


@register(
    "last_n_bars",
    f"""WITH {candles_cte('hour')}, r AS (
      SELECT *, row_number() OVER (PARTITION BY market, instrument ORDER BY datetime DESC) AS rn FROM candles
      WHERE datetime <= TIMESTAMP '2024-01-25 12:00:00')
    {rounded_sql('(SELECT * EXCLUDE (rn) FROM r WHERE rn <= 30)')}""",
)
def _last_n(t: Tables) -> DataFrame:
    bars = series.candles(trades(t), KEYS, "1h")
    return rounded(last_n_points(bars, KEYS, "datetime", 30, F.lit("2024-01-25 12:00:00").cast("timestamp_ntz")))


@register(
    "last_n_trades",
    f"""WITH {TRADES_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY ts DESC, seq DESC) AS rn FROM trades)
    SELECT 'all' AS venue, * EXCLUDE (rn) FROM r WHERE rn <= 6000""",
)
def _last_n_trades(t: Tables) -> DataFrame:
    """One key holds all rows, and more are wanted than a window is limited to before its shuffle."""
    return last_n_points(trades(t).select(F.lit("all").alias("venue"), "*"), ["venue"], "ts", 6000, ties=["seq"])


@register(
    "column_groups",
    f"WITH {candles_cte('day')} SELECT market, instrument, datetime, open, high, low, close FROM candles",
)
def _groups(t: Tables) -> DataFrame:
    return series.select_groups(series.candles(trades(t), KEYS, "1d"), ["ID", "OHLC"])
