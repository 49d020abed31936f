"""High-water marks, incremental plans, period arithmetic and conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake import functions as fn
from marketlake.operators import fetchplan
from marketlake.plans.store import Store
from marketlake.registry.base import TRADES_SQL, Tables, register, trades
from marketlake.schemas import TABLES
from marketlake.session import shared_path

MID = "timestamp_ntz'2024-01-16'"


@register(
    "high_water",
    """WITH wanted AS (SELECT DISTINCT user_id, event_type FROM events),
       hw AS (SELECT user_id, event_type, max(ts) AS high_water FROM events
              WHERE ts < TIMESTAMP '2024-01-03' GROUP BY ALL)
       SELECT user_id, event_type, high_water FROM wanted LEFT JOIN hw USING (user_id, event_type)""",
)
def _high_water(t: Tables) -> DataFrame:
    keys = ["user_id", "event_type"]
    stored = t.events.where("ts < timestamp_ntz'2024-01-03'")
    return fetchplan.with_high_water(t.events.select(*keys).distinct(), stored, keys, "ts")


@register(
    "newer_than_hwm",
    """WITH hw AS (SELECT user_id, event_type, max(ts) AS h FROM events
                   WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'signup' GROUP BY ALL)
       SELECT event_id, user_id, event_type, ts FROM events LEFT JOIN hw USING (user_id, event_type)
       WHERE h IS NULL OR ts > h""",
)
def _newer(t: Tables) -> DataFrame:
    frame = t.events.select("event_id", "user_id", "event_type", "ts")
    stored = frame.where(f"ts < {MID} and event_type <> 'signup'")
    return fetchplan.newer_than_stored(frame, stored, ["user_id", "event_type"], "ts")


def _plan_sql(unit: str, points: int, now: str) -> str:
    days = unit == "DAY"
    delta = (
        "date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))" if days else f"date_sub('{unit}', {{a}}, {{b}})"
    )
    step = f"INTERVAL 1 {unit}"
    jump = f"INTERVAL {points} {unit}"
    size = f"least(d + 1, {points})"
    last = f"s + {step} * CAST({size} - 1 AS INTEGER)"
    return f"""
WITH RECURSIVE {TRADES_SQL},
inst AS (
  SELECT market, instrument AS mapped_instrument, date_trunc('second', max(ts)) AS last_update,
         CASE WHEN instrument = 'error' THEN NULL ELSE date_trunc('second', min(ts)) END AS first_update,
         CASE WHEN market IN ('m0', 'm1', 'm2') THEN 'ACTIVE' ELSE 'EXPIRED' END AS status
  FROM trades GROUP BY market, instrument),
hw AS (
  SELECT market, instrument AS mapped_instrument, max(date_trunc('{unit}', ts)) AS h FROM trades
  WHERE ts < TIMESTAMP '2024-01-20' AND instrument IN ('click', 'view') GROUP BY ALL),
base AS (
  SELECT market, mapped_instrument,
    coalesce(h + {step}, first_update, date_trunc('day', TIMESTAMP '{now}') - INTERVAL {points} DAY) AS s,
    CASE WHEN status = 'ACTIVE' THEN date_trunc('{unit}', TIMESTAMP '{now}') - INTERVAL 1 MICROSECOND
         ELSE last_update END AS e
  FROM inst LEFT JOIN hw USING (market, mapped_instrument)),
steps AS (
  SELECT market, mapped_instrument, 0 AS batch, s, e, {delta.format(a='s', b='e')} AS d FROM base
  WHERE {delta.format(a='s', b='e')} >= 0
  UNION ALL
  SELECT market, mapped_instrument, batch + 1, s + {jump}, e, {delta.format(a=f's + {jump}', b='e')} FROM steps
  WHERE s + {jump} <= e AND s + {jump} <= TIMESTAMP '{now}' AND {delta.format(a=f's + {jump}', b='e')} >= 0)
SELECT market, mapped_instrument, CAST(batch AS BIGINT) AS batch, s AS batch_start,
  least({last}, date_trunc('second', e)) AS batch_end,
  CAST(floor(epoch(least({last}, date_trunc('second', e)))) AS BIGINT) AS to_ts,
  CAST({size} AS BIGINT) AS points
FROM steps"""


_PLANS = {
    "fetch_plan_1d": ("1d", "DAY", 7, "2024-02-01 10:30:15"),
    "fetch_plan_1h": ("1h", "HOUR", 100, "2024-02-01 10:30:15"),
    "fetch_plan_1m": ("1m", "MINUTE", 2000, "2024-02-01 10:30:15"),
}


def _plan_input(t: Tables, unit: str) -> tuple[DataFrame, DataFrame]:
    """Instruments, and the bars stored for some of them."""
    base = trades(t).withColumnRenamed("instrument", "mapped_instrument")
    second = lambda c: F.date_trunc("second", c).cast("timestamp_ntz")
    instruments = base.groupBy("market", "mapped_instrument").agg(
        second(F.max("ts")).alias("last_update"), second(F.min("ts")).alias("first")
    )
    instruments = instruments.select(
        "market",
        "mapped_instrument",
        "last_update",
        F.when(F.col("mapped_instrument") != "error", F.col("first")).alias("first_update"),
        F.when(F.col("market").isin("m0", "m1", "m2"), "ACTIVE").otherwise("EXPIRED").alias("status"),
    )
    stored = base.where("ts < timestamp_ntz'2024-01-20' and mapped_instrument in ('click', 'view')")
    return instruments, stored.select("market", "mapped_instrument", fn.period_start("ts", unit).alias("datetime"))


for _name, (_interval, _unit, _points, _now) in _PLANS.items():

    @register(_name, _plan_sql(_unit, _points, _now))
    def _fetch_plan(t: Tables, interval=_interval, unit=_unit, points=_points, now=_now) -> DataFrame:
        instruments, stored = _plan_input(t, unit)
        return fetchplan.fetch_plan(instruments, stored, interval, F.lit(now), max_points=points)


@register("incremental_plan", _plan_sql(*_PLANS["fetch_plan_1h"][1:]))
def _incremental_plan(t: Tables) -> DataFrame:
    """The hourly plan from the marks of a stored series, which three upserts have kept up."""
    store = Store(shared_path(t.spark, "store"))
    instruments, stored = _plan_input(t, "HOUR")
    spec = TABLES["futures_ohlcv_1h"]
    bars = stored.distinct()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields if f.name not in bars.columns]
    bars = bars.select("*", *empty).select(*spec.names)
    for part in ("day(datetime) % 3 = 1", "day(datetime) % 3 = 0", "day(datetime) % 3 = 2"):
        store.upsert(bars.where(part), "futures_ohlcv_1h")
    return fetchplan.fetch_plan(
        instruments, store.marks(t.spark, "futures_ohlcv_1h"), "1h", F.lit(_PLANS["fetch_plan_1h"][3]), max_points=100
    )


def _daily_sql(backfill: int) -> str:
    return f"""
WITH hw AS (SELECT o_custkey, max(o_orderdate) AS h FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
m AS (SELECT c_custkey, h, CAST(h AS DATE) AS last FROM customer LEFT JOIN hw ON c_custkey = o_custkey),
p AS (SELECT *, TIMESTAMP '2001-07-25 12:34:56' AS now, DATE '2001-07-25' AS today, DATE '2001-07-24' AS yesterday FROM m)
SELECT c_custkey,
  CASE WHEN h IS NULL THEN now - INTERVAL {backfill} DAY WHEN last = yesterday THEN h
       ELSE h + INTERVAL 1 DAY END AS start,
  CAST(epoch(TIMESTAMP '2001-07-24 23:59:59') AS BIGINT) AS to_ts,
  CAST(CASE WHEN h IS NULL THEN {backfill - 1} WHEN last = yesterday THEN 1
       ELSE date_diff('day', last + 1, yesterday) + 1 END AS BIGINT) AS points
FROM p WHERE h IS NULL OR last < today"""


for _name, _backfill in {"daily_plan": 5000, "daily_plan_index": 730}.items():

    @register(_name, _daily_sql(_backfill))
    def _daily(t: Tables, backfill=_backfill) -> DataFrame:
        wanted = t.customer.select("c_custkey")
        stored = t.orders.where("o_orderstatus <> 'P'").select(
            F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("datetime")
        )
        return fetchplan.daily_plan(wanted, stored, F.lit("2001-07-25 12:34:56"), ["c_custkey"], backfill)


@register(
    "epoch_conversions",
    """WITH e AS (SELECT event_id, CASE WHEN event_type = 'view' THEN 0 WHEN event_type = 'error' THEN NULL
                 ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS s FROM events)
       SELECT event_id, to_timestamp(s) AT TIME ZONE 'UTC' AS kept, to_timestamp(nullif(s, 0)) AT TIME ZONE 'UTC' AS dropped,
              strftime(to_timestamp(s) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') AS iso,
              to_timestamp(nullif(s, 0)) AT TIME ZONE 'UTC' AS from_text, coalesce(s, -1) AS back FROM e""",
)
def _epochs(t: Tables) -> DataFrame:
    seconds = (
        F.when(F.col("event_type") == "view", F.lit(0))
        .when(F.col("event_type") != "error", F.unix_seconds(F.col("ts").cast("timestamp")))
    )
    frame = t.events.select("event_id", seconds.alias("s"))
    text = F.when(F.col("s") == 0, "0000-00-00 00:00:00").otherwise(fn.ts_to_iso(fn.epoch_to_ts("s")))
    return frame.select(
        "event_id",
        fn.epoch_to_ts("s").alias("kept"),
        fn.epoch_to_ts_nonzero("s").alias("dropped"),
        fn.ts_to_iso(fn.epoch_to_ts("s")).alias("iso"),
        F.try_to_timestamp(fn.zero_date_to_null(text)).cast("timestamp_ntz").alias("from_text"),
        F.coalesce(fn.ts_to_epoch(fn.epoch_to_ts("s")), F.lit(-1)).alias("back"),
    )


@register(
    "parse_datetimes",
    """SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error'
                             THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
                             ELSE date_trunc('second', ts) END AS parsed,
              date_trunc('second', ts) AS from_number, date_trunc('second', ts) AS from_digits,
              date_trunc('second', ts) AS from_fraction, date_trunc('second', ts) AS from_timestamp
       FROM events""",
)
def _parse(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "error", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.lit("no date"))
    )
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id",
        fn.parse_datetime(text, on_error="null").alias("parsed"),
        fn.parse_datetime(epoch).alias("from_number"),
        fn.parse_datetime(epoch.cast("string")).alias("from_digits"),
        fn.parse_datetime(F.concat(epoch, F.lit(".75"))).alias("from_fraction"),
        fn.parse_datetime("ts").alias("from_timestamp"),
    )


@register(
    "period_arithmetic",
    """SELECT event_id, date_trunc('day', ts) - INTERVAL 1 MICROSECOND AS day_end,
       date_trunc('hour', ts) - INTERVAL 1 MICROSECOND AS hour_end,
       date_trunc('minute', ts) - INTERVAL 1 MICROSECOND AS minute_end,
       ts + INTERVAL 3 DAY AS later_days, ts + INTERVAL 5 HOUR AS later_hours, ts + INTERVAL 7 MINUTE AS later_minutes,
       date_diff('day', DATE '2024-01-15', CAST(ts AS DATE)) AS days,
       date_sub('hour', TIMESTAMP '2024-01-15 12:34:56', ts) AS hours,
       date_sub('minute', TIMESTAMP '2024-01-15 12:34:56', ts) AS minutes FROM events""",
)
def _periods(t: Tables) -> DataFrame:
    anchor = F.lit("2024-01-15 12:34:56").cast("timestamp_ntz")
    return t.events.select(
        "event_id",
        fn.end_of_previous_period("ts", "1d").alias("day_end"),
        fn.end_of_previous_period("ts", "1h").alias("hour_end"),
        fn.end_of_previous_period("ts", "1m").alias("minute_end"),
        fn.add_periods("ts", 3, "1d").alias("later_days"),
        fn.add_periods("ts", 5, "1h").alias("later_hours"),
        fn.add_periods("ts", 7, "1m").alias("later_minutes"),
        fn.periods_between(anchor, "ts", "1d").alias("days"),
        fn.periods_between(anchor, "ts", "1h").alias("hours"),
        fn.periods_between(anchor, "ts", "1m").alias("minutes"),
    )


@register(
    "to_utc",
    "SELECT event_id, ts + INTERVAL 5 HOUR AS utc, ts AS naive FROM events",
)
def _to_utc(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        fn.to_utc_ntz(F.col("ts").cast("timestamp"), "-05:00").alias("utc"),
        fn.to_utc_ntz("ts").alias("naive"),
    )


@register(
    "normalise_names",
    """SELECT p_partkey, replace(lower(replace(p_name, ' ', '-') || '_' || p_brand), '-', '') AS dashed,
       replace(replace(replace(lower(replace(p_name, ' ', '-') || '_' || p_brand), '-', ''), '_', ''), ' ', '') AS normalised,
       p_type || '-' || p_brand AS pair, string_split(p_name, ' ')[1] AS first_item, len(string_split(p_name, ' ')) AS items
       FROM part""",
)
def _names(t: Tables) -> DataFrame:
    raw = F.concat(F.translate("p_name", " ", "-"), F.lit("_"), F.col("p_brand"))
    listed = fn.split_list(F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ")))
    return t.part.select(
        "p_partkey",
        F.translate(F.lower(raw), "-", "").alias("dashed"),
        fn.normalise_name(raw).alias("normalised"),
        fn.pair_symbol("p_type", "p_brand").alias("pair"),
        listed[0].alias("first_item"),
        F.size(listed).cast("bigint").alias("items"),
    )


@register(
    "bool_flags",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS flag,
       CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS from_bool, 0 AS from_number FROM orders""",
)
def _flags(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", "TRUE").when(F.col("o_orderstatus") == "P", "no")
    return t.orders.select(
        "o_orderkey",
        fn.flag_to_int(text).alias("flag"),
        fn.flag_to_int(F.col("o_totalprice") > 200000).alias("from_bool"),
        fn.flag_to_int(F.lit(1)).alias("from_number"),
    )


@register(
    "changes",
    """SELECT o_orderkey, round(o_totalprice - 200000, 6) AS change,
       round(100.0 * (o_totalprice - 200000) / 200000, 6) AS change_percentage, CAST(NULL AS DOUBLE) AS from_zero FROM orders""",
)
def _changes(t: Tables) -> DataFrame:
    price, opening = F.col("o_totalprice"), F.lit(200000.0)
    return t.orders.select(
        "o_orderkey",
        F.round(fn.change(price, opening), 6).alias("change"),
        F.round(fn.change_percentage(price, opening), 6).alias("change_percentage"),
        fn.change_percentage(price, F.lit(0.0)).alias("from_zero"),
    )
