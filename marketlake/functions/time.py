"""Epoch, timestamp and period arithmetic (all in UTC, zone-less at rest)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NTZ = "timestamp_ntz"

# Interval codes, their plural period names and Spark units.
INTERVAL_PERIODS = {"1d": "days", "1h": "hours", "1m": "minutes"}
PERIOD_UNITS = {"days": "DAY", "hours": "HOUR", "minutes": "MINUTE"}
UNIT_SECONDS = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60}

# The text forms accepted for a datetime.
DATETIME_PATTERNS = (
    "yyyy-M-d'T'H:m:s.SSSSSS'Z'",
    "yyyy-M-d'T'H:m:s'Z'",
    "yyyy-M-d H:m:s",
    "yyyy-M-d",
)
_NUMBER = r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$"
_LAST_EPOCH = 253_402_300_800  # start of year 10000
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ZERO_DATE = "0000-00-00 00:00:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def interval_unit(interval: str) -> str:
    """Spark unit (DAY/HOUR/MINUTE) of an interval code or period name."""
    unit = PERIOD_UNITS.get(INTERVAL_PERIODS.get(interval, interval))
    if unit is None:
        raise ValueError(f"Unsupported interval: {interval}")
    return unit


def epoch_to_ts(c: Column | str) -> Column:
    """Epoch seconds to timestamp; null stays null and 0 is 1970-01-01."""
    return F.timestamp_seconds(_col(c)).cast(NTZ)


def epoch_to_ts_nonzero(c: Column | str) -> Column:
    """Epoch seconds to timestamp; 0 means "never" and becomes null."""
    return F.timestamp_seconds(F.nullif(_col(c), F.lit(0))).cast(NTZ)


def ts_to_epoch(c: Column | str) -> Column:
    """Whole epoch seconds of a timestamp (floored)."""
    return F.unix_seconds(_col(c).cast("timestamp"))


def ts_to_iso(c: Column | str) -> Column:
    """ISO 8601 text with second resolution, no zone suffix."""
    return F.date_format(_col(c), ISO_SECONDS)


def ts_to_iso_full(c: Column | str) -> Column:
    """ISO 8601 text that keeps microseconds where there are any."""
    c = _col(c)
    whole = F.date_trunc("second", c).cast(NTZ) == c.cast(NTZ)
    return F.when(whole, F.date_format(c, ISO_SECONDS)).otherwise(F.date_format(c, ISO_MICROSECONDS))


def zero_date_to_null(c: Column | str) -> Column:
    """Text timestamps: the zero date means null."""
    return F.nullif(_col(c), F.lit(ZERO_DATE))


def to_utc_ntz(c: Column | str, zone: str | None = None) -> Column:
    """Zone-aware (or ``zone`` local) time as a zone-less UTC timestamp."""
    c = _col(c)
    if zone is not None:
        c = F.to_utc_timestamp(c, zone)
    return c.cast(NTZ)


def _pattern_marks(c: Column) -> tuple[Column, ...]:
    """For each of ``DATETIME_PATTERNS``, whether text has its marks: at most one does, and none that fits is left out.

    A failed attempt costs far more than a good one.
    """
    dashed, timed, dotted = c.contains("-"), c.contains(":"), c.contains(".")
    zulu = c.endswith("Z") | c.endswith("z")  # patterns ignore case
    return (
        dashed & timed & zulu & dotted,
        dashed & timed & zulu & ~dotted,
        dashed & timed & ~zulu & ~dotted,
        dashed & ~timed,
    )


def parse_datetime(c: Column | str, on_error: str = "raise") -> Column:
    """Parse text in any accepted form, a timestamp, or epoch seconds (numbers or text) to whole seconds.

    Text that fits no form but is shaped like a datetime is read from its
    first 19 characters; fractions are cut.  What is left raises, or is null
    with ``on_error="null"``.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    c = _col(c).cast("string")  # numbers and timestamps take the same forms
    attempts = [F.when(m, F.try_to_timestamp(c, F.lit(p))) for m, p in zip(_pattern_marks(c), DATETIME_PATTERNS, strict=True)]
    shaped = (F.length(c) >= 19) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 14, 1) == ":")
    attempts.append(F.when(shaped, F.try_to_timestamp(F.substring(c, 1, 19))))
    number = F.when(c.rlike(_NUMBER), c.try_cast("double"))
    attempts.append(F.when(F.abs(number) < _LAST_EPOCH, F.timestamp_seconds(F.floor(number))))
    parsed = F.date_trunc("second", F.coalesce(*attempts)).cast(NTZ)
    if on_error == "null":
        return parsed
    failure = F.raise_error(F.concat(F.lit("Cannot convert to datetime: "), c)).cast(NTZ)
    return F.coalesce(parsed, F.when(c.isNotNull(), failure))


def period_start(c: Column | str, unit: str) -> Column:
    """Start of the period the timestamp falls in (weeks start on Monday)."""
    return F.date_trunc(unit, _col(c)).cast(NTZ)


def end_of_previous_period(c: Column | str, interval: str) -> Column:
    """Last microsecond before the period the timestamp falls in."""
    return period_start(c, interval_unit(interval)) - F.expr("INTERVAL 1 MICROSECOND")


def add_periods(c: Column | str, n: Column | int, interval: str) -> Column:
    """Shift a timestamp by ``n`` periods."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add(interval_unit(interval), n.cast("int"), _col(c))


def periods_between(start: Column | str, end: Column | str, interval: str) -> Column:
    """Days by calendar date; hours and minutes truncated towards zero."""
    unit = interval_unit(interval)
    if unit == "DAY":
        return F.date_diff(_col(end).cast("date"), _col(start).cast("date")).cast("bigint")
    return F.timestamp_diff(unit, _col(start), _col(end))
