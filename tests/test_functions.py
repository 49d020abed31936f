from difflib import SequenceMatcher

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from moments import at
from marketlake import functions as fn
from marketlake.functions import time


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_epochs(spark, rows):
    df = rows([(None,), (0,), (1700000000,)], "s bigint")
    got = df.select(fn.epoch_to_ts("s"), fn.epoch_to_ts_nonzero("s")).collect()
    assert [tuple(r) for r in got] == [
        (None, None),
        (at("1970-01-01"), None),
        (at("2023-11-14T22:13:20"), at("2023-11-14T22:13:20")),
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-05T01:02:03.123456Z", "2024-01-05T01:02:03"),
        ("2024-01-05T01:02:03.5Z", "2024-01-05T01:02:03"),
        ("2024-01-05T01:02:03Z", "2024-01-05T01:02:03"),
        ("2024-01-05 01:02:03", "2024-01-05T01:02:03"),
        ("2024-1-5", "2024-01-05T00:00:00"),
        ("2024-01-05T01:02:03+00:00", "2024-01-05T01:02:03"),
        (None, None),
    ],
)
def test_parse_datetime(spark, text, expected):
    got = one(spark, fn.parse_datetime(F.lit(text).cast("string")))[0]
    assert got == (at(expected) if expected else None)


def test_parse_datetime_failure(spark):
    assert one(spark, fn.parse_datetime(F.lit("soon"), on_error="null"))[0] is None
    with pytest.raises(PySparkException):
        one(spark, fn.parse_datetime(F.lit("soon")))


def test_zero_date(spark):
    got = one(spark, fn.zero_date_to_null(F.lit("0000-00-00 00:00:00")), fn.zero_date_to_null(F.lit("2024-01-01")))
    assert tuple(got) == (None, "2024-01-01")


def test_period_ends(spark):
    ts = F.lit("2024-03-01 10:30:15.5").cast("timestamp_ntz")
    got = one(spark, *[fn.end_of_previous_period(ts, i) for i in ("1d", "1h", "1m")])
    assert tuple(got) == (
        at("2024-02-29T23:59:59.999999"),
        at("2024-03-01T09:59:59.999999"),
        at("2024-03-01T10:29:59.999999"),
    )


def test_periods_between_truncates_towards_zero(spark):
    a, b = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 09:59:59.999999").cast("timestamp_ntz")
    assert tuple(one(spark, fn.periods_between(a, b, "1h"), fn.periods_between(a, b, "1m"))) == (0, 0)
    late = F.lit("2024-01-02 00:00:01").cast("timestamp_ntz")
    assert one(spark, fn.periods_between(a, late, "1d"))[0] == 1


def test_interval_codes():
    assert [fn.interval_unit(i) for i in ("1d", "1h", "1m", "days")] == ["DAY", "HOUR", "MINUTE", "DAY"]
    with pytest.raises(ValueError):
        fn.interval_unit("1w")


def test_text(spark):
    got = one(
        spark,
        fn.normalise_name(F.lit("Wrapped_Bit-Coin X")),
        fn.normalise_name(F.lit(None).cast("string")),
        fn.pair_symbol(F.lit("BTC"), F.lit(None).cast("string")),
        fn.split_list(F.lit("a, b ,c")),
    )
    assert tuple(got) == ("wrappedbitcoinx", "", None, ["a", "b", "c"])
    assert fn.strip_suffix(["a_str", "b"]) == {"a_str": "a", "b": "b"}


def test_flags(spark):
    got = one(spark, *[fn.flag_to_int(F.lit(v)) for v in (True, "TRUE", "yes", 1, None)])
    assert tuple(got) == (1, 1, 0, 0, 0)


def test_similarity(spark, rows):
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), ("bitcoin", "bitcoins"), (None, "x")]
    got = rows(pairs, "a string, b string").select(fn.similarity_ratio()("a", "b")).collect()
    want = [None if a is None else SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert [r[0] for r in got] == want


def test_change(spark):
    got = one(spark, fn.change(F.lit(110.0), F.lit(100.0)), fn.change_percentage(F.lit(110.0), F.lit(0.0)))
    assert tuple(got) == (10.0, None)


def test_parse_datetime_epochs(spark):
    cases = [
        (F.lit("1700000000"), "2023-11-14T22:13:20"),
        (F.lit("1700000000.5"), "2023-11-14T22:13:20"),
        (F.lit(1700000000), "2023-11-14T22:13:20"),
        (F.lit(1.7e9), "2023-11-14T22:13:20"),
        (F.lit(0), "1970-01-01T00:00:00"),
        (F.lit("2024-02-03T04:05:06.7 shaped"), "2024-02-03T04:05:06"),
        (F.to_timestamp(F.lit("2024-02-03 04:05:06.123456")), "2024-02-03T04:05:06"),
    ]
    for value, expected in cases:
        assert one(spark, fn.parse_datetime(value))[0].isoformat() == expected


@pytest.mark.parametrize(
    "text, tried",
    [
        ("2024-01-05T01:02:03.5Z", 0),
        ("2024-1-5t1:2:3.123456z", 0),
        ("2024-01-05T01:02:03Z", 1),
        ("2024-01-05 01:02:03", 2),
        ("2024-1-5", 3),
        ("2024-01-05 01:02:03.123456", None),
        ("1700000000", None),
        ("1700000000.75", None),
        ("no date", None),
    ],
)
def test_text_is_tried_on_its_own_pattern_only(spark, text, tried):
    plan = spark.range(1).select(F.concat(F.lit(text), F.lit("")).alias("c"))
    marks = plan.select(*[m.alias(f"m{i}") for i, m in enumerate(time._pattern_marks(F.col("c")))]).first()
    assert [i for i, m in enumerate(marks) if m] == ([] if tried is None else [tried])
    # no pattern that fits is left out
    direct = [plan.select(F.try_to_timestamp("c", F.lit(p))).first()[0] is not None for p in time.DATETIME_PATTERNS]
    assert all(mark or not fits for mark, fits in zip(marks, direct))
