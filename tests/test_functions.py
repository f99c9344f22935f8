from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions import days, parsing
from tierflow.functions.position import bin_label, cell_value, position_bin


def evaluate(spark, values, dtype, column):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", dtype)])
    frame = spark.createDataFrame(list(enumerate(values)), schema)
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_bigint_or_null(spark):
    texts = ["12", " 7 ", "", "   ", "12a", "12.0", "1e3", None, "9" * 20, "-5"]
    got = evaluate(spark, texts, T.StringType(), parsing.bigint_or_null("x"))
    assert got == [12, 7, None, None, None, None, None, None, None, -5]


def test_bigint_or_null_takes_numbers(spark):
    assert evaluate(spark, [3, None], T.LongType(), parsing.bigint_or_null("x")) == [
        3,
        None,
    ]


def test_numeric_suffix(spark):
    names = ["House 12", "12 House", "H007", None, "", "H" + "9" * 20]
    got = evaluate(spark, names, T.StringType(), parsing.numeric_suffix("x"))
    assert got == [12, None, 7, None, None, None]


def test_normalize_identifier(spark):
    texts = ["[12]", " [ 12 ] ", "[]", "[12],[13]", None, "a b"]
    got = evaluate(spark, texts, T.StringType(), parsing.normalize_identifier("x"))
    assert got == ["12", "12", "", "12],[13", None, "a b"]


def test_position_bin(spark):
    inf = math.inf
    places = [None, -3.0, 0.0, 0.999, 42.5, 99.9995, 100.0, 250.0, math.nan, inf, -inf]
    got = evaluate(spark, places, T.DoubleType(), position_bin("x"))
    assert got == [None, 0, 0, 0, 42, 99, 99, 99, 99, 99, 0]


def test_cell_value_and_label(spark):
    assert evaluate(spark, [1, None], T.IntegerType(), cell_value("x")) == [1.0, 0.0]
    assert (bin_label(0), bin_label(7), bin_label(99)) == ("pos_000", "pos_007", "pos_099")


SHAPES = [
    "2026-05-09T10:00:00.123456Z",
    "2026-05-09T10:00:00.123Z",
    "2026-05-09T10:00:00Z",
    "2026-05-09 10:00:00",
    "2026-05-09",
    "bad",
    "",
    None,
]


def test_text_to_timestamp(spark):
    ten = datetime(2026, 5, 9, 10)
    got = evaluate(spark, SHAPES, T.StringType(), parsing.text_to_timestamp("x"))
    assert got == [
        ten.replace(microsecond=123456),
        ten.replace(microsecond=123000),
        ten,
        ten,
        None,
        None,
        None,
        None,
    ]


def test_zulu_is_a_literal_and_keeps_the_local_day(spark):
    late = ["2026-05-09T23:30:00Z"]
    column = F.to_date(parsing.text_to_timestamp("x"))
    assert evaluate(spark, late, T.StringType(), column) == [date(2026, 5, 9)]


ODD_TEXTS = [
    *SHAPES,
    "2026-05-09t10:00:00z",
    "2026-05-09T10:00:00.1234567Z",
    "2026-05-09T10:00:00.Z",
    "2026-5-9 10:00:00",
    "2026-05-09 1:00:00",
    "2026-05-09 10:00:00.5",
    " 2026-05-09",
    "2026-05-09 ",
    "2026-05-09\n",
    "2026-13-09",
    "2026-02-30",
    "2026-02-30T10:00:00Z",
    "2026-05-09 24:00:00",
    "+12026-05-09",
    "+12026-05-09 10:00:00",
    "-2026-05-09",
    "12026-05-09",
    "0026-05-09",
    "26-05-09",
    "2026-05-09T10:00:00",
    "2026-05-09T10:00:00+01:00",
    "２０２６-05-09",
    "2024-03-31 02:30:00",
    "2024-10-27 02:30:00",
]


@pytest.mark.parametrize(
    "by_shape, patterns",
    [
        (
            parsing.text_to_timestamp,
            (parsing.FRACTION_Z, parsing.SECOND_Z, parsing.SPACED),
        ),
        (parsing.text_to_date, (parsing.DAY, parsing.SECOND_Z)),
        (
            parsing.text_to_event_date,
            (parsing.DAY, parsing.FRACTION_Z, parsing.SPACED),
        ),
    ],
)
def test_shapes_agree_with_trying_every_pattern(spark, by_shape, patterns):
    tried = F.coalesce(*[F.try_to_timestamp("x", F.lit(p)) for p in patterns])
    if by_shape is not parsing.text_to_timestamp:
        tried = F.to_date(tried)
    got = evaluate(spark, ODD_TEXTS, T.StringType(), by_shape("x").cast("string"))
    want = evaluate(spark, ODD_TEXTS, T.StringType(), tried.cast("string"))
    assert dict(zip(ODD_TEXTS, got)) == dict(zip(ODD_TEXTS, want))


def test_event_day_takes_first_value_not_first_column(spark):
    frame = spark.createDataFrame(
        [
            ("2026-05-01", datetime(2026, 5, 2, 12), date(2026, 5, 3)),
            ("bad", datetime(2026, 5, 2, 12), date(2026, 5, 3)),
            (None, None, date(2026, 5, 3)),
            (None, None, None),
        ],
        "PartitionDate string, BestUtcDateTime timestamp, datetimeutc date",
    )
    got = [r[0] for r in frame.select(parsing.event_day(frame.schema)).collect()]
    assert got == [date(2026, 5, 1), date(2026, 5, 2), date(2026, 5, 3), None]


def test_event_day_of_zone_free_timestamp(spark):
    frame = spark.sql("select timestamp_ntz'2026-05-09 23:59:59' as BestUtcDateTime")
    got = frame.select(parsing.event_day(frame.schema)).first()[0]
    assert got == date(2026, 5, 9)


def test_event_day_without_candidates_is_null(spark):
    frame = spark.range(1)
    assert frame.select(parsing.event_day(frame.schema)).first()[0] is None


def test_event_time_column():
    assert parsing.event_time_column(["x", "BestUtcDateTime", "LocalDateTime"]) == (
        "LocalDateTime"
    )
    with pytest.raises(ValueError):
        parsing.event_time_column(["ts"])


def test_epoch_micros_orders_zone_free_times_across_a_clock_change(spark):
    frame = spark.sql(
        """select ts from values (timestamp_ntz'2024-03-31 01:59:59.000001'),
        (timestamp_ntz'2024-03-31 02:30:00'), (timestamp_ntz'2024-03-31 03:10:00.5')
        as t(ts)"""
    )
    column = parsing.epoch_micros(F.col("ts"), T.TimestampNTZType())
    got = [r[0] for r in frame.select(column).collect()]
    start = datetime(1970, 1, 1)
    want = [
        datetime(2024, 3, 31, 1, 59, 59, 1),
        datetime(2024, 3, 31, 2, 30),
        datetime(2024, 3, 31, 3, 10, 0, 500000),
    ]
    micros = [(w - start).total_seconds() * 1_000_000 for w in want]
    assert got == pytest.approx(micros, abs=0.5)


def test_calendar_days(spark):
    def of(first, last):
        column = days.calendar_days(
            F.lit(first).cast("date"), F.lit(last).cast("date")
        )
        return [d.isoformat() for d in spark.range(1).select(column).first()[0]]

    assert of("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert of("2024-03-01", "2024-03-01") == ["2024-03-01"]
    assert of("2024-03-02", "2024-03-01") == []


def test_listed_days(spark):
    texts = ["2024-01-01, 2024-01-02,", "", " , ", None]
    got = evaluate(spark, texts, T.StringType(), days.listed_days("x"))
    assert got == [["2024-01-01", "2024-01-02"], [], [], None]


def test_window_bounds_are_inclusive_and_optional(spark):
    values = [date(2024, 1, d) for d in (1, 2, 3)]

    def kept(first, last):
        flags = evaluate(spark, values, T.DateType(), days.in_window("x", first, last))
        return [v.day for v, flag in zip(values, flags) if flag]

    assert kept("2024-01-02", date(2024, 1, 3)) == [2, 3]
    assert kept(None, "2024-01-01") == [1]
    assert kept(None, None) == [1, 2, 3]
    assert kept("2024-01-03", "2024-01-01") == []
