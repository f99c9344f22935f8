from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tests.test_lookups import lookups  # noqa: F401  (fixture)
from tierflow.operators import daily
from tierflow.operators.dashboard import dashboard
from tierflow.operators.matrix import MATRIX_KEYS, matrix_long, matrix_wide

NOON = datetime(2026, 5, 9, 12, 30, tzinfo=timezone.utc)
METRICS = {
    "a": "mean",
    "b": "SUM",
    "c": "max",
    "d": "min",
    "e": "last",
    "f": "delta",
    "g": None,
    "h": "median",
    "gone": "sum",
}
NAMES = [m for m in METRICS if m != "gone"]


def readings(spark, rows):
    """Rows of account, site, set, time, value: every metric holds the value."""
    frame = spark.createDataFrame(
        rows,
        "AccountId string, SiteId string, HouseIdSet string, LocalDateTime timestamp, "
        "v double, id long",
    )
    return frame.select("*", *[F.col("v").alias(m) for m in NAMES])


ROWS = [
    ("1", "3", "[12]", datetime(2026, 5, 9, 8), 1.0, 1),
    ("1", "3", "[12]", datetime(2026, 5, 9, 10), 4.0, 2),
    ("1", "3", "12", datetime(2026, 5, 9, 10), 2.0, 3),
    ("1", "3", "[12]", datetime(2026, 5, 9, 11), None, 4),
    ("1", "3", "[]", datetime(2026, 5, 8, 1), None, 5),
    ("2", "9", None, datetime(2026, 5, 8, 1), 7.0, 6),
    ("2", "9", None, None, 7.0, 7),
]


def test_every_aggregate(spark, lookups):  # noqa: F811
    stats = daily.enriched_daily_stats(
        readings(spark, ROWS), lookups, METRICS, NOON, tie_break="id"
    )
    row = stats.filter("Date = date'2026-05-09' and SiteName = 'Site 1'").first()
    assert row.row_count == 4
    values = {m: row[f"{m}_mean"] for m in NAMES}
    mean = pytest.approx(7 / 3)
    assert values == {
        "a": mean, "b": 7.0, "c": 4.0, "d": 1.0, "e": 2.0, "f": 3.0, "g": mean, "h": mean,
    }
    assert {row[f"{m}_null_count"] for m in NAMES} == {1}
    assert {row[f"{m}_null_fraction"] for m in NAMES} == {0.25}
    assert row.last_record_local_ts == datetime(2026, 5, 9, 11)
    assert (row.elapsed_utc_hours, row.day_progress_fraction) == (12.5, 12.5 / 24)


def test_all_null_group_and_null_identity(spark, lookups):  # noqa: F811
    stats = daily.enriched_daily_stats(readings(spark, ROWS), lookups, METRICS, NOON)
    by_account = {r.AccountId: r for r in stats.filter("Date = date'2026-05-08'").collect()}
    empty, other = by_account["1"], by_account["2"]
    assert [empty[f"{m}_mean"] for m in NAMES] == [None] * len(NAMES)
    assert (empty.HouseIdSet, empty.a_null_fraction) == ("3", 1.0)
    assert (other.HouseIdSet, other.Customer, other.e_mean) == (None, "Bob", 7.0)
    assert (other.elapsed_utc_hours, other.day_progress_fraction) == (24.0, 1.0)


def test_column_order(spark, lookups):  # noqa: F811
    stats = daily.enriched_daily_stats(readings(spark, ROWS), lookups, {"b": "sum", "a": "mean"})
    assert stats.columns == [
        *daily.IDENTITY, "row_count", "b_mean", "a_mean", "b_null_count", "a_null_count",
        "last_record_local_ts", "b_null_fraction", "a_null_fraction",
        "elapsed_utc_hours", "day_progress_fraction",
    ]


def test_reducing_first_equals_joining_first(spark, lookups):  # noqa: F811
    """Also where two sites of one fan-out share every name and so merge."""
    twins = spark.createDataFrame(
        [("12", "8", "Twin"), ("12", "9", "Twin"), ("13", "9", "Other")],
        "Id string, SiteId string, Name string",
    )
    from tierflow.operators.lookups import Lookups, site_lookup

    merged = Lookups(lookups.account, lookups.house, site_lookup(twins))
    rows = readings(spark, ROWS + [("1", "3", "[13]", datetime(2026, 5, 9, 3), 2.5, 8)])
    first = daily.enriched_daily_stats(rows, merged, METRICS, NOON, "id")
    after = daily.daily_stats(dashboard(rows, merged), METRICS, NOON, "id")
    assert first.columns == after.columns
    assert rows_of(first) == rows_of(after)
    assert first.filter("SiteName = 'Twin'").first().row_count == 8


def test_whole_numbers_keep_their_type(spark, lookups):  # noqa: F811
    rows = readings(spark, ROWS).withColumn("a", F.col("id").cast("int"))
    stats = daily.enriched_daily_stats(rows, lookups, {"a": "sum", "b": "max"})
    assert dict(stats.dtypes)["a_mean"] == "bigint"


def test_last_without_tie_break_is_repeatable(spark):
    same = datetime(2026, 5, 9, 8)
    values = [3.0, 9.0, 5.0, None]
    seen = set()
    for order in (values, values[::-1]):
        rows = readings(spark, [("1", "1", "1", same, v, 0) for v in order]).repartition(4)
        seen.add(daily.metric_value(rows, ["AccountId"], "v", "last").first().v_mean)
    assert len(seen) == 1 and seen <= {3.0, 9.0, 5.0}


def test_hash_aggregation_even_for_last(spark):
    rows = readings(spark, ROWS)
    text = plan_of(daily.metric_value(rows, ["AccountId"], "v", "last", tie_break="id"))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_text_event_time(spark):
    rows = spark.createDataFrame(
        [("2026-05-09 10:00:00", 1.0), ("2026-05-09 11:00:00", 2.0), ("bad", 3.0)],
        "LocalDateTime string, v double",
    ).withColumns({c: F.lit("1") for c in ("AccountId", "SiteId")})
    stats = daily.daily_stats(rows, {"v": "last"}, keys=("Date", "AccountId")).collect()
    assert [(r.Date, r.v_mean, r.row_count) for r in stats] == [(date(2026, 5, 9), 2.0, 2)]


def test_missing_metrics_and_time(spark):
    rows = readings(spark, ROWS)
    with pytest.raises(ValueError):
        daily.daily_stats(rows, {"gone": "sum"})
    with pytest.raises(ValueError):
        daily.daily_stats(rows.drop("LocalDateTime"), {"a": "sum"})


def test_as_of_is_compared_in_utc(spark):
    late = datetime.fromisoformat("2026-05-10T00:30:00+02:00")
    frame = spark.sql("select date'2026-05-09' as Date union all select date'2026-05-10'")
    got = frame.select("Date", *daily.day_progress("Date", late)).collect()
    assert {r.Date.day: r.elapsed_utc_hours for r in got} == {9: 22.5, 10: 24.0}


@pytest.fixture
def positions(spark):
    rows = [
        ("2026-05-09", "1", "a", 1, -3.0, 2.0),
        ("2026-05-09", "1", "a", 1, 0.5, 3.0),
        ("2026-05-09", "1", "a", 1, 250.0, None),
        ("2026-05-09", "1", None, 1, 42.5, 1.0),
        ("2026-05-09", None, "a", 2, 42.5, 1.5),
        ("2026-05-09", "1", "a", None, 42.5, 1.0),
        ("2026-05-09", "1", "a", 1, None, 1.0),
        ("bad", "1", "a", 1, 42.5, 1.0),
    ]
    return spark.createDataFrame(
        rows,
        "PartitionDate string, AccountId string, beltids string, linenmbr int, "
        "distancedonepercent double, eggsincrease double",
    ).withColumns({"SiteId": F.lit("3"), "HouseIdSet": F.lit("[3]")})


def test_matrix_long(spark, positions):
    long = matrix_long(positions)
    got = long.select("AccountId", "beltids", "linenmbr", "position_bin", "eggsincrease_sum", "sample_count")
    assert rows_of(got) == sorted(
        [
            ("1", "a", 1, 0, 5.0, 2),
            ("1", "a", 1, 99, 0.0, 1),
            ("1", None, 1, 42, 1.0, 1),
            (None, "a", 2, 42, 1.5, 1),
        ],
        key=repr,
    )


def test_matrix_wide_unpivots_to_long(spark, positions):
    long = matrix_long(positions)
    wide = matrix_wide(long)
    assert wide.columns == [*MATRIX_KEYS, *[f"pos_{i:03d}" for i in range(100)]]
    back = wide.unpivot(list(MATRIX_KEYS), wide.columns[6:], "bin", "eggsincrease_sum").filter(
        "eggsincrease_sum is not null"
    )
    back = back.withColumn("position_bin", F.substring("bin", 5, 3).cast("int"))
    columns = [*MATRIX_KEYS, "position_bin", "eggsincrease_sum"]
    assert rows_of(back.select(columns)) == rows_of(long.select(columns))


def test_matrix_needs_its_columns(spark):
    with pytest.raises(ValueError, match="beltids"):
        matrix_long(spark.range(1))
