from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_lookups import lookups  # noqa: F401  (fixture)
from tierflow.plans import conforming, publishing
from tierflow.plans.backfill import missing_days, wanted_days
from tierflow.plans.ledger import LEDGER_SCHEMA, done_days, read_ledger
from tierflow.plans.local_days import partitions_holding
from tierflow.sinks.partitions import replace_partitions
from tierflow.sources.declared import TableSpec
from tierflow.sources.scans import (
    laid_out_by,
    literal_rows,
    partition_inventory,
    read_layer,
)

NOON = datetime(2026, 5, 9, 12, tzinfo=timezone.utc)
SPEC = TableSpec.from_config(
    1,
    {"AccountId": "Utf8", "SiteId": "Utf8", "LocalDateTime": "Datetime", "k": "Int32"},
    {
        "schema": {"v": "Float64", "eggsincrease": "Float64"},
        "numeric_columns": ["v"],
        "aggregation_map": {"v": "sum"},
        "merge_keys": ["k"],
    },
)


def raw_day(k, day, at=None, v="1.5"):
    at = at or f"2026-05-{day:02d}T10:00:00Z"
    return (str(k), "1", "3", "[12]", at, v, "b", "1", "40", v, f"2026-05-{day:02d}")


def write_raw(spark, root, rows, table_id=1, partitioned=True, mode="append"):
    frame = spark.createDataFrame(
        rows,
        "k string, AccountId string, SiteId string, HouseIdSet string, "
        "LocalDateTime string, v string, beltids string, linenmbr string, "
        "distancedonepercent string, eggsincrease string, date string",
    )
    path = conforming.table_path(root, table_id)
    writer = frame.write.mode(mode)
    if partitioned:
        writer.partitionBy("date").parquet(path)
    else:
        frame.withColumnRenamed("date", "PartitionDate").write.mode(mode).parquet(path)


@pytest.fixture
def roots(tmp_path):
    return [str(tmp_path / name) for name in ("raw", "conformed", "ledger", "published")]


def ledger_rows(spark, ledger, *columns):
    return rows_of(read_ledger(spark, ledger).select(*columns))


def test_run_then_rerun(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(1, 1), raw_day(2, 2), raw_day(3, 3, v="bad")])
    report = conforming.run(spark, raw, out, ledger, [SPEC], "2026-05-02", "2026-05-03")[1]
    assert (report.rows, report.days, report.rejected) == (2, ("2026-05-02", "2026-05-03"), 2)
    conforming.run(spark, raw, out, ledger, [SPEC])
    kept = read_layer(spark, conforming.table_path(out, 1))
    assert rows_of(kept.select("k", "v")) == [(1, 1.5), (2, 1.5), (3, None)]
    assert ledger_rows(
        spark, ledger, "status", "row_count", "partition_count", "partition_dates",
        "from_date", "is_backfill", "write_mode",
    ) == [
        ("SUCCESS", 2, 2, "2026-05-02,2026-05-03", "2026-05-02", False, "overwrite"),
        ("SUCCESS", 3, 3, "2026-05-01,2026-05-02,2026-05-03", None, False, "overwrite"),
    ]


def test_nothing_in_range_is_skipped(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(1, 1)])
    report = conforming.run(spark, raw, out, ledger, [SPEC], "2026-06-01", "2026-06-02")[1]
    assert report.status == "SKIPPED"
    assert ledger_rows(spark, ledger, "status", "row_count", "partition_dates") == [
        ("SKIPPED", 0, "")
    ]


def test_failure_is_logged_and_raised(spark, roots):
    raw, out, ledger, _ = roots
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        conforming.run(spark, raw, out, ledger, [SPEC])
    row = read_ledger(spark, ledger).first()
    assert (row.status, row.row_count, row.partition_dates) == ("FAILED", None, None)
    assert "PATH_NOT_FOUND" in row.error_message


def test_bounded_run_without_raw_partitions_filters_the_parsed_day(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(1, 1), raw_day(2, 2)], partitioned=False)
    report = conforming.run(spark, raw, out, ledger, [SPEC], "2026-05-02", "2026-05-02")[1]
    assert (report.rows, report.days) == (1, ("2026-05-02",))


def test_plain_date_column_is_gathered_by_day(spark, roots):
    """Many small tasks that each hold every day still give one file per day."""
    raw, out, ledger, _ = roots
    rows = [raw_day(i, 1 + i % 3) for i in range(60)]
    columns = [
        "k", "AccountId", "SiteId", "HouseIdSet", "LocalDateTime", "v", "beltids",
        "linenmbr", "distancedonepercent", "eggsincrease", "date",
    ]
    path = conforming.table_path(raw, 1)
    spark.createDataFrame(rows, columns).repartition(6).write.parquet(path)
    assert not laid_out_by(spark, path, "date")
    conforming.run(spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-02")
    held = partition_inventory(spark, conforming.table_path(out, 1))
    assert rows_of(held.select("day", "files")) == [("2026-05-01", 1), ("2026-05-02", 1)]


def test_backfill_loads_only_open_days_and_leaves_no_gap(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(k, k) for k in (1, 2, 3, 5)])
    conforming.run(spark, raw, out, ledger, [SPEC], "2026-05-02", "2026-05-03")
    write_raw(spark, raw, [raw_day(9, 3)])  # late, but its day is vouched for
    report = conforming.backfill(
        spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-06"
    )[1]
    assert report.days == ("2026-05-01", "2026-05-05")
    left = conforming.plan_backfill(spark, out, ledger, [1], "2026-05-01", "2026-05-06")
    assert [r.day for r in left.orderBy("day").collect()] == ["2026-05-04", "2026-05-06"]
    again = conforming.backfill(
        spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-06"
    )[1]
    assert again.status == "SKIPPED"
    kept = read_layer(spark, conforming.table_path(out, 1))
    assert rows_of(kept.select("k")) == [(1,), (2,), (3,), (5,)]
    modes = ledger_rows(spark, ledger, "is_backfill", "write_mode", "status")
    assert (True, "merge", "SUCCESS") in modes and (True, "merge", "SKIPPED") in modes


def test_complete_table_is_not_run_at_all(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(1, 1)])
    conforming.run(spark, raw, out, ledger, [SPEC])
    assert conforming.backfill(
        spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-01"
    ) == {}


def test_forced_backfill_replaces(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(1, 1), raw_day(2, 1)])
    conforming.run(spark, raw, out, ledger, [SPEC])
    write_raw(spark, raw, [raw_day(3, 1)], mode="overwrite")
    conforming.backfill(
        spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-01", forced=[1]
    )
    kept = read_layer(spark, conforming.table_path(out, 1))
    assert rows_of(kept.select("k")) == [(3,)]
    assert (True, "overwrite") in ledger_rows(spark, ledger, "is_backfill", "write_mode")


def fixture_ledger(spark):
    rows = [
        (1, "SUCCESS", "2024-01-01, 2024-01-02,"),
        (1, "FAILED", "2024-01-03"),
        (2, "SUCCESS", "2024-01-04"),
        (3, "SUCCESS", None),
        (1, "SUCCESS", ""),
        (1, "SKIPPED", "2024-01-05"),
    ]
    return literal_rows(
        spark,
        [
            dict.fromkeys(LEDGER_SCHEMA.names)
            | {"run_id": "r", "dataset": f"table_{t}"}
            | {"table_id": t, "status": s, "partition_dates": d}
            for t, s, d in rows
        ],
        LEDGER_SCHEMA,
    )


def test_done_days_and_gaps(spark):
    ledger = fixture_ledger(spark)
    existing = spark.createDataFrame(
        [(1, "2024-01-06"), (3, "2024-01-01"), (3, None)], "table_id int, day string"
    )
    done = done_days(ledger, existing)
    assert rows_of(done) == [
        (1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-04"), (3, "2024-01-01"),
    ]
    tables = spark.createDataFrame(
        [(1, "2024-01-01", "2024-01-06"), (2, "2024-01-05", "2024-01-04")],
        "table_id int, first string, last string",
    )
    wanted = wanted_days(tables, "first", "last")
    assert rows_of(missing_days(wanted, done)) == [
        (1, f"2024-01-0{d}", False) for d in (3, 4, 5, 6)
    ]
    forced = missing_days(wanted, done, forced=[1])
    assert rows_of(forced) == [(1, f"2024-01-0{d}", True) for d in range(1, 7)]


def test_old_ledger_rows_vouch_for_days_on_disk(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(1, 1)])
    conforming.run(spark, raw, out, roots[3], [SPEC])
    literal_rows(
        spark,
        [
            dict.fromkeys(LEDGER_SCHEMA.names)
            | {"run_id": "r", "dataset": "table_1", "table_id": 1, "status": "SUCCESS"}
        ],
        LEDGER_SCHEMA,
    ).write.parquet(ledger)
    left = conforming.plan_backfill(spark, out, ledger, [1], "2026-05-01", "2026-05-02")
    assert rows_of(left) == [(1, "2026-05-02", False)]


def test_ledger_in_the_catalog(spark, roots):
    raw, out, _, _ = roots
    ledger = "tierflow_test_ledger"
    spark.sql(f"drop table if exists {ledger}")
    write_raw(spark, raw, [raw_day(1, 1), raw_day(2, 2)])
    conforming.run(spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-01")
    conforming.backfill(spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-02")
    assert ledger_rows(spark, ledger, "partition_dates", "is_backfill") == [
        ("2026-05-01", False),
        ("2026-05-02", True),
    ]
    assert spark.table(ledger).schema.simpleString() == LEDGER_SCHEMA.simpleString()


def test_absent_ledger_vouches_for_nothing(spark, roots):
    assert done_days(read_ledger(spark, roots[2])).count() == 0
    assert read_ledger(spark, "no_such_ledger_table").count() == 0


def test_publish_run(spark, roots, lookups):  # noqa: F811
    raw, out, ledger, published = roots
    rows = [raw_day(k, k) for k in (1, 2, 3)]
    # Stored under day 2, though its local day is the third.
    rows.append(raw_day(4, 2, at="2026-05-03T00:10:00Z"))
    write_raw(spark, raw, rows)
    conforming.run(spark, raw, out, ledger, [SPEC])
    reports = publishing.run(
        spark, out, published, ledger, [SPEC], lookups, "2026-05-03", "2026-05-03", NOON
    )
    daily = publishing.DAILY_DATASET.format(1)
    assert {name: (r.rows, r.days) for name, r in reports.items()} == {
        daily: (2, ("2026-05-03",)),
        publishing.LONG_DATASET: (1, ("2026-05-03",)),
        publishing.WIDE_DATASET: (1, ("2026-05-03",)),
    }
    stats = read_layer(spark, f"{published}/{daily}", day_column="Date")
    # The fan-out gives two rows; each holds both records of the third.
    assert rows_of(stats.select("Date", "row_count", "v_mean", "SiteName")) == [
        ("2026-05-03", 2, 3.0, "Site 1"),
        ("2026-05-03", 2, 3.0, "Site 7"),
    ]
    wide = read_layer(spark, f"{published}/{publishing.WIDE_DATASET}", day_column="Date")
    assert rows_of(wide.select("Date", "pos_040", "pos_041")) == [("2026-05-03", 1.5, None)]
    publishing.run(spark, out, published, ledger, [SPEC], lookups, as_of=NOON)
    stats = read_layer(spark, f"{published}/{daily}", day_column="Date")
    assert stats.agg(F.sum("row_count")).first()[0] == 8
    logged = ledger_rows(spark, ledger, "dataset", "status")
    assert logged.count((publishing.WIDE_DATASET, "SUCCESS")) == 2


def test_empty_publish_is_skipped_in_the_ledger(spark, roots, lookups):  # noqa: F811
    raw, out, ledger, published = roots
    write_raw(spark, raw, [raw_day(1, 1)])
    conforming.run(spark, raw, out, ledger, [SPEC])
    reports = publishing.run(
        spark, out, published, ledger, [SPEC], lookups, "2026-06-01", "2026-06-01", NOON
    )
    assert {r.status for r in reports.values()} == {"SKIPPED"}


def test_matrix_failure_is_logged(spark, roots, lookups):  # noqa: F811
    raw, out, ledger, published = roots
    write_raw(spark, raw, [raw_day(1, 1)], table_id=2)
    spec = TableSpec(2, SPEC.columns, SPEC.metrics)
    conforming.run(spark, raw, out, ledger, [spec])
    with pytest.raises(Exception):
        publishing.run(spark, out, published, ledger, [spec], lookups, as_of=NOON)
    failed = [r for r in ledger_rows(spark, ledger, "dataset", "status") if r[1] == "FAILED"]
    assert failed == [(publishing.LONG_DATASET, "FAILED")]


def test_published_days_do_not_count_as_loaded(spark, roots, lookups):  # noqa: F811
    raw, out, ledger, published = roots
    rows = [raw_day(1, 2), raw_day(2, 2, at="2026-05-03T00:10:00Z"), raw_day(3, 3), raw_day(4, 3)]
    write_raw(spark, raw, rows)
    conforming.run(spark, raw, out, ledger, [SPEC], "2026-05-02", "2026-05-02")
    publishing.run(spark, out, published, ledger, [SPEC], lookups, as_of=NOON)
    conforming.backfill(spark, raw, out, ledger, [SPEC], "2026-05-02", "2026-05-03")
    assert read_layer(spark, conforming.table_path(out, 1)).count() == 4


def test_rows_published_late_keep_their_day_whole(spark, roots, lookups):  # noqa: F811
    raw, out, ledger, published = roots
    late = raw_day(2, 6, at="2026-05-03T10:00:00Z")
    write_raw(spark, raw, [raw_day(1, 3), late, raw_day(3, 9)])
    conforming.run(spark, raw, out, ledger, [SPEC])
    daily = f"{published}/{publishing.DAILY_DATASET.format(1)}"
    for window in ((), ("2026-05-03", "2026-05-03")):
        publishing.run(spark, out, published, ledger, [SPEC], lookups, *window, as_of=NOON)
        stats = read_layer(spark, daily, day_column="Date").filter("Date = '2026-05-03'")
        assert {r.row_count for r in stats.collect()} == {2}
    path = conforming.table_path(out, 1)
    held = partitions_holding(spark, path, "2026-05-03", "2026-05-03")
    assert held == ["2026-05-03", "2026-05-06"]
    # A day written since the note was taken is read in any case.
    replace_partitions(
        read_layer(spark, path, "2026-05-09", "2026-05-09").checkpoint(), path
    )
    assert "2026-05-09" in partitions_holding(spark, path, "2026-05-03", "2026-05-03")


def test_a_late_row_in_another_directory_does_not_replace_its_day(spark, roots):
    raw, out, ledger, _ = roots
    columns = "k string, AccountId string, SiteId string, LocalDateTime string, v string, PartitionDate string, date string"
    rows = [
        ("1", "1", "3", "2026-05-01T10:00:00Z", "1", "2026-05-01", "2026-05-01"),
        ("2", "1", "3", "2026-05-01T10:00:00Z", "1", "2026-05-01", "2026-05-01"),
        ("3", "1", "3", "2026-05-01T10:00:00Z", "1", "2026-05-01", "2026-05-02"),
        ("4", "1", "3", "2026-05-02T10:00:00Z", "1", "2026-05-02", "2026-05-02"),
    ]
    frame = spark.createDataFrame(rows, columns)
    frame.write.partitionBy("date").parquet(conforming.table_path(raw, 1))
    for day in ("2026-05-01", "2026-05-02"):
        conforming.run(spark, raw, out, ledger, [SPEC], day, day)
    kept = read_layer(spark, conforming.table_path(out, 1))
    assert rows_of(kept.select("k", "PartitionDate")) == [
        (1, "2026-05-01"), (2, "2026-05-01"), (3, "2026-05-01"), (4, "2026-05-02"),
    ]


def test_a_skipped_first_load_and_then_a_merge(spark, roots):
    raw, out, ledger, _ = roots
    write_raw(spark, raw, [raw_day(1, 1), raw_day(2, 2)])
    first = conforming.run(spark, raw, out, ledger, [SPEC], "2026-06-01", "2026-06-02")
    assert rows_of(first.verified) == [("table_1", 0, [])]
    then = conforming.backfill(spark, raw, out, ledger, [SPEC], "2026-05-01", "2026-05-02")
    assert rows_of(then.verified) == [("table_1", 2, ["2026-05-01", "2026-05-02"])]
