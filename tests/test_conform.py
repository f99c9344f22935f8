from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import types as T

from tests.conftest import plan_of
from tierflow.operators.conform import conform, with_lineage, with_partition_day
from tierflow.sources.declared import TableSpec, read_table_spec, spark_type
from tierflow.sources.scans import optional_column, preview, read_lookup_csv, read_raw


def test_declared_columns_join_and_the_table_wins():
    spec = TableSpec.from_config(
        3,
        {"a": "Int8", "b": "Utf8"},
        {
            "schema": {"a": "Int64", "c": "Datetime"},
            "numeric_columns": ["a", "z"],
            "aggregation_map": {"a": "sum"},
            "merge_keys": ["a"],
            "flag_columns": ["ignored"],
        },
    )
    assert spec.columns == {
        "a": T.LongType(),
        "b": T.StringType(),
        "c": T.TimestampType(),
    }
    assert dict(spec.metrics) == {"a": "sum", "z": "mean"}
    assert spec.merge_keys == ("a",)


def test_unknown_type_name_fails_when_declared():
    with pytest.raises(ValueError, match="Decimal"):
        spark_type("Decimal")


def test_read_table_spec(spark, tmp_path):
    files = {
        "table_metadata": {"tables": {"5": {"source_system": "farm"}}},
        "base_schema": {"a": "Utf8"},
        "table_5": {"schema": {"b": "Int32"}, "numeric_columns": ["b"]},
    }
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=1))
    spec = read_table_spec(spark, str(tmp_path), 5)
    assert (spec.source_system, list(spec.columns)) == ("farm", ["a", "b"])


def test_conform_converts_declared_and_keeps_the_rest(spark):
    raw = spark.createDataFrame(
        [("2026-05-09T10:00:00Z", "2026-05-09", "300", "7", 1.5, "as is")],
        "at string, on string, tiny string, n string, same double, extra string",
    )
    declared = {
        "at": T.TimestampType(),
        "on": T.DateType(),
        "tiny": T.ByteType(),
        "n": T.IntegerType(),
        "same": T.DoubleType(),
        "absent": T.StringType(),
    }
    out = conform(raw, declared, rejects="bad")
    assert out.columns == [*raw.columns, "bad"]
    assert out.first()[:] == (
        datetime(2026, 5, 9, 10),
        date(2026, 5, 9),
        None,
        7,
        1.5,
        "as is",
        1,
    )


def test_conform_counts_only_values_that_fail(spark):
    raw = spark.createDataFrame(
        [(None, None), ("x", "y"), ("1", "bad")], "n string, at string"
    )
    out = conform(raw, {"n": T.LongType(), "at": T.TimestampType()}, rejects="bad")
    assert [r.bad for r in out.collect()] == [0, 2, 1]


def test_conform_zone_free_timestamp(spark):
    raw = spark.sql("select timestamp_ntz'2026-05-09 10:00:00' as at")
    out = conform(raw, {"at": T.TimestampType()})
    assert out.schema["at"].dataType == T.TimestampType()
    assert out.first().at == datetime(2026, 5, 9, 10)


@pytest.mark.parametrize(
    "kind, literal",
    [
        ("string", "'2026-05-09'"),
        ("string", "'2026-05-09T23:30:00Z'"),
        ("date", "date'2026-05-09'"),
        ("timestamp", "timestamp'2026-05-09 23:30:00'"),
        ("timestamp_ntz", "timestamp_ntz'2026-05-09 23:30:00'"),
    ],
)
def test_partition_day_from_every_type(spark, kind, literal):
    raw = spark.sql(f"select {literal} as PartitionDate")
    assert with_partition_day(raw).first()[:] == ("2026-05-09", 2026, 5)


def test_partition_day_falls_back_to_date_and_drops_bad_rows(spark):
    raw = spark.createDataFrame([("2026-05-09",), ("bad",), (None,)], "date string")
    out = with_partition_day(raw)
    assert [r[:] for r in out.collect()] == [("2026-05-09", "2026-05-09", 2026, 5)]


def test_partition_day_needs_a_column(spark):
    with pytest.raises(ValueError):
        with_partition_day(spark.range(1))


def test_lineage(spark, path):
    spark.range(2).write.parquet(path)
    now = datetime(2026, 5, 9, 23, 30, tzinfo=timezone.utc)
    row = with_lineage(spark.read.parquet(path).filter("id = 1"), 4, as_of=now).first()
    assert row.source_table_id == 4
    assert row.source_system == "unknown"
    assert row.source_file_path.endswith(".parquet")
    assert row.ingestion_date == "2026-05-09"
    # 23:30 UTC is the next local day, which shows the day is the UTC one.
    assert row.ingested_at_utc == datetime(2026, 5, 10, 1, 30)


def test_raw_scan_prunes_partitions(spark, path):
    days = spark.createDataFrame([(i, f"2026-05-0{i}") for i in range(1, 6)], "i int, date string")
    days.write.partitionBy("date").parquet(path)
    listed = read_raw(spark, path, first="2026-05-05", days=["2026-05-02", "2026-05-04"])
    assert sorted(r.i for r in listed.collect()) == [2, 4]
    window = read_raw(spark, path, "2026-05-02", "2026-05-03")
    assert sorted(r.i for r in window.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(date" in plan_of(window)


def test_lookup_csv_is_all_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Id,Name\n007,Hen\n,\n")
    frame = read_lookup_csv(spark, str(tmp_path / "a.csv"))
    assert frame.dtypes == [("Id", "string"), ("Name", "string")]
    assert [r[:] for r in frame.collect()] == [("007", "Hen"), (None, None)]


def test_optional_column_and_preview(spark):
    frame = spark.range(30)
    assert frame.select(optional_column(frame, "none").alias("c")).first().c is None
    top = preview(frame, ["id"])
    assert [r.id for r in top.collect()] == list(range(10))
    assert "TakeOrderedAndProject" in plan_of(top)
