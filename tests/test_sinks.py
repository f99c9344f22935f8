from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tierflow.operators.conform import with_partition_day
from tierflow.plans.verify import verify_outputs
from tierflow.sinks.append import append_to_path
from tierflow.sinks.partitions import distinct_days, publish, replace_partitions
from tierflow.sinks.scratch import scratch_path, scratch_root
from tierflow.sinks.upsert import upsert
from tierflow.sources.scans import (
    dataset_exists,
    known_schema,
    partition_inventory,
    read_layer,
)


def layer(spark, rows, columns="k int, v string"):
    """Rows ending in a day number of May 2026."""
    frame = spark.createDataFrame(rows, f"{columns}, day int")
    day = F.format_string("2026-05-%02d", "day")
    return with_partition_day(frame.withColumn("PartitionDate", day)).drop("day")


def content(spark, path, *columns):
    columns = columns or ("k", "v", "PartitionDate")
    return rows_of(read_layer(spark, path).select(*columns))


def test_replace_touches_only_its_days(spark, path):
    first = replace_partitions(layer(spark, [(1, "a", 1), (2, "b", 2)]), path)
    assert (first.rows, first.days, first.status) == (2, ("2026-05-01", "2026-05-02"), "SUCCESS")
    again = layer(spark, [(3, "c", 2), (4, "d", 3)])
    for _ in range(2):
        replace_partitions(again, path)
        assert content(spark, path) == [
            (1, "a", "2026-05-01"),
            (3, "c", "2026-05-02"),
            (4, "d", "2026-05-03"),
        ]


def test_empty_write_is_skipped_and_changes_nothing(spark, path):
    replace_partitions(layer(spark, [(1, "a", 1)]), path)
    report = replace_partitions(layer(spark, [(1, "a", 1)]).filter("k > 5"), path)
    assert (report.rows, report.days, report.status) == (0, (), "SKIPPED")
    assert content(spark, path) == [(1, "a", "2026-05-01")]


def test_rejected_is_summed_and_not_written(spark, path):
    frame = layer(spark, [(1, "a", 1), (2, "b", 1)]).withColumn("bad", F.col("k"))
    assert replace_partitions(frame, path, rejected="bad").rejected == 3
    assert "bad" not in read_layer(spark, path).columns


def test_hot_day_is_split_and_small_days_are_not(spark, path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "100k")
    ids = spark.range(0, 200_000, 1, 8).select(
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 10 + 2).alias("day"),
    )
    day = F.format_string("2026-05-%02d", "day")
    replace_partitions(with_partition_day(ids.withColumn("PartitionDate", day)), path)
    files = {
        d: len(glob.glob(f"{path}/*/*/PartitionDate=2026-05-{d:02d}/*.parquet"))
        for d in (1, 2, 3)
    }
    assert files[1] > 3
    assert read_layer(spark, path).count() == 200_000


def test_evolved_column_reads_null_in_older_days(spark, path):
    replace_partitions(layer(spark, [(1, "a", 1)]), path)
    replace_partitions(layer(spark, [(2, "b", 2)]).withColumn("w", F.lit(5)), path)
    assert content(spark, path, "k", "w") == [(1, None), (2, 5)]


def test_inventory_lists_days_without_reading_them(spark, path):
    replace_partitions(layer(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 2)]), path)
    got = {r.day: (r.files, r.bytes > 0) for r in partition_inventory(spark, path).collect()}
    assert got == {"2026-05-01": (1, True), "2026-05-02": (1, True)}


def test_layer_scan_prunes(spark, path):
    replace_partitions(layer(spark, [(d, "x", d) for d in range(1, 9)]), path)
    scan = read_layer(spark, path, "2026-05-03", "2026-05-05")
    assert sorted(r.k for r in scan.collect()) == [3, 4, 5]
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    assert read_layer(spark, path, "2026-05-05", "2026-05-03").count() == 0


def test_publish_turns_the_day_into_layout_columns(spark, path):
    frame = spark.sql("select date'2026-05-09' as Date, 1 as n union all select null, 2")
    publish(frame.filter("Date is not null"), path)
    row = read_layer(spark, path, day_column="Date").first()
    assert (row.Date, row.year, row.month, row.n) == ("2026-05-09", 2026, 5, 1)
    assert rows_of(distinct_days(frame, "Date")) == [("2026-05-09",)]


KEYS = ["k"]


def test_upsert_rules(spark, path):
    target = layer(
        spark,
        [(1, "a", 1), (2, "b", 1), (None, "n", 1), (4, "d", 2), (4, "dd", 2), (9, "z", 3)],
    ).withColumn("only", F.concat(F.lit("t"), "v"))
    first = upsert(target, path, KEYS)
    assert first.rows == 6  # the first write does not deduplicate
    source = layer(spark, [(2, "B", 1), (3, "C", 1), (None, "N", 1), (4, "D", 2), (1, "E", 2)])
    report = upsert(source, path, KEYS)
    assert (report.rows, report.days) == (5, ("2026-05-01", "2026-05-02"))
    assert content(spark, path, "k", "v", "only", "PartitionDate") == sorted(
        [
            (1, "a", "ta", "2026-05-01"),
            (2, "B", "tb", "2026-05-01"),
            (3, "C", None, "2026-05-01"),
            (None, "n", "tn", "2026-05-01"),
            (None, "N", None, "2026-05-01"),
            (4, "D", "td", "2026-05-02"),
            (4, "D", "tdd", "2026-05-02"),
            (1, "E", None, "2026-05-02"),
            (9, "z", "tz", "2026-05-03"),
        ],
        key=repr,
    )


def test_upsert_twice_equals_once_for_complete_keys(spark, path):
    upsert(layer(spark, [(1, "a", 1)]), path, KEYS)
    source = layer(spark, [(1, "A", 1), (2, "B", 1), (3, "C", 4)])
    upsert(source, path, KEYS)
    once = content(spark, path)
    upsert(source, path, KEYS)
    assert content(spark, path) == once


def test_null_keys_insert_again_every_time(spark, path):
    source = layer(spark, [(None, "n", 1)])
    for expected in (1, 2, 3):
        upsert(source, path, KEYS)
        assert len(content(spark, path)) == expected


def test_repeated_source_keys(spark, path):
    """Repeats that match are an error and change nothing; others all go in."""
    upsert(layer(spark, [(1, "a", 1), (2, "b", 1)]), path, KEYS)
    before = content(spark, path)
    with pytest.raises(ValueError, match="several source rows"):
        upsert(layer(spark, [(1, "x", 1), (1, "y", 1)]), path, KEYS)
    assert content(spark, path) == before
    report = upsert(layer(spark, [(5, "x", 1), (5, "y", 1), (2, "B", 1), (None, "n", 1)]), path, KEYS)
    assert report.rows == 4
    assert content(spark, path, "k", "v") == sorted(
        [(1, "a"), (2, "B"), (5, "x"), (5, "y"), (None, "n")], key=repr
    )


def test_upsert_arguments(spark, path):
    source = layer(spark, [(1, "a", 1)])
    with pytest.raises(ValueError, match="merge keys"):
        upsert(source, path, [])
    with pytest.raises(ValueError, match="nope"):
        upsert(source, path, ["nope"])
    upsert(source, path, KEYS)
    with pytest.raises(ValueError, match="extra"):
        upsert(source.withColumn("extra", F.lit(1)), path, KEYS)
    assert upsert(source.filter("k > 5"), path, KEYS).status == "SKIPPED"


def test_upsert_casts_to_the_target_and_counts_rejects(spark, path):
    upsert(layer(spark, [(1, "a", 1)]), path, KEYS)
    source = layer(spark, [(1, "b", 1)]).withColumn("k", F.col("k").cast("bigint"))
    report = upsert(source.withColumn("bad", F.lit(2)), path, KEYS, rejected="bad")
    assert report.rejected == 2
    assert content(spark, path, "k", "v") == [(1, "b")]


def test_append_to_path_and_verify(spark, path):
    for _ in range(2):
        append_to_path(spark.sql("select 1 as n, 'x' as day"), path)
    held = spark.read.option("recursiveFileLookup", True).parquet(path)
    assert rows_of(held) == [(1, "x"), (1, "x")]
    spark.sql("select 1 as n, 'x' as day").write.parquet(f"{path}-one")
    outputs = {"there": (path + "-one", "day"), "gone": (path + "-no", "day")}
    got = verify_outputs(spark, outputs)
    assert rows_of(got) == [("gone", 0, []), ("there", 1, ["x"])]
    assert dataset_exists(spark, path) and not dataset_exists(spark, path + "-no")


def test_an_empty_write_is_no_dataset(spark, path):
    nothing = layer(spark, [(1, "a", 1)]).filter("k > 5")
    assert replace_partitions(nothing, path).status == "SKIPPED"
    assert not dataset_exists(spark, path)
    assert rows_of(verify_outputs(spark, {"x": (path, "PartitionDate")})) == [("x", 0, [])]
    assert upsert(layer(spark, [(1, "a", 1)]), path, ["k"]).rows == 1
    assert content(spark, path) == [(1, "a", "2026-05-01")]


def test_schema_is_noted_and_no_footer_read_before_the_action(spark, path):
    replace_partitions(layer(spark, [(1, "a", 1)]), path)
    replace_partitions(layer(spark, [(2, "b", 2)]).withColumn("w", F.lit(5)), path)
    assert {"k", "v", "w", "PartitionDate"} <= set(known_schema(spark, path).names)
    spark.sparkContext.setJobGroup("reading", "reading")
    one = read_layer(spark, path, "2026-05-02", "2026-05-02")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("reading")
    assert [r.k for r in one.collect()] == [2] and len(one.inputFiles()) == 2
    spark.sparkContext.setJobGroup("other", "other")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def test_upsert_reads_its_source_once(spark, path):
    upsert(layer(spark, [(1, "a", 1)]), path, KEYS)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = layer(spark, [(1, "A", 1), (2, "B", 1)])
    upsert(source.mapInArrow(count, source.schema), path, KEYS)
    assert seen.value == 2


def test_scratch_uses_the_session_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == named
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
