"""Partitioned writes. Ids: SNK-1, SNK-2, SNK-4 to SNK-7, AGG-9, AGG-11, PRJ-12."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sinks.swap import finish_swap, note_swap, staging_path
from tierflow.sources.scans import (
    SCHEMA_NOTE,
    dataset_exists,
    known_schema,
    write_note,
)
from tierflow.sources.types import as_types, merged_schema

# Directory levels of the conformed and of the published layer.
CONFORMED_LAYOUT = ("year", "month", "PartitionDate")
PUBLISHED_LAYOUT = ("year", "month", "Date")


@dataclass(frozen=True)
class WriteReport:
    """What one write did, measured while it ran."""

    rows: int
    days: tuple[str, ...]
    seconds: float
    rejected: int = 0
    #: First and last event-local day by written day, where the writer was asked for them.
    local_days: tuple[tuple[str, str | None, str | None], ...] = ()

    @property
    def status(self) -> str:
        return "SUCCESS" if self.days else "SKIPPED"


def replace_partitions(
    frame: DataFrame,
    path: str,
    layout: tuple[str, ...] = CONFORMED_LAYOUT,
    rejected: str | None = None,
    gather: bool = True,
    fmt: str = "parquet",
    local_day: Callable[[DataFrame], Column] | None = None,
) -> WriteReport:
    """Overwrite exactly the days present in ``frame`` and keep all others.

    A swap that was interrupted is finished first.  A column may widen its type: files
    of the narrower one stay and are read as the wider one.  Any other change of a type is
    an error before a file is written.

    One job writes and counts.  Rows of a day are gathered by a rebalance, so
    file counts stay low while adaptive execution splits a day that outgrows
    the advisory partition size over several tasks.  Metrics are observed above
    that shuffle: below it an empty input would lose them.  Rows that arrive day
    by day already, as from a scan of daily directories, need no ``gather``:
    every task then writes its own few days and nothing is shuffled.

    ``rejected`` names a per-row count that is summed and not written; ``local_day``
    gives a row's event-local day, of which each day's first and last are reported.
    """
    spark, day = frame.sparkSession, layout[-1]
    finish_swap(spark, path)
    held = schema = None
    if fmt == "parquet":
        held = _held_schema(spark, path)
        schema = merged_schema(
            held or T.StructType(),
            (frame.drop(rejected) if rejected else frame).schema,
            layout if held else (),
        )
        frame = as_types(frame, schema)
    watch = Observation()
    placed = frame.hint("rebalance", F.col(day)) if gather else frame
    # A day holds rows of few local days: what is collected is a row or two per day.
    local = local_day(placed).cast("string") if local_day else F.lit(None)
    spread = placed.observe(
        watch,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.col(day)).alias("days"),
        F.collect_set(
            F.when(local.isNotNull(), F.struct(F.col(day).alias("day"), local.alias("local")))
        ).alias("local_days"),
        F.coalesce(F.sum(F.col(rejected) if rejected else F.lit(0)), F.lit(0)).alias(
            "rejected"
        ),
    )
    if rejected:
        spread = spread.drop(rejected)
    if held is not None and schema != held:
        # Old files can be read as the wider schema, new ones not as the narrower.
        write_note(spark, f"{path}/{SCHEMA_NOTE}", schema.jsonValue())
    started = time.monotonic()
    (
        spread.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("mergeSchema", True)
        .partitionBy(*layout)
        .save(path)
    )
    seen = watch.get
    if held is None and schema is not None and seen["days"]:
        write_note(spark, f"{path}/{SCHEMA_NOTE}", schema.jsonValue())
    return WriteReport(
        rows=seen["rows"],
        days=tuple(sorted(seen["days"])),
        seconds=time.monotonic() - started,
        rejected=seen["rejected"],
        local_days=_spans(seen["days"], seen["local_days"]) if local_day else (),
    )


def _spans(days, pairs) -> tuple[tuple[str, str | None, str | None], ...]:
    """First and last local day of every day; none where no row has one."""
    held: dict[str, list[str]] = {day: [] for day in days}
    for pair in pairs:
        held[pair["day"]].append(pair["local"])
    return tuple(
        (day, min(local, default=None), max(local, default=None))
        for day, local in sorted(held.items())
    )


def _held_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The dataset's schema, None where there is no dataset."""
    held = known_schema(spark, path)
    if held is None and dataset_exists(spark, path):
        held = spark.read.option("mergeSchema", True).parquet(path).schema
    return held


def stage_days(
    frame: DataFrame,
    path: str,
    layout: tuple[str, ...],
    local_day: Callable[[DataFrame], Column] | None = None,
) -> WriteReport:
    """Write the days in ``frame`` beside the dataset and note them as its new ones.

    From the note on readers see them; ``finish_swap`` puts them into place.
    """
    staged = staging_path(path)
    report = replace_partitions(frame, staged, layout, local_day=local_day)
    if report.days:
        note_swap(frame.sparkSession, path, staged, len(layout))
    return report


def swap_days(
    frame: DataFrame,
    path: str,
    layout: tuple[str, ...],
    local_day: Callable[[DataFrame], Column] | None = None,
) -> WriteReport:
    """Replace the days in ``frame`` by way of a staged copy."""
    report = stage_days(frame, path, layout, local_day)
    finish_swap(frame.sparkSession, path)
    return report


def with_published_layout(frame: DataFrame) -> DataFrame:
    """Add ``year`` and ``month`` and turn ``Date`` into ISO text."""
    return frame.withColumns(
        {
            "year": F.year("Date"),
            "month": F.month("Date"),
            "Date": F.date_format("Date", "yyyy-MM-dd"),
        }
    )


def publish(
    frame: DataFrame, path: str, fmt: str = "parquet", gather: bool = True
) -> WriteReport:
    """Write a published dataset: layout columns, then partition replacement."""
    return replace_partitions(
        with_published_layout(frame), path, PUBLISHED_LAYOUT, gather=gather, fmt=fmt
    )


def distinct_days(frame: DataFrame, column: str | Column) -> DataFrame:
    """Distinct days of a column as ISO text, sorted."""
    value = F.col(column) if isinstance(column, str) else column
    return (
        frame.select(F.date_format(value, "yyyy-MM-dd").alias("day"))
        .filter(F.col("day").isNotNull())
        .distinct()
        .orderBy("day")
    )
