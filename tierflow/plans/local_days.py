"""Which partitions hold rows of which local days. Id: INC-12.

Files lie by partition day, statistics are by event-local day, and a row may be stored
any number of days late.  Writers report the first and last local day of every partition
they write; a note beside the dataset keeps them with a fingerprint of the partition's
files, their names and lengths.  A partition whose files are others by now, or that has
no entry, is simply read, so a stale note costs time only.  Nothing is made of directory
times, which stores may hold constant.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierflow.functions.days import Day, iso
from tierflow.sources.scans import partition_files, read_note, write_note

NOTE = "_local_days.json"


def fingerprints(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition days with a fingerprint of their files, from the listing alone."""
    listed = partition_files(spark, path).groupBy("day").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64("name", "length")).alias("names"),
    )
    return {r.day: f"{r.files}-{r.bytes}-{r.names}" for r in listed.collect()}


def note_local_days(
    spark: SparkSession,
    path: str,
    local_days: Iterable[tuple[str, str | None, str | None]],
) -> None:
    """Note the first and last local day of the days just written."""
    local_days = list(local_days)
    if not local_days:
        return
    marks = fingerprints(spark, path)
    noted = read_note(spark, f"{path}/{NOTE}") or {}
    noted |= {day: [marks.get(day), first, last] for day, first, last in local_days}
    held = {day: entry for day, entry in noted.items() if day in marks}
    write_note(spark, f"{path}/{NOTE}", held)


def partitions_holding(
    spark: SparkSession, path: str, first: Day | None, last: Day | None
) -> list[str]:
    """Partition days that hold, or may hold, rows of local days in the window."""
    noted = read_note(spark, f"{path}/{NOTE}") or {}

    def may_hold(day: str, mark: str) -> bool:
        known, low, high = noted.get(day, (None, None, None))
        if known != mark:
            return True
        if low is None:  # no row of it has a local day
            return False
        after = first is None or high >= iso(first)
        return after and (last is None or low <= iso(last))

    held = fingerprints(spark, path)
    return sorted(day for day, mark in held.items() if may_hold(day, mark))
