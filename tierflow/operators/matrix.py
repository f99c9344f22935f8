"""Daily position matrices, long and wide. Ids: AGG-7, AGG-8, SRT-2."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.parsing import event_day
from tierflow.functions.position import BIN_COUNT, bin_label, cell_value, position_bin
from tierflow.sources.scans import require_columns

# Row keys of both matrices.
MATRIX_KEYS = ("Date", "AccountId", "SiteId", "HouseIdSet", "beltids", "linenmbr")


def matrix_long(telemetry: DataFrame) -> DataFrame:
    """Summed increments and sample counts per row key and position bin.

    Both aggregates combine on the map side, so a hot belt shuffles one row per
    task and bin.
    """
    raw = (*MATRIX_KEYS[1:], "distancedonepercent", "eggsincrease")
    require_columns(telemetry, raw, "the position telemetry")
    cells = telemetry.select(
        event_day(telemetry.schema).alias("Date"),
        *MATRIX_KEYS[1:],
        position_bin("distancedonepercent").alias("position_bin"),
        cell_value("eggsincrease").alias("cell_value"),
    ).filter(
        F.col("Date").isNotNull()
        & F.col("linenmbr").isNotNull()
        & F.col("position_bin").isNotNull()
    )
    return cells.groupBy(*MATRIX_KEYS, "position_bin").agg(
        F.sum("cell_value").alias("eggsincrease_sum"),
        F.count(F.lit(1)).alias("sample_count"),
    )


_PART = "__part"
#: Steps in which a key's hash tells its place among the parts of its day.
_STEPS = 1 << 30
#: Days of less than this share of a part are dealt out whole, by their hash.
_SMALL = 1 / 8


def _placed(long: DataFrame, parts: Mapping[str, float]) -> DataFrame:
    """The rows in parts that a task takes each, the larger days one after another."""
    large = {day: float(size) for day, size in parts.items() if size >= _SMALL}
    count = ceil(sum(large.values()))
    rest = max(1, ceil(sum(size for size in parts.values() if size < _SMALL)))
    part = F.lit(count) + F.pmod(F.xxhash64("Date"), F.lit(rest))
    if large:
        starts = accumulate(large.values(), initial=0.0)
        spans = F.create_map(
            *[
                column
                for (day, size), start in zip(large.items(), starts)
                for column in (
                    F.lit(day),
                    F.struct(F.lit(start).alias("start"), F.lit(size).alias("size")),
                )
            ]
        )
        span = F.try_element_at(spans, F.col("Date").cast("string"))
        share = F.pmod(F.xxhash64(*MATRIX_KEYS[1:]), F.lit(_STEPS)) / F.lit(_STEPS)
        own = F.floor(span["start"] + share * span["size"])
        part = F.coalesce(own, part)
    placed = long.withColumn(_PART, part.cast("int"))
    return placed.repartitionById(count + rest, _PART)


def matrix_wide(long: DataFrame, parts: Mapping[str, float] | None = None) -> DataFrame:
    """One row per key with a column for each of the 100 bins, NULL where empty.

    Takes the long matrix: it holds at most one row per key and bin, so a key
    never gathers more than 100 rows.  Those narrow rows are brought together
    by key once; without that the pivot would shuffle partial rows of 100
    columns each.  The bins are stated, so no job looks for them.

    With ``parts`` a day's keys are spread over as many tasks as are stated, and days of
    less than one share tasks; a day that is not named comes together in one of them.
    The wide rows can then be written by day as they are.
    """
    if parts is None:
        # Stated, so that adaptive execution does not put narrow rows into fewer tasks.
        count = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        gathered, keys = long.repartition(count, *MATRIX_KEYS), MATRIX_KEYS
    else:
        gathered, keys = _placed(long, parts), (_PART, *MATRIX_KEYS)
    pivoted = (
        gathered.groupBy(*keys)
        .pivot("position_bin", list(range(BIN_COUNT)))
        .agg(F.sum("eggsincrease_sum"))
    )
    return pivoted.select(
        *MATRIX_KEYS,
        *[F.col(f"`{i}`").alias(bin_label(i)) for i in range(BIN_COUNT)],
    )


def for_display(matrix: DataFrame) -> DataFrame:
    """Global presentation order by the row keys (and bin); writes do without it."""
    bins = [c for c in ("position_bin",) if c in matrix.columns]
    return matrix.orderBy(*MATRIX_KEYS, *bins)
