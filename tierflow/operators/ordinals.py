"""Positions and running totals in groups of any size. Ids: WIN-1, WIN-2, SRT-4.

A window over a group sorts all of it in one task.  Here the rows are cut at quantiles of
their whole order into range partitions, written to the shared folder so that the cut
stands; a large group then covers many of these slices.  Each slice is totalled apart and
shifted by what the group holds in the slices before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.sinks.scratch import scratch_path

_SLICE = "__slice"
_COPIES = "__copies"
_BEFORE = "__before"
_NTH = "__nth"


def running_totals(
    frame: DataFrame,
    group: list[str],
    order: list[Column],
    sums: Mapping[str, Column] | None = None,
    xors: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows with totals over the rows before them in their group, by name.

    ``sums`` are added up and ``xors`` combined by exclusive or, both 64-bit integers.
    ``order`` should tell the rows of a group apart: rows it does not fall into one
    slice.  A NULL group is a group.
    """
    spark, columns = frame.sparkSession, frame.columns
    measured = {name: F.sum for name in sums or {}} | {
        name: F.bit_xor for name in xors or {}
    }
    expressions = {
        f"__{name}": F.coalesce(value.cast("bigint"), F.lit(0))
        for name, value in {**(sums or {}), **(xors or {})}.items()
    }
    placed = (
        frame.withColumns(expressions)
        .repartitionByRange(*[F.col(c) for c in group], *order)
        .withColumn(_SLICE, F.spark_partition_id())
    )
    path = scratch_path(spark, "ordinals")
    placed.write.parquet(path)
    sliced = spark.read.schema(placed.schema).parquet(path)

    keys = [*group, _SLICE]
    ahead = Window.partitionBy(*group).orderBy(_SLICE)
    # A slice is a range, so only its first group can have begun in another one:
    # there are at most as many shifts as slices.
    shifts = (
        sliced.groupBy(*keys)
        .agg(*[made(f"__{name}").alias(f"__{name}") for name, made in measured.items()])
        .select(
            *[F.col(k).alias(f"{k}__s") for k in keys],
            *[
                made(f"__{name}")
                .over(ahead.rowsBetween(Window.unboundedPreceding, -1))
                .alias(f"__{name}__s")
                for name, made in measured.items()
            ],
            F.row_number().over(ahead).alias(_NTH),
        )
        .filter(F.col(_NTH) > 1)
        .drop(_NTH)
    )
    within = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totalled = sliced.withColumns(
        {f"__{name}__w": made(f"__{name}").over(within) for name, made in measured.items()}
    )
    same = [F.col(k).eqNullSafe(F.col(f"{k}__s")) for k in keys]
    shifted = totalled.join(F.broadcast(shifts), same, "left")

    def both(name: str, made) -> Column:
        here = F.coalesce(F.col(f"__{name}__w"), F.lit(0))
        before = F.coalesce(F.col(f"__{name}__s"), F.lit(0))
        total = here + before if made is F.sum else here.bitwiseXOR(before)
        return total.cast("bigint").alias(name)

    return shifted.select(
        *[c for c in columns if c not in measured],
        *[both(name, made) for name, made in measured.items()],
    )


def number_rows(
    frame: DataFrame, group: list[str], order: list[Column], name: str
) -> DataFrame:
    """Rows with their 1-based position in the group, every copy its own.

    Columns not named in ``order`` break its ties, which makes the numbering
    repeatable.  Copies of a whole row are counted first and unfolded at the end, so
    they cannot fill a slice.
    """
    columns = frame.columns
    ties = [F.col(c).asc_nulls_last() for c in columns]
    distinct = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias(_COPIES))
    placed = running_totals(
        distinct, group, [*order, *ties], sums={_BEFORE: F.col(_COPIES)}
    )
    unfolded = placed.withColumn(
        _NTH, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(_COPIES)))
    )
    return unfolded.select(
        *columns, (F.col(_BEFORE) + F.col(_NTH)).cast("int").alias(name)
    )
