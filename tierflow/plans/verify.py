"""What the outputs hold. Ids: INC-9, AGG-9, SRC-12."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.scans import dataset_exists, literal_rows, read_layer


class Reports(dict):
    """Write reports by dataset, and in ``verified`` what the outputs hold, lazily."""

    def __init__(self, reports: Mapping, verified: DataFrame):
        super().__init__(reports)
        self.verified = verified


_DATASET = T.StructType([T.StructField("dataset", T.StringType())])
_DAYS = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


def output_days(
    spark: SparkSession, outputs: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """``(dataset, day, rows)`` of every output that exists.

    ``outputs`` maps a name to its path and day column.  Only partition columns
    are read, so row counts come from file footers.
    """
    counted = [
        read_layer(spark, path, day_column=day)
        .groupBy(F.col(day).cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("dataset"), "day", "rows")
        for name, (path, day) in outputs.items()
        if dataset_exists(spark, path)
    ]
    return reduce(DataFrame.union, counted, literal_rows(spark, [], _DAYS))


def verify_outputs(
    spark: SparkSession, outputs: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """One row per output: rows and sorted days; a missing one has zero rows."""
    names = literal_rows(spark, [{"dataset": name} for name in outputs], _DATASET)
    found = (
        output_days(spark, outputs)
        .groupBy("dataset")
        .agg(
            F.sum("rows").alias("row_count"),
            F.array_sort(F.collect_list("day")).alias("days"),
        )
    )
    return names.join(found, "dataset", "left").select(
        "dataset",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("days", F.array().cast("array<string>")).alias("days"),
    )
