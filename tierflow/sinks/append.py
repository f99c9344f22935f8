"""Append to a dataset path or a catalog table, and compaction. Id: SNK-8."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tierflow.sinks.swap import delete, exists
from tierflow.sources.scans import children


def append_to_table(frame: DataFrame, name: str, fmt: str = "parquet") -> None:
    frame.write.format(fmt).mode("append").saveAsTable(name)


def append_to_path(frame: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add a directory of its own below ``path``.

    Writers that run at the same time then share no working directory, which the
    first one to finish would clear away from under the others.
    """
    frame.write.format(fmt).save(f"{path}/{uuid.uuid4().hex}")


def compact_path(spark: SparkSession, path: str, most: int) -> bool:
    """Put the rows of more than ``most`` appended directories into one; True if done.

    Only directories whose write has committed are taken, and only they are deleted, after
    the new one has committed: an append that runs meanwhile is not touched.  A death in
    between leaves rows twice, so readers of a compacted path drop equal rows, and so does
    the next compaction.  Two compactions at once fail or repeat rows, and lose none.
    """
    done = [d for d in children(spark, path) if exists(spark, f"{d}/_SUCCESS")]
    if len(done) <= most:
        return False
    rows = spark.read.parquet(*done).dropDuplicates()
    append_to_path(rows.coalesce(1), path)
    for directory in done:
        delete(spark, directory)
    return True
