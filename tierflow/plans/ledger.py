"""Run ledger. Ids: SNK-8, INC-3, INC-7, INC-8, SET-2, FN-15.

One schema serves both layers.  A ledger row is appended only after its write
has committed, so a day that is not logged counts as not done.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.days import Day, iso, listed_days
from tierflow.sinks.append import append_to_path, append_to_table, compact_path
from tierflow.sinks.partitions import WriteReport
from tierflow.sources.scans import dataset_exists, literal_rows

# Fields of a ledger row.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("dataset", T.StringType(), False),
        T.StructField("table_id", T.IntegerType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at_utc", T.TimestampType(), True),
        T.StructField("finished_at_utc", T.TimestampType(), True),
        T.StructField("from_date", T.StringType(), True),
        T.StructField("to_date", T.StringType(), True),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("partition_count", T.IntegerType(), True),
        T.StructField("partition_dates", T.StringType(), True),
        T.StructField("is_backfill", T.BooleanType(), True),
        T.StructField("write_mode", T.StringType(), True),
        T.StructField("write_duration_seconds", T.DoubleType(), True),
        T.StructField("error_message", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class RunContext:
    """What all ledger rows of one run share."""

    run_id: str
    ledger: str
    first: Day | None = None
    last: Day | None = None
    is_backfill: bool = False


def ledger_row(
    run: RunContext,
    dataset: str,
    table_id: int | None,
    write_mode: str,
    started: datetime,
    finished: datetime,
    report: WriteReport | None = None,
    error: BaseException | None = None,
) -> dict:
    """A row of a finished or failed step; counts of a failed one are NULL."""
    done = report is not None and error is None
    return {
        "run_id": run.run_id,
        "dataset": dataset,
        "table_id": table_id,
        "status": report.status if done else "FAILED",
        "started_at_utc": started,
        "finished_at_utc": finished,
        "from_date": None if run.first is None else iso(run.first),
        "to_date": None if run.last is None else iso(run.last),
        "row_count": report.rows if done else None,
        "partition_count": len(report.days) if done else None,
        "partition_dates": ",".join(report.days) if done else None,
        "is_backfill": run.is_backfill,
        "write_mode": write_mode,
        "write_duration_seconds": report.seconds if done else None,
        "error_message": None if error is None else str(error),
    }


#: Files of a ledger path that are left as they are.
MOST_FILES = 64


def record(spark: SparkSession, ledger: str, rows: list[dict]) -> None:
    """Append rows; now and then a ledger path is compacted."""
    frame = literal_rows(spark, rows, LEDGER_SCHEMA)
    if not is_path(ledger):
        append_to_table(frame, ledger)
        return
    append_to_path(frame, ledger)
    # The rows are logged.  A compaction that meets another one is left to the next write.
    with suppress(AnalysisException, Py4JJavaError):
        compact_path(spark, ledger, MOST_FILES)


def is_path(ledger: str) -> bool:
    """A ledger with a slash is a path, any other a catalog table."""
    return "/" in ledger


def logged_step(
    spark: SparkSession,
    run: RunContext,
    dataset: str,
    table_id: int | None,
    write_mode: str,
    step: Callable[[], WriteReport],
) -> WriteReport:
    """Run one write and log how it ended; a failure is logged and raised again."""
    started = datetime.now(timezone.utc)

    def row(**outcome) -> dict:
        finished = datetime.now(timezone.utc)
        return ledger_row(
            run, dataset, table_id, write_mode, started, finished, **outcome
        )

    try:
        report = step()
    except Exception as error:
        # A ledger that cannot be written must not hide the failure itself.
        with suppress(Exception):
            record(spark, run.ledger, [row(error=error)])
        raise
    record(spark, run.ledger, [row(report=report)])
    return report


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger, empty when nothing has been logged yet."""
    if is_path(ledger):
        if dataset_exists(spark, ledger):
            reader = spark.read.schema(LEDGER_SCHEMA)
            held = reader.option("recursiveFileLookup", True).parquet(ledger)
            return held.dropDuplicates()
    elif spark.catalog.tableExists(ledger):
        return spark.read.table(ledger)
    return literal_rows(spark, [], LEDGER_SCHEMA)


def table_dataset(table_id: int) -> str:
    """Ledger name of a table's conformed dataset."""
    return f"table_{table_id}"


def _loads(ledger: DataFrame) -> DataFrame:
    """Successful loads of conformed tables.

    Publishing logs the same table ids under its own datasets, and a published day
    says nothing about what has been loaded.
    """
    own = F.concat(F.lit("table_"), F.col("table_id").cast("string"))
    return ledger.filter((F.col("status") == "SUCCESS") & (F.col("dataset") == own))


def undated_tables(ledger: DataFrame) -> DataFrame:
    """Tables with successful loads from before day lists were kept."""
    undated = _loads(ledger).filter(F.col("partition_dates").isNull())
    return undated.select("table_id").distinct()


def done_days(ledger: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``(table_id, day)`` already loaded successfully, for all tables at once.

    Old rows without a day list vouch for whatever days the table holds, given
    as ``existing`` with the same two columns.
    """
    listed = (
        _loads(ledger).filter(F.col("partition_dates").isNotNull())
        .select("table_id", listed_days("partition_dates").alias("days"))
        .select("table_id", F.explode("days").alias("day"))
    )
    if existing is not None:
        held = existing.filter(F.col("day").isNotNull())
        held = held.join(undated_tables(ledger), "table_id", "left_semi")
        listed = listed.union(held.select("table_id", F.col("day").cast("string")))
    return listed.distinct()
