"""Publish daily statistics and matrices. Ids: INC-11, INC-12, INC-13, SNK-4."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.days import Day, in_days, in_window
from tierflow.operators.daily import enriched_daily_stats
from tierflow.operators.lookups import Lookups
from tierflow.operators.matrix import MATRIX_KEYS, matrix_long, matrix_wide
from tierflow.plans.conforming import table_path
from tierflow.plans.ledger import RunContext, logged_step
from tierflow.plans.local_days import partitions_holding
from tierflow.plans.verify import Reports, verify_outputs
from tierflow.sinks.partitions import WriteReport, publish
from tierflow.sources.declared import TableSpec
from tierflow.sources.scans import read_layer

# Names of the published datasets, and the table with positions.
DAILY_DATASET = "dashboard_daily_stats_table_{}"
LONG_DATASET = "table_1_matrix_long"
WIDE_DATASET = "table_1_matrix_wide"
MATRIX_TABLE_ID = 1

#: Bytes that one task holds to pivot and write: about so many for each row key, whose wide
#: row stands in both steps of the pivot and in the write's sort, and for each long row.
PART_BYTES = 256 << 20
KEY_BYTES, ROW_BYTES = 3 << 10, 1 << 8


def daily_rows(
    spark: SparkSession,
    conformed_root: str,
    spec: TableSpec,
    lookups: Lookups,
    first: Day | None = None,
    last: Day | None = None,
    as_of: datetime | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """Statistics of the days in the window, each of them whole.

    Files are laid out by partition day but statistics are by event-local day.
    The scan reads every partition that may hold a local day of the window,
    however late its rows were stored, so no published day is a fragment.
    """
    path = table_path(conformed_root, spec.table_id)
    layer = read_layer(spark, path)
    if first is not None or last is not None:
        holding = partitions_holding(spark, path, first, last)
        layer = layer.filter(in_days("PartitionDate", holding))
    stats = enriched_daily_stats(layer, lookups, spec.metrics, as_of, tie_break)
    return stats.filter(in_window("Date", first, last))


def publish_matrices(
    spark: SparkSession,
    conformed_root: str,
    out_root: str,
    context: RunContext,
    table_id: int = MATRIX_TABLE_ID,
) -> dict[str, WriteReport]:
    """Long matrix from telemetry, wide matrix from the long one just written.

    The long rows are shuffled once more, by day and part of a day, for both the pivot and
    the write; how many parts a day has follows from its rows and row keys.
    """
    long_path = f"{out_root}/{LONG_DATASET}"

    def long() -> WriteReport:
        layer = read_layer(
            spark, table_path(conformed_root, table_id), context.first, context.last
        )
        return publish(matrix_long(layer), long_path)

    def wide_from(report: WriteReport) -> WriteReport:
        if not report.days:
            return WriteReport(rows=0, days=(), seconds=0.0)
        written = read_layer(spark, long_path, day_column="Date").filter(
            in_days("Date", report.days)
        )
        dated = written.withColumn("Date", F.col("Date").cast("date"))
        wide = matrix_wide(dated, _parts(dated))
        return publish(wide, f"{out_root}/{WIDE_DATASET}", gather=False)

    long_report = logged_step(
        spark, context, LONG_DATASET, table_id, "overwrite", long
    )
    wide_report = logged_step(
        spark,
        context,
        WIDE_DATASET,
        table_id,
        "overwrite",
        lambda: wide_from(long_report),
    )
    return {LONG_DATASET: long_report, WIDE_DATASET: wide_report}


def _parts(long: DataFrame) -> dict[str, float]:
    """Days of a long matrix with the number of tasks, or share of one, that each takes.

    The keys are counted to within some percent, which moves sizes only; a row per day
    reaches the driver.
    """
    key = F.xxhash64(*MATRIX_KEYS[1:])
    held = long.groupBy(F.col("Date").cast("string").alias("day")).agg(
        F.approx_count_distinct(key).alias("keys"), F.count(F.lit(1)).alias("rows")
    )
    return {
        r["day"]: (r["keys"] * KEY_BYTES + r["rows"] * ROW_BYTES) / PART_BYTES
        for r in held.filter("day is not null").orderBy("day").collect()
    }


def run(
    spark: SparkSession,
    conformed_root: str,
    out_root: str,
    ledger: str,
    specs: Iterable[TableSpec],
    lookups: Lookups,
    first: Day | None = None,
    last: Day | None = None,
    as_of: datetime | None = None,
    tie_breaks: Mapping[int, str] | None = None,
    matrix_table_id: int = MATRIX_TABLE_ID,
) -> Reports:
    """Statistics for every table, then the matrices of the position table.

    The lookups are computed once and kept for all tables.  The reports come with
    what the outputs hold afterwards.
    """
    context = RunContext(str(uuid.uuid4()), ledger, first, last)
    kept = Lookups(
        lookups.account.persist(), lookups.house.persist(), lookups.site.persist()
    )
    reports = {}
    try:
        for spec in specs:
            dataset = DAILY_DATASET.format(spec.table_id)
            tie_break = (tie_breaks or {}).get(spec.table_id)
            reports[dataset] = logged_step(
                spark,
                context,
                dataset,
                spec.table_id,
                "overwrite",
                lambda: publish(
                    daily_rows(
                        spark,
                        conformed_root,
                        spec,
                        kept,
                        first,
                        last,
                        as_of,
                        tie_break,
                    ),
                    f"{out_root}/{dataset}",
                ),
            )
    finally:
        for lookup in (kept.account, kept.house, kept.site):
            lookup.unpersist()
    matrices = publish_matrices(
        spark, conformed_root, out_root, context, matrix_table_id
    )
    reports |= matrices
    outputs = {name: (f"{out_root}/{name}", "Date") for name in reports}
    return Reports(reports, verify_outputs(spark, outputs))
