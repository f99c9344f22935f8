"""Conform raw tables and load them by day. Ids: INC-1, INC-5, INC-6, INC-10."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.days import Day, in_days, in_window, iso
from tierflow.functions.parsing import EVENT_TIME_CANDIDATES
from tierflow.operators.daily import local_day
from tierflow.operators.conform import (
    REJECTED,
    conform,
    with_lineage,
    with_partition_day,
)
from tierflow.plans.backfill import missing_days, wanted_days
from tierflow.plans.ledger import (
    RunContext,
    done_days,
    logged_step,
    read_ledger,
    table_dataset,
    undated_tables,
)
from tierflow.plans.local_days import note_local_days
from tierflow.plans.verify import Reports, verify_outputs
from tierflow.sinks.partitions import WriteReport, replace_partitions
from tierflow.sinks.upsert import upsert
from tierflow.sources.declared import TableSpec
from tierflow.sources.scans import (
    dataset_exists,
    laid_out_by,
    literal_rows,
    partition_inventory,
    read_raw,
    read_raw_parts,
)
from tierflow.sources.types import united

_WINDOWS = T.StructType(
    [
        T.StructField("table_id", T.IntegerType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
    ]
)
_TABLE_DAYS = T.StructType(
    [T.StructField("table_id", T.IntegerType()), T.StructField("day", T.StringType())]
)


def table_path(root: str, table_id: int) -> str:
    return f"{root}/table_{table_id}"


def conformed_rows(
    spark: SparkSession,
    raw_path: str,
    spec: TableSpec,
    first: Day | None = None,
    last: Day | None = None,
    days: list[str] | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """One lazy chain from raw files to rows ready to write.

    Where a row's day is that of its directory, the window prunes directories.
    Otherwise it is on the parsed day of all rows, wherever their files lie: a
    day is then whole, and no row outside the window can replace its own day.
    Files whose types differ are read apart, conformed and united.
    """
    by_directory = dated_by_directory(spark, raw_path)
    window = (first, last, days) if by_directory else ()
    rows = united(
        [
            _conformed_part(part, spec, as_of)
            for part in read_raw_parts(spark, raw_path, *window)
        ]
    )
    if by_directory:
        return rows
    if days is not None:
        return rows.filter(in_days("PartitionDate", days))
    return rows.filter(in_window("PartitionDate", first, last))


def _conformed_part(
    raw: DataFrame, spec: TableSpec, as_of: datetime | None
) -> DataFrame:
    rows = with_partition_day(conform(raw, spec.columns, rejects=REJECTED))
    return with_lineage(rows, spec.table_id, spec.source_system, as_of)


def dated_by_directory(spark: SparkSession, raw_path: str) -> bool:
    """Whether the day of a row is the ``date=`` directory it lies in."""
    if not laid_out_by(spark, raw_path, "date"):
        return False
    return "PartitionDate" not in read_raw(spark, raw_path).columns


def load_table(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    spec: TableSpec,
    first: Day | None = None,
    last: Day | None = None,
    days: list[str] | None = None,
    write_mode: str = "overwrite",
    as_of: datetime | None = None,
) -> WriteReport:
    """Conform one table and replace, or with ``"merge"`` upsert, its days."""
    raw = table_path(raw_root, spec.table_id)
    rows = conformed_rows(spark, raw, spec, first, last, days, as_of)
    out = table_path(out_root, spec.table_id)
    timed = any(name in rows.columns for name in EVENT_TIME_CANDIDATES)
    options = {"rejected": REJECTED, "local_day": local_day if timed else None}
    if write_mode == "merge":
        report = upsert(rows, out, spec.merge_keys, **options)
    else:
        # Rows from daily directories lie by day already and need no shuffle.
        gather = not dated_by_directory(spark, raw)
        report = replace_partitions(rows, out, gather=gather, **options)
    note_local_days(spark, out, report.local_days)
    return report


def verified(spark: SparkSession, out_root: str, reports: dict) -> Reports:
    outputs = {
        table_dataset(i): (table_path(out_root, i), "PartitionDate") for i in reports
    }
    return Reports(reports, verify_outputs(spark, outputs))


def run(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    ledger: str,
    specs: Iterable[TableSpec],
    first: Day | None = None,
    last: Day | None = None,
    write_mode: str = "overwrite",
    as_of: datetime | None = None,
) -> Reports:
    """Load the tables one after another; the first failure is logged and stops.

    The reports come with what the outputs hold afterwards.
    """
    context = RunContext(str(uuid.uuid4()), ledger, first, last)
    reports = {
        spec.table_id: logged_step(
            spark,
            context,
            table_dataset(spec.table_id),
            spec.table_id,
            write_mode,
            lambda spec=spec: load_table(
                spark,
                raw_root,
                out_root,
                spec,
                first,
                last,
                write_mode=write_mode,
                as_of=as_of,
            ),
        )
        for spec in specs
    }
    return verified(spark, out_root, reports)


def plan_backfill(
    spark: SparkSession,
    out_root: str,
    ledger: str,
    table_ids: list[int],
    first: Day,
    last: Day,
    forced: Iterable[int] = (),
) -> DataFrame:
    """``(table_id, day, forced)`` still to load, all tables in one plan."""
    tables = literal_rows(
        spark,
        [{"table_id": i, "first": iso(first), "last": iso(last)} for i in table_ids],
        _WINDOWS,
    )
    log = read_ledger(spark, ledger)
    # Outputs are listed only where old ledger rows leave the days open.
    undated = {row.table_id for row in undated_tables(log).collect()}
    held = existing_days(spark, out_root, undated.intersection(table_ids))
    done = done_days(log, held)
    return missing_days(wanted_days(tables, "first", "last"), done, forced)


def existing_days(
    spark: SparkSession, out_root: str, table_ids: Iterable[int]
) -> DataFrame:
    """``(table_id, day)`` present on disk, from the file listing."""
    held = literal_rows(spark, [], _TABLE_DAYS)
    for table_id in table_ids:
        path = table_path(out_root, table_id)
        if dataset_exists(spark, path):
            found = partition_inventory(spark, path)
            held = held.union(
                found.select(F.lit(table_id).cast(T.IntegerType()), "day")
            )
    return held


def backfill(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    ledger: str,
    specs: Iterable[TableSpec],
    first: Day,
    last: Day,
    write_mode: str = "merge",
    forced: Iterable[int] = (),
    as_of: datetime | None = None,
) -> Reports:
    """Load only the days the ledger does not vouch for.

    Forced tables reload every day and are replaced, since an upsert would read
    target files that may be the very thing to repair.  What reaches the driver
    is the list of open days per table, bounded by the calendar window.
    """
    by_id = {spec.table_id: spec for spec in specs}
    forced_ids = set(forced)
    plan = plan_backfill(spark, out_root, ledger, list(by_id), first, last, forced_ids)
    open_days = {
        row.table_id: row.days
        for row in plan.groupBy("table_id")
        .agg(F.array_sort(F.collect_set("day")).alias("days"))
        .collect()
    }
    context = RunContext(str(uuid.uuid4()), ledger, first, last, is_backfill=True)
    reports = {}
    for table_id, spec in by_id.items():
        if table_id not in open_days:
            continue
        mode = "overwrite" if table_id in forced_ids else write_mode
        reports[table_id] = logged_step(
            spark,
            context,
            table_dataset(table_id),
            table_id,
            mode,
            lambda: load_table(
                spark,
                raw_root,
                out_root,
                spec,
                days=list(open_days[table_id]),
                write_mode=mode,
                as_of=as_of,
            ),
        )
    return verified(spark, out_root, reports)
