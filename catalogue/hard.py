"""Queries whose stand-ins hold the awkward cases: ties, NULLs, copies, late rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import standins as given
from tierflow.functions.days import in_window
from tierflow.operators import daily
from tierflow.operators.conform import with_partition_day
from tierflow.operators.dashboard import dashboard
from tierflow.operators.lookups import (
    account_lookup,
    build_lookups,
    house_lookup,
    site_lookup,
)
from tierflow.plans import conforming, publishing
from tierflow.plans.ledger import RunContext, ledger_row, read_ledger, record
from tierflow.sinks.partitions import WriteReport, replace_partitions
from tierflow.sinks.scratch import scratch_path
from tierflow.sinks.upsert import upsert
from tierflow.sources.scans import partition_inventory, read_layer

AS_OF = datetime(2024, 1, 15, 6, 0, tzinfo=timezone.utc)


def range_filter_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of day inside the window's last day count."""
    events = given.table(spark, sf_dir, "events")
    return events.filter(in_window("ts", "2024-01-05", "2024-01-09")).select("event_id")


# -- lookups -----------------------------------------------------------------


def _odd_id(key: str) -> Column:
    """Repeated, blank, NULL and padded ids."""
    value, text = F.col(key), F.col(key).cast("string")
    return (
        F.when(value % 11 == 3, F.lit(None))
        .when(value % 13 == 5, F.lit("  "))
        .when(value % 7 == 2, (value - 1).cast("string"))
        .when(value % 5 == 4, F.concat(F.lit(" "), text))
        .otherwise(text)
    )


def _odd_name(key: str, name: str) -> Column:
    """Names without and with tied number suffixes."""
    value = F.col(key)
    return (
        F.when(value % 5 == 0, F.lit("Annex"))
        .when(value % 5 == 1, F.concat(F.lit("Unit "), (value % 4).cast("string")))
        .otherwise(F.col(name))
    )


def account_lookup_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = given.table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 9 != 0, F.col("c_name"))
    return account_lookup(
        customers.select(_odd_id("c_custkey").alias("Id"), name.alias("Name"))
    )


def house_lookup_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    account = F.when(F.col("s_suppkey") % 17 != 0, F.col("s_nationkey"))
    return house_lookup(
        given.table(spark, sf_dir, "supplier").select(
            _odd_id("s_suppkey").alias("Id"),
            account.alias("AccountId"),
            _odd_name("s_suppkey", "s_name").alias("Name"),
            F.concat(F.lit("a"), "s_suppkey").alias("Alias"),
            F.when(F.col("s_suppkey") % 3 != 0, F.lit("t")).alias("Town"),
        )
    )


def site_lookup_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lookup(
        given.table(spark, sf_dir, "nation").select(
            _odd_id("n_nationkey").alias("Id"),
            F.col("n_regionkey").alias("SiteId"),
            _odd_name("n_nationkey", "n_name").alias("Name"),
            F.concat(F.lit("a"), "n_nationkey").alias("Alias"),
            F.col("n_name").alias("Location"),
        )
    )


def dashboard_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site row id under several site keys gives a row for each."""
    sites = given.table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey % 13 Id", "n_regionkey SiteId", "n_name Name"
    )
    lookups = build_lookups(
        given.accounts(spark, sf_dir), given.houses(spark, sf_dir), sites
    )
    rows = dashboard(given.telemetry(spark, sf_dir), lookups)
    return rows.select("event_id", "HouseIdSet", "SiteName", "HouseName", "Customer")


# -- statistics --------------------------------------------------------------


def metric_last_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tied times, NULL tie breaks, and text times of shapes that only cast."""
    hour = F.date_trunc("hour", "ts")
    event = F.col("event_id")
    kind = F.hour("ts") % 4
    text = (
        F.when(kind == 0, F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 1, F.date_format(hour, "yyyy-MM-dd HH:mm:ss.S"))
        .when(kind == 2, F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(hour, "yyyy-MM-dd HH:mm:ss"))
    )
    tie = F.when(event % 3 != 0, event)
    rows = given.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("Date"),
        "user_id",
        text.alias("LocalDateTime"),
        tie.alias("tie"),
        (
            F.hour("ts").cast("bigint") * 100_000_000 + F.coalesce(tie, F.lit(0))
        ).alias("reading"),
    )
    found = daily.metric_value(
        rows, ["Date", "user_id"], "reading", "last", tie_break="tie"
    )
    return found.select("Date", "user_id", F.col("reading_mean").alias("reading_last"))


# -- sinks -------------------------------------------------------------------


def partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "inventory")
    events = given.table(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("PartitionDate")
    )
    replace_partitions(with_partition_day(events), path)
    return partition_inventory(spark, path).select(
        "day", (F.col("files") > 0).alias("files"), (F.col("bytes") > 0).alias("bytes")
    )


def upsert_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First write by upsert, two keys, NULL keys, repeats that match nothing."""
    order = F.col("o_orderkey")
    rows = with_partition_day(
        given.table(spark, sf_dir, "orders").select(
            F.when(order % 10 != 0, order).alias("k"),
            "o_custkey",
            "o_totalprice",
            order.alias("o"),
            F.date_trunc("month", "o_orderdate").alias("PartitionDate"),
        )
    )
    path = scratch_path(spark, "upsert")
    upsert(rows.filter("o % 3 <> 0"), path, ["k", "o_custkey"])
    changed = rows.filter("o % 2 = 0").withColumn(
        "o_totalprice", F.round(F.col("o_totalprice") + 1, 2)
    )
    new = rows.filter("o % 50 = 1").withColumn("k", -F.col("o"))
    upsert(changed.union(new).union(new), path, ["k", "o_custkey"])
    return read_layer(spark, path).select(
        "k", "o_custkey", "o_totalprice", "PartitionDate"
    )


# -- runs --------------------------------------------------------------------


def run_ledger_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows as runs write them: done, skipped and failed."""
    path = scratch_path(spark, "ledger")
    week = F.floor((F.dayofmonth(F.col("day").cast("date")) - 1) / 7).cast("int")
    weeks = (
        given.held_days(spark, sf_dir)
        .groupBy("table_id", week.alias("week"))
        .agg(
            F.sum("rows").alias("rows"),
            F.array_sort(F.collect_set("day")).alias("days"),
        )
        .collect()
    )
    for step in weeks:  # a row per table and week
        context = RunContext(f"run-{step.week}", path, step.days[0], step.days[-1])
        outcome = {"report": WriteReport(step.rows, tuple(step.days), 1.5)}
        if step.week == 2:
            outcome = {"error": ValueError("broken")}
        if step.week == 3:
            outcome = {"report": WriteReport(0, (), 0.0)}
        table = f"table_{step.table_id}"
        row = ledger_row(
            context, table, step.table_id, "overwrite", AS_OF, AS_OF, **outcome
        )
        record(spark, path, [row])
    return read_ledger(spark, path).select(
        "run_id",
        "dataset",
        "table_id",
        "status",
        "from_date",
        "to_date",
        "row_count",
        "partition_count",
        "partition_dates",
        "write_duration_seconds",
        "error_message",
    )


def _raw(spark: SparkSession, sf_dir: str, date: Column) -> DataFrame:
    return given.raw_text_telemetry(spark, sf_dir).withColumn("date", date)


def publish_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored up to nine days late; a bounded publish still has whole days."""
    root, out = scratch_path(spark, "input"), scratch_path(spark, "conformed")
    published, ledger = scratch_path(spark, "published"), scratch_path(spark, "ledger")
    stored = F.date_add(F.col("date").cast("date"), (F.col("event_id") % 10).cast("int"))
    raw = _raw(spark, sf_dir, stored.cast("string"))
    raw.hint("rebalance", "date").write.partitionBy("date").parquet(
        conforming.table_path(root, 1)
    )
    conforming.run(spark, root, out, ledger, [given.SPEC], as_of=AS_OF)
    where = (spark, out, published, ledger, [given.SPEC], given.lookups(spark, sf_dir))
    options = {"as_of": AS_OF, "tie_breaks": {1: "event_id"}}
    publishing.run(*where, **options)
    publishing.run(*where, "2024-01-10", "2024-01-12", **options)
    stats = read_layer(
        spark, f"{published}/{publishing.DAILY_DATASET.format(1)}", day_column="Date"
    )
    return stats.groupBy("Date").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("row_count").alias("row_count"),
        F.round(F.sum("total_mean"), 2).alias("total"),
    )


def conform_plain_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``date`` column in the files: timestamps, text with a time, and both shapes."""
    root, out = scratch_path(spark, "input"), scratch_path(spark, "conformed")
    ledger = scratch_path(spark, "ledger")
    instant = F.to_timestamp("LocalDateTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    timed = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    mixed = F.when(F.col("event_id") % 2 == 0, timed).otherwise(F.col("date"))
    specs = []
    for table_id, date in ((1, instant), (2, timed), (3, mixed)):
        _raw(spark, sf_dir, date).write.parquet(conforming.table_path(root, table_id))
        spec = given.SPEC
        specs.append(
            type(spec)(
                table_id,
                spec.columns,
                spec.metrics,
                merge_keys=spec.merge_keys,
                source_system=spec.source_system,
            )
        )
    where = (spark, root, out, ledger, specs)
    conforming.run(*where, "2024-01-03", "2024-01-09", as_of=AS_OF)
    conforming.backfill(*where, "2024-01-01", "2024-01-20", as_of=AS_OF)
    tables = [read_layer(spark, conforming.table_path(out, s.table_id)) for s in specs]
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.select("event_id", "source_table_id", "PartitionDate")


def skipped_then_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of nothing, then a merge backfill, then what the output holds."""
    root, out = scratch_path(spark, "input"), scratch_path(spark, "conformed")
    ledger = scratch_path(spark, "ledger")
    _raw(spark, sf_dir, F.col("date")).hint("rebalance", "date").write.partitionBy(
        "date"
    ).parquet(conforming.table_path(root, 1))
    where = (spark, root, out, ledger, [given.SPEC])
    conforming.run(*where, "2019-01-01", "2019-01-02", as_of=AS_OF)
    first, last = given.event_bounds(spark, sf_dir)
    reports = conforming.backfill(*where, first, last, as_of=AS_OF)
    return reports.verified.select(
        "dataset", "row_count", F.size("days").alias("day_count")
    )


def gold_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both published matrices read back, summed per row key."""
    root, out = scratch_path(spark, "input"), scratch_path(spark, "conformed")
    published, ledger = scratch_path(spark, "published"), scratch_path(spark, "ledger")
    _raw(spark, sf_dir, F.col("date")).hint("rebalance", "date").write.partitionBy(
        "date"
    ).parquet(conforming.table_path(root, 1))
    conforming.run(spark, root, out, ledger, [given.SPEC], as_of=AS_OF)
    publishing.publish_matrices(spark, out, published, RunContext("run", ledger))
    keys = ["Date", "AccountId", "SiteId", "HouseIdSet", "beltids", "linenmbr"]
    long = read_layer(spark, f"{published}/{publishing.LONG_DATASET}", day_column="Date")
    wide = read_layer(spark, f"{published}/{publishing.WIDE_DATASET}", day_column="Date")
    bins = [c for c in wide.columns if c.startswith("pos_")]
    summed = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in bins), F.lit(0.0))
    filled = sum((F.col(c).isNotNull().cast("bigint") for c in bins), F.lit(0))
    from_long = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("bins"),
        F.round(F.sum("eggsincrease_sum"), 2).alias("total"),
    )
    from_wide = wide.select(
        *keys, filled.cast("bigint").alias("bins"), F.round(summed, 2).alias("total")
    )
    return from_long.withColumn("matrix", F.lit("long")).unionByName(
        from_wide.withColumn("matrix", F.lit("wide"))
    )


QUERIES = {
    "range_filter_times": range_filter_times,
    "account_lookup_hard": account_lookup_hard,
    "house_lookup_hard": house_lookup_hard,
    "site_lookup_hard": site_lookup_hard,
    "dashboard_fanout": dashboard_fanout,
    "metric_last_ties": metric_last_ties,
    "partition_files": partition_files,
    "upsert_hard": upsert_hard,
    "run_ledger_steps": run_ledger_steps,
    "publish_late_rows": publish_late_rows,
    "conform_plain_dates": conform_plain_dates,
    "skipped_then_merged": skipped_then_merged,
    "gold_matrices": gold_matrices,
}
