"""One callable ``(spark, sf_dir) -> DataFrame`` per operator of the inventory."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import changes, hard
from catalogue import standins as given
from tierflow.functions.days import in_window
from tierflow.functions.parsing import (
    bigint_or_null,
    event_day,
    normalize_identifier,
    numeric_suffix,
)
from tierflow.functions.position import BIN_COUNT, bin_label, position_bin
from tierflow.operators import daily, matrix
from tierflow.operators.conform import conform, with_lineage, with_partition_day
from tierflow.operators.dashboard import dashboard
from tierflow.operators.lookups import account_lookup, house_lookup, site_lookup
from tierflow.plans import backfill, conforming, publishing
from tierflow.plans.ledger import done_days, read_ledger
from tierflow.plans.verify import verify_outputs
from tierflow.sinks.append import append_to_path
from tierflow.sinks.partitions import distinct_days, publish, replace_partitions
from tierflow.sinks.scratch import scratch_path
from tierflow.sinks.upsert import upsert
from tierflow.sources.declared import spark_type
from tierflow.sources.scans import (
    preview,
    read_layer,
    read_lookup_csv,
    read_raw,
)

AS_OF = datetime(2024, 1, 15, 6, 0, tzinfo=timezone.utc)
SCAN_DAYS = ["2024-01-03", "2024-01-04", "2024-01-11", "2024-01-20", "2024-02-15"]
STATS_ROUNDING = {"reading_mean": 8, "span_mean": 4, "total_mean": 4}


def _rounded(frame: DataFrame, digits: dict[str, int]) -> DataFrame:
    return frame.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _stats_result(stats: DataFrame) -> DataFrame:
    """Statistics with floating sums rounded and fractions at six digits."""
    fractions = {c: 6 for c in stats.columns if c.endswith("_fraction")}
    return _rounded(stats, STATS_ROUNDING | fractions)


# -- scans -------------------------------------------------------------------


def _write_raw(frame: DataFrame, path: str) -> None:
    """Raw input in daily directories, with few files per day."""
    frame.hint("rebalance", "date").write.partitionBy("date").parquet(path)


def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    events = given.table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    _write_raw(events, path)
    return read_raw(spark, path, days=SCAN_DAYS).select(
        "event_id", "user_id", "value", F.col("date").cast("string").alias("day")
    )


def _orders_layer(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as a conformed dataset, laid out by month start."""
    path = scratch_path(spark, "orders")
    replace_partitions(_orders(spark, sf_dir), path)
    return path


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_trunc("month", "o_orderdate")
    dated = given.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", month.alias("PartitionDate")
    )
    return with_partition_day(dated)


def silver_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = read_layer(
        spark, _orders_layer(spark, sf_dir), "1996-03-01", "1998-12-01"
    )
    return layer.select("o_orderkey", "o_totalprice", "PartitionDate")


def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.table(spark, sf_dir, "orders")
    window = in_window("o_orderdate", "1996-01-01", "1997-06-30")
    return orders.filter(window).select("o_orderkey", "o_orderdate")


def csv_lookup_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    given.houses(spark, sf_dir).write.option("header", True).csv(path)
    return read_lookup_csv(spark, path).select("Id", "AccountId", "Name")


def preview_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = given.table(spark, sf_dir, "customer")
    return preview(customers.select("c_custkey", "c_name"), ["c_name", "c_custkey"])


# -- conforming --------------------------------------------------------------


def conform_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, kind = F.col("ts"), F.col("event_id") % 4
    raw = given.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "dd/MM/yyyy"))
        .alias("at"),
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(ts, "yyyy/MM/dd"))
        .alias("on"),
        F.col("event_id").cast("string").alias("small"),
        F.when(kind == 3, F.concat(F.lit("x"), F.col("value").cast("string")))
        .otherwise(F.col("value").cast("string"))
        .alias("amount"),
        F.col("user_id").alias("label"),
    )
    declared = {
        "at": spark_type("Datetime"),
        "on": spark_type("Date"),
        "small": spark_type("Int8"),
        "amount": spark_type("Float64"),
        "label": spark_type("Utf8"),
        "absent": spark_type("Int32"),
    }
    return conform(raw, declared, rejects="rejected").withColumns(
        {
            "at": F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "on": F.date_format("on", "yyyy-MM-dd"),
            "small": F.col("small").cast("int"),
        }
    )


def partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(
        F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")
    ).when(
        F.col("o_orderkey") % 5 != 0,
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    )
    raw = given.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("date"))
    return with_partition_day(raw).drop("date")


def row_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.table(spark, sf_dir, "events").select("event_id")
    return with_lineage(events, 7, "barn", AS_OF).select(
        "event_id",
        "source_table_id",
        "source_system",
        F.endswith("source_file_path", F.lit("events.parquet")).alias("has_file"),
        "ingestion_date",
        F.unix_micros("ingested_at_utc").alias("ingested_micros"),
    )


def date_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, kind = F.col("ts"), F.col("event_id") % 4
    rows = given.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == 2, F.lit("soon"))
        .alias("PartitionDate"),
        F.when(kind == 2, ts + F.expr("interval 2 days")).alias("BestUtcDateTime"),
        F.date_add(F.to_date(ts), 5).alias("datetimeutc"),
    )
    day = F.date_format(event_day(rows.schema), "yyyy-MM-dd")
    return rows.select("event_id", day.alias("day"))


def bigint_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    text = (
        F.when(key == 0, size)
        .when(key == 1, F.concat(F.lit("  "), size, F.lit(" ")))
        .when(key == 2, F.concat(size, F.lit("a")))
        .when(key == 3, F.lit("  "))
        .otherwise(F.repeat(F.lit("9"), F.col("p_size") % 30))
    )
    parts = given.table(spark, sf_dir, "part")
    return parts.select("p_partkey", bigint_or_null(text).alias("number"))


def suffix_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = given.table(spark, sf_dir, "supplier")
    return suppliers.select("s_suppkey", numeric_suffix("s_name").alias("suffix"))


def identifier_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = given.telemetry(spark, sf_dir)
    double = F.concat("HouseIdSet", F.lit(","), "HouseIdSet")
    text = F.when(F.col("event_id") % 7 == 0, double).otherwise(F.col("HouseIdSet"))
    return raw.select("event_id", normalize_identifier(text).alias("identifier"))


def position_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.when(
        F.col("l_linenumber") != 7, F.col("l_quantity") * 2.2 - 5
    )
    rows = given.table(spark, sf_dir, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", position_bin(place).alias("position_bin")
    )


# -- lookups and enrichment ----------------------------------------------------


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account_lookup(given.accounts(spark, sf_dir))


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return house_lookup(given.houses(spark, sf_dir))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lookup(given.sites(spark, sf_dir))


def dashboard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dashboard(given.telemetry(spark, sf_dir), given.lookups(spark, sf_dir))
    return rows.select(
        "event_id",
        "AccountId",
        "SiteId",
        "HouseIdSet",
        "HouseId",
        "Customer",
        "HouseName",
        "HouseAlias",
        "SiteName",
        "SiteAlias",
        "HouseOrdinal",
        "reading",
    )


# -- daily statistics ----------------------------------------------------------


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = daily.enriched_daily_stats(
        given.telemetry(spark, sf_dir),
        given.lookups(spark, sf_dir),
        given.METRICS,
        AS_OF,
        tie_break="event_id",
    )
    return _stats_result(daily.for_display(stats))


def _metric_query(how: str, digits: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = given.telemetry(spark, sf_dir).withColumn(
            "Date", F.to_date("LocalDateTime")
        )
        result = daily.metric_value(
            rows, ["Date", "AccountId"], "reading", how, tie_break="event_id"
        )
        return result.select(
            "Date",
            "AccountId",
            F.round("reading_mean", digits).alias(f"reading_{how}"),
        )

    return query


def null_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given.telemetry(spark, sf_dir)
    result = daily.metric_value(rows, ["AccountId", "event_type"], "latest", "mean")
    return result.select(
        "AccountId",
        "event_type",
        "row_count",
        "latest_null_count",
        F.round("latest_null_fraction", 6).alias("latest_null_fraction"),
    )


def day_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = given.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("Date"))
    return days.agg(F.count(F.lit(1)).alias("row_count")).select(
        "Date", "row_count", *daily.day_progress("Date", AS_OF)
    )


# -- matrices --------------------------------------------------------------------


def matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix.matrix_long(given.position_telemetry(spark, sf_dir))
    return _rounded(matrix.for_display(long), {"eggsincrease_sum": 2})


def matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix.matrix_long(given.position_telemetry(spark, sf_dir))
    wide = matrix.for_display(matrix.matrix_wide(long))
    return _rounded(wide, {bin_label(i): 2 for i in range(BIN_COUNT)})


# -- sinks -------------------------------------------------------------------------


def partition_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_days(given.table(spark, sf_dir, "events"), "ts")


def _event_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.table(spark, sf_dir, "events").select(
        "event_id", "value", F.to_date("ts").alias("PartitionDate")
    )
    return with_partition_day(events)


def replaced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "replace")
    layer = _event_layer(spark, sf_dir)
    replace_partitions(layer, path)
    corrected = layer.filter(F.col("PartitionDate") >= "2024-01-16")
    replace_partitions(corrected.withColumn("value", F.col("value") + 1000), path)
    return read_layer(spark, path).select(
        "event_id", F.round("value", 2).alias("value"), "year", "month", "PartitionDate"
    )


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "evolve")
    layer = _event_layer(spark, sf_dir)
    late = F.col("PartitionDate") >= "2024-01-16"
    replace_partitions(layer.filter(~late), path)
    replace_partitions(
        layer.filter(late).withColumn("doubled", F.col("value") * 2), path
    )
    return read_layer(spark, path).select("event_id", "doubled", "PartitionDate")


def gold_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "published")
    per_day = (
        given.table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("Date"), "user_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    publish(per_day, path)
    return read_layer(spark, path, day_column="Date")


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders upserted: finished ones match, the others get new keys."""
    path = _orders_layer(spark, sf_dir)
    key = F.col("o_orderkey")
    source = _orders(spark, sf_dir).select(
        F.when(F.col("o_orderstatus") == "F", key).otherwise(-1 - key).alias(
            "o_orderkey"
        ),
        F.round(F.col("o_totalprice") + 1, 2).alias("o_totalprice"),
        "PartitionDate",
        "year",
        "month",
    )
    upsert(source, path, ["o_orderkey"])
    return read_layer(spark, path).select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "PartitionDate"
    )


# -- ledger and backfill -------------------------------------------------------------


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ledger")
    append_to_path(given.ledger(spark, sf_dir), path)
    return (
        read_ledger(spark, path)
        .groupBy("table_id", "status")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("row_count").alias("row_count"),
            F.sum("partition_count").alias("partition_count"),
            F.min("from_date").alias("from_date"),
            F.max("to_date").alias("to_date"),
        )
    )


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    given.ledger_of_both_layers(spark, sf_dir).createOrReplaceTempView("tierflow_run_ledger")
    return done_days(
        read_ledger(spark, "tierflow_run_ledger"), given.held_days(spark, sf_dir)
    )


def logged_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _done(spark, sf_dir)


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.wanted_days(given.table_windows(spark, sf_dir), "first", "last")


def backfill_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wanted(spark, sf_dir)


def backfill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = backfill.missing_days(_wanted(spark, sf_dir), _done(spark, sf_dir))
    return gaps.select("table_id", "day")


def backfill_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.missing_days(
        _wanted(spark, sf_dir), _done(spark, sf_dir), forced=[2]
    )


def verified_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = scratch_path(spark, "verify")
    replace_partitions(_event_layer(spark, sf_dir), events)
    outputs = {
        "events": (events, "PartitionDate"),
        "orders": (_orders_layer(spark, sf_dir), "PartitionDate"),
        "absent": (scratch_path(spark, "verify"), "PartitionDate"),
    }
    return verify_outputs(spark, outputs).select(
        "dataset",
        "row_count",
        F.size("days").alias("day_count"),
        F.try_element_at("days", F.lit(1)).alias("first_day"),
        F.try_element_at("days", F.lit(-1)).alias("last_day"),
    )


# -- whole runs ------------------------------------------------------------------------


def _raw_root(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "input")
    raw = given.raw_text_telemetry(spark, sf_dir)
    _write_raw(raw, conforming.table_path(root, 1))
    return root


def silver_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bounded runs, then a backfill of what is left, read back whole."""
    root, out = _raw_root(spark, sf_dir), scratch_path(spark, "conformed")
    ledger = scratch_path(spark, "ledger")
    where = (spark, root, out, ledger, [given.SPEC])
    conforming.run(*where, "2024-01-03", "2024-01-09", as_of=AS_OF)
    conforming.run(*where, "2024-01-08", "2024-01-20", as_of=AS_OF)
    first, last = given.event_bounds(spark, sf_dir)
    conforming.backfill(*where, first, last, as_of=AS_OF)
    return read_layer(spark, conforming.table_path(out, 1)).select(
        "event_id",
        "AccountId",
        "HouseIdSet",
        F.col("LocalDateTime").cast("timestamp_ntz").alias("LocalDateTime"),
        "reading",
        "linenmbr",
        "PartitionDate",
        "year",
        "month",
        "source_table_id",
        "source_system",
        "ingestion_date",
    )


def gold_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text to published statistics through both layers."""
    out, published = scratch_path(spark, "conformed"), scratch_path(spark, "published")
    ledger = scratch_path(spark, "ledger")
    conforming.run(
        spark, _raw_root(spark, sf_dir), out, ledger, [given.SPEC], as_of=AS_OF
    )
    publishing.run(
        spark,
        out,
        published,
        ledger,
        [given.SPEC],
        given.lookups(spark, sf_dir),
        as_of=AS_OF,
        tie_breaks={1: "event_id"},
    )
    stats = read_layer(
        spark,
        f"{published}/{publishing.DAILY_DATASET.format(1)}",
        day_column="Date",
    )
    local = F.col("last_record_local_ts").cast("timestamp_ntz")
    return _stats_result(stats.withColumn("last_record_local_ts", local))


QUERIES = {
    "scan_partitioned": scan_partitioned,
    "silver_range_scan": silver_range_scan,
    "range_filter": range_filter,
    "csv_lookup_roundtrip": csv_lookup_roundtrip,
    "conform_cast": conform_cast,
    "partition_date": partition_date,
    "row_metadata": row_metadata,
    "date_expr": date_expr,
    "bigint_or_null": bigint_parse,
    "numeric_suffix": suffix_parse,
    "normalize_identifier": identifier_parse,
    "position_bin": position_bins,
    "account_lookup": accounts,
    "house_lookup": houses,
    "site_lookup": sites,
    "dashboard_join": dashboard_join,
    "daily_stats": daily_stats,
    "metric_sum": _metric_query("sum", 4),
    "metric_max": _metric_query("max", 4),
    "metric_min": _metric_query("min", 4),
    "metric_last": _metric_query("last", 4),
    "metric_delta": _metric_query("delta", 4),
    "metric_mean": _metric_query("mean", 8),
    "null_fraction": null_fraction,
    "day_progress": day_progress,
    "matrix_long": matrix_long,
    "matrix_wide": matrix_wide,
    "partition_dates": partition_dates,
    "replace_partitions": replaced_partitions,
    "gold_write_roundtrip": gold_write_roundtrip,
    "schema_evolution": schema_evolution,
    "upsert": upserted,
    "run_ledger": run_ledger,
    "backfill_calendar": backfill_calendar,
    "logged_dates": logged_dates,
    "backfill_gaps": backfill_gaps,
    "backfill_forced": backfill_forced,
    "verify_outputs": verified_outputs,
    "silver_conform": silver_conform,
    "gold_end_to_end": gold_end_to_end,
    "preview_topk": preview_topk,
    **hard.QUERIES,
    **changes.QUERIES,
}
