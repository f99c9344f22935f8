"""The given tables in the roles of telemetry, lookups and ledger.

Nulls, blanks and odd texts are derived from row values, because the given
tables hold none.  Every stand-in covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.lookups import Lookups, build_lookups
from tierflow.sources.declared import TableSpec

METRICS = {"reading": "mean", "span": "delta", "latest": "last", "total": "sum"}

SPEC = TableSpec.from_config(
    1,
    {"AccountId": "Utf8", "SiteId": "Utf8", "HouseIdSet": "String"},
    {
        "schema": {
            "event_id": "Int64",
            "LocalDateTime": "Datetime",
            "reading": "Float64",
            "span": "Float64",
            "latest": "Float64",
            "total": "Float64",
            "linenmbr": "Int32",
            "distancedonepercent": "Float64",
            "eggsincrease": "Float64",
        },
        "numeric_columns": list(METRICS),
        "aggregation_map": METRICS,
        "merge_keys": ["event_id"],
    },
    source_system="barn",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as daily telemetry."""
    user, event = F.col("user_id"), F.col("event_id")
    unless_error = F.when(F.col("event_type") != "error", F.col("value"))
    house = F.concat(F.lit("["), ((user * 7) % 30).cast("string"), F.lit("] "))
    return table(spark, sf_dir, "events").select(
        "event_id",
        user.cast("string").alias("AccountId"),
        (user % 25).cast("string").alias("SiteId"),
        F.when(event % 10 == 0, "[]").when(event % 10 != 1, house).alias("HouseIdSet"),
        F.col("ts").alias("LocalDateTime"),
        unless_error.alias("reading"),
        unless_error.alias("span"),
        F.when(F.col("event_type") != "click", F.col("value")).alias("latest"),
        F.col("value").alias("total"),
        "event_type",
    )


def raw_text_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``telemetry`` as raw input: text columns, a ``date`` and position columns."""
    ts = F.col("LocalDateTime")
    return telemetry(spark, sf_dir).select(
        F.col("event_id").cast("string"),
        "AccountId",
        "SiteId",
        "HouseIdSet",
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("LocalDateTime"),
        *[F.col(metric).cast("string") for metric in METRICS],
        F.col("event_type").alias("beltids"),
        (F.col("event_id") % 4).cast("string").alias("linenmbr"),
        (F.col("total") - 5).cast("string").alias("distancedonepercent"),
        F.col("reading").cast("string").alias("eggsincrease"),
        F.date_format(ts, "yyyy-MM-dd").alias("date"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey Id", "c_name Name")


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey Id", "s_nationkey AccountId", "s_name Name"
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey Id", "n_regionkey SiteId", "n_name Name"
    )


def lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    return build_lookups(
        accounts(spark, sf_dir), houses(spark, sf_dir), sites(spark, sf_dir)
    )


def position_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as belt telemetry; positions reach below 0 and above 100.

    The day is the month's first, so a belt fills many bins of a day.
    """
    supplier = F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        F.to_date(F.date_trunc("month", "l_shipdate")).alias("PartitionDate"),
        (supplier % 25).cast("string").alias("AccountId"),
        (supplier % 5).cast("string").alias("SiteId"),
        F.concat(F.lit("["), (supplier % 3).cast("string"), F.lit("]")).alias(
            "HouseIdSet"
        ),
        F.col("l_returnflag").alias("beltids"),
        F.col("l_linenumber").alias("linenmbr"),
        (F.col("l_quantity") * 2.2 - 5).alias("distancedonepercent"),
        F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias(
            "eggsincrease"
        ),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows: one per table and week of ``events``, with failed weeks.

    The third week failed, the first table's fifth is old and has no day list,
    and lists are joined with stray blanks.
    """
    loaded = held_days(spark, sf_dir).withColumn(
        "week", F.floor((F.dayofmonth(F.col("day").cast("date")) - 1) / 7).cast("int")
    )
    runs = loaded.groupBy("table_id", "week").agg(
        F.sum("rows").alias("row_count"),
        F.array_sort(F.collect_set("day")).alias("days"),
    )
    started = F.lit("2024-02-01 06:00:00").cast("timestamp")
    return runs.select(
        F.concat_ws("-", F.lit("run"), "table_id", "week").alias("run_id"),
        F.concat(F.lit("table_"), F.col("table_id")).alias("dataset"),
        "table_id",
        F.when(F.col("week") == 2, "FAILED").otherwise("SUCCESS").alias("status"),
        started.alias("started_at_utc"),
        started.alias("finished_at_utc"),
        F.element_at("days", 1).alias("from_date"),
        F.element_at("days", -1).alias("to_date"),
        "row_count",
        F.size("days").alias("partition_count"),
        F.when(
            (F.col("week") != 4) | (F.col("table_id") != 1),
            F.concat(F.array_join("days", " , "), F.lit(",")),
        ).alias("partition_dates"),
        F.lit(False).alias("is_backfill"),
        F.lit("overwrite").alias("write_mode"),
        F.lit(1.0).alias("write_duration_seconds"),
        F.lit(None).cast("string").alias("error_message"),
    )


def ledger_of_both_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ledger`` and published datasets that name the failed weeks' tables and days."""
    loads = ledger(spark, sf_dir)
    published = loads.filter("status = 'FAILED'").withColumns(
        {
            "status": F.lit("SUCCESS"),
            "dataset": F.concat(F.lit("dashboard_daily_stats_"), "dataset"),
        }
    )
    return loads.unionByName(published)


def event_bounds(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day of ``events``."""
    day = F.to_date("ts")
    bounds = table(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first()
    return bounds[0].isoformat(), bounds[1].isoformat()


def held_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(table_id, day, rows)`` with ``events`` split over three tables."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            (F.col("user_id") % 3 + 1).cast("int").alias("table_id"),
            F.to_date("ts").cast("string").alias("day"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def table_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill window per table, past the data's end; table 3's is reversed."""
    # Dates, not text: Spark hashes fixed-width extremes but sorts for text ones.
    day = F.to_date("ts")
    bounds = (
        table(spark, sf_dir, "events")
        .groupBy((F.col("user_id") % 3 + 1).cast("int").alias("table_id"))
        .agg(F.min(day).alias("low"), F.date_add(F.max(day), 3).alias("high"))
    )
    reversed_one = F.col("table_id") == 3
    return bounds.select(
        "table_id",
        F.when(reversed_one, F.col("high")).otherwise(F.col("low")).alias("first"),
        F.when(reversed_one, F.col("low")).otherwise(F.col("high")).alias("last"),
    )
