"""Queries over datasets that change under way: swaps cut short, types that drift."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import standins as given
from tierflow.functions.days import in_days
from tierflow.operators.conform import with_partition_day
from tierflow.plans import conforming
from tierflow.plans.ledger import read_ledger
from tierflow.sinks.partitions import (
    CONFORMED_LAYOUT,
    distinct_days,
    replace_partitions,
    stage_days,
)
from tierflow.sinks.scratch import scratch_path
from tierflow.sinks.upsert import merge_rows, upsert
from tierflow.sources.scans import read_layer

AS_OF = datetime(2024, 1, 15, 6, 0, tzinfo=timezone.utc)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.table(spark, sf_dir, "orders")
    month = F.date_trunc("month", "o_orderdate")
    return with_partition_day(
        orders.select(
            F.col("o_orderkey").alias("k"),
            F.col("o_totalprice").alias("price"),
            month.alias("PartitionDate"),
        )
    )


def _priced(rows: DataFrame, price) -> DataFrame:
    return rows.withColumn("price", F.round(price, 2))


def _interrupted_upsert(source: DataFrame, path: str) -> None:
    """An upsert whose driver dies once its days are staged and noted."""
    spark = source.sparkSession
    days = [r.day for r in distinct_days(source, F.col("PartitionDate").cast("date")).collect()]
    target = read_layer(spark, path).filter(in_days("PartitionDate", days))
    merged = merge_rows(target, source, ["PartitionDate", "k"], CONFORMED_LAYOUT)
    stage_days(merged, path, CONFORMED_LAYOUT)


def upsert_after_interruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged days count from their note on, and later writes win over them."""
    rows, price = _orders(spark, sf_dir), F.col("price")
    path = scratch_path(spark, "interrupted")
    upsert(rows.filter("k % 3 <> 0"), path, ["k"])
    _interrupted_upsert(_priced(rows.filter("k % 2 = 0"), price + 1), path)
    staged = read_layer(spark, path).agg(F.round(F.sum("price"), 2).alias("staged")).first()
    replace_partitions(
        _priced(rows.filter("year = 1997 and k % 5 = 0"), price * 2), path
    )
    _interrupted_upsert(_priced(rows.filter("k % 11 = 0"), price + 4), path)
    upsert(_priced(rows.filter("k % 7 = 0"), price + 3), path, ["k"])
    return read_layer(spark, path).select(
        "k", "price", "PartitionDate", F.lit(staged["staged"]).alias("staged")
    )


def schema_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that widens, one that narrows, a new one, and a change that is refused."""
    key = F.col("k")
    rows = _orders(spark, sf_dir).drop("price")
    path = scratch_path(spark, "widening")

    def written(where: str, **columns) -> None:
        replace_partitions(rows.filter(where).withColumns(columns), path)

    written("year < 1995", v=key.cast("int"), w=(key * 0.5).cast("float"))
    written("year between 1995 and 1996", v=key * 3_000_000_000, w=key * 0.25)
    written("year > 1996", v=(key % 100).cast("smallint"), w=F.lit(1).cast("int"), x=key)
    try:
        written("year > 1996", v=key.cast("string"))
        refused = False
    except ValueError:
        refused = True
    return read_layer(spark, path).select(
        "k", "v", "w", "x", "PartitionDate", F.lit(refused).alias("refused")
    )


def conform_drifting_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw days of text, of numbers, and of numbers of other widths without a column."""
    root, out = scratch_path(spark, "input"), scratch_path(spark, "conformed")
    ledger = scratch_path(spark, "ledger")
    raw = given.raw_text_telemetry(spark, sf_dir)
    kind = F.dayofmonth(F.col("date").cast("date")) % 3
    number = raw.withColumns(
        {
            "event_id": F.col("event_id").cast("bigint"),
            "reading": F.col("reading").cast("double"),
            "linenmbr": F.col("linenmbr").cast("int"),
            "beltids": F.length("beltids"),
        }
    )
    other = raw.withColumns(
        {
            "event_id": F.col("event_id").cast("int"),
            "linenmbr": F.col("linenmbr").cast("smallint"),
            "total": F.col("total").cast("double"),
        }
    ).drop("latest")
    for nth, days in enumerate((raw, number, other)):
        (
            days.filter(kind == nth)
            .hint("rebalance", "date")
            .write.mode("append")
            .partitionBy("date")
            .parquet(conforming.table_path(root, 1))
        )
    where = (spark, root, out, ledger, [given.SPEC])
    conforming.run(*where, "2024-01-04", "2024-01-11", as_of=AS_OF)
    first, last = given.event_bounds(spark, sf_dir)
    conforming.backfill(*where, first, last, as_of=AS_OF)
    return read_layer(spark, conforming.table_path(out, 1)).select(
        "event_id", "reading", "latest", "total", "linenmbr", "beltids", "PartitionDate"
    )


def merge_of_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge whose source has no day is skipped and leaves the dataset alone."""
    root, out = scratch_path(spark, "input"), scratch_path(spark, "conformed")
    ledger = scratch_path(spark, "ledger")
    raw = given.raw_text_telemetry(spark, sf_dir)
    raw.hint("rebalance", "date").write.partitionBy("date").parquet(
        conforming.table_path(root, 1)
    )
    where = (spark, root, out, ledger, [given.SPEC])
    conforming.run(*where, write_mode="merge", as_of=AS_OF)
    conforming.run(*where, "2019-01-01", "2019-01-02", write_mode="merge", as_of=AS_OF)
    held = read_layer(spark, conforming.table_path(out, 1)).agg(
        F.count(F.lit(1)).alias("held"), F.countDistinct("PartitionDate").alias("days")
    )
    log = read_ledger(spark, ledger)
    return log.select("status", "row_count", "partition_count").crossJoin(held)


QUERIES = {
    "upsert_after_interruption": upsert_after_interruption,
    "schema_widening": schema_widening,
    "conform_drifting_types": conform_drifting_types,
    "merge_of_nothing": merge_of_nothing,
}

_MONTHS = """
all_rows as (
  select o_orderkey as k, o_totalprice as price, o_orderdate as d,
    strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as PartitionDate
  from orders)"""


def _upserted(target: str, source: str) -> str:
    return f"""
select t.k, coalesce(s.price, t.price) as price, t.PartitionDate
from {target} t left join {source} s using (PartitionDate, k)
union all
select s.k, s.price, s.PartitionDate
from {source} s anti join {target} t using (PartitionDate, k)"""


ORACLE = {
    "upsert_after_interruption": f"""with {_MONTHS},
first as (select k, price, PartitionDate from all_rows where k % 3 <> 0),
a as (select k, round(price + 1, 2) as price, PartitionDate from all_rows where k % 2 = 0),
one as ({_upserted("first", "a")}),
b as (select k, round(price * 2, 2) as price, PartitionDate from all_rows
  where year(d) = 1997 and k % 5 = 0),
two as (
  select * from one where PartitionDate not in (select PartitionDate from b)
  union all select * from b),
c as (select k, round(price + 4, 2) as price, PartitionDate from all_rows where k % 11 = 0),
three as ({_upserted("two", "c")}),
e as (select k, round(price + 3, 2) as price, PartitionDate from all_rows where k % 7 = 0),
four as ({_upserted("three", "e")})
select *, (select round(sum(price), 2) from one) as staged from four""",
    "schema_widening": f"""with {_MONTHS}
select k,
  case when year(d) < 1995 then k when year(d) < 1997 then k * 3000000000
    else k % 100 end::bigint as v,
  case when year(d) < 1995 then k * 0.5 when year(d) < 1997 then k * 0.25
    else 1 end::double as w,
  case when year(d) > 1996 then k end as x, PartitionDate, true as refused
from all_rows""",
    "conform_drifting_types": """
select event_id, case when event_type <> 'error' then value end as reading,
  case when day(ts) % 3 <> 2 and event_type <> 'click' then value end as latest,
  value as total, (event_id % 4)::int as linenmbr,
  case when day(ts) % 3 = 1 then length(event_type)::varchar else event_type end as beltids,
  strftime(ts, '%Y-%m-%d') as PartitionDate
from events""",
    "merge_of_nothing": """
with held as (select count(*) as held, count(distinct ts::date) as days from events)
select 'SUCCESS' as status, held as row_count, days::int as partition_count, * from held
union all select 'SKIPPED', 0, 0, * from held""",
}
