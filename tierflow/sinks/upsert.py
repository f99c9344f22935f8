"""Keyed upsert without a transactional table format. Ids: SNK-3, SNK-5, JOIN-4.

Rules: rows match on the day and the merge keys with plain equality, so NULL
keys never match; a match takes every source column; target-only rows and
target-only columns stay; several source rows for one target row are an error;
the first write does not deduplicate; a source column the target lacks is an
error, because an upsert does not evolve the target.

Shape: a full outer join could do it in one pass, but adaptive execution cannot
split a hot key there.  Updates are a left join of the touched target days with
the source, whose hot side can be split.  Inserts are an anti join against the
distinct target keys, where no side can hold a hot key any more.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.days import in_days
from tierflow.sinks.partitions import (
    CONFORMED_LAYOUT,
    WriteReport,
    replace_partitions,
    swap_days,
)
from tierflow.sinks.scratch import drop_path, scratch_path, scratch_root
from tierflow.sinks.swap import finish_swap
from tierflow.sources.scans import dataset_exists, read_layer, require_columns

_MATCHED = "__matched"


def merge_rows(
    target: DataFrame, source: DataFrame, keys: list[str], layout: tuple[str, ...]
) -> DataFrame:
    """Target days after the upsert, in target column order, lazily.

    ``source`` keys that occur twice must not occur in the target.
    """
    unknown = [name for name in source.columns if name not in target.columns]
    if unknown:
        raise ValueError(f"an upsert cannot add the columns {unknown} to the target")
    types = {field.name: field.dataType for field in target.schema.fields}
    source = source.select(
        *[F.col(name).cast(types[name]).alias(name) for name in source.columns]
    )
    no_key = reduce(or_, [F.col(key).isNull() for key in keys])
    keyed = source.filter(~no_key)

    fixed = set(keys) | set(layout)
    incoming = keyed.select(
        *[F.col(key).alias(f"__{key}") for key in keys],
        *[F.col(c).alias(f"__{c}") for c in source.columns if c not in fixed],
        F.lit(True).alias(_MATCHED),
    )
    same = [F.col(key) == F.col(f"__{key}") for key in keys]
    updated = target.join(incoming, same, "left").select(
        *[
            F.when(F.col(_MATCHED), F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
            if c in source.columns and c not in fixed
            else F.col(c)
            for c in target.columns
        ]
    )

    known = target.select(*keys).filter(~no_key).distinct()
    inserted = keyed.join(known, keys, "left_anti").select(*source.columns)
    keyless = source.filter(no_key)
    return updated.unionByName(
        inserted.unionByName(keyless), allowMissingColumns=True
    ).select(*target.columns)


def upsert(
    source: DataFrame,
    path: str,
    merge_keys: list[str] | tuple[str, ...],
    layout: tuple[str, ...] = CONFORMED_LAYOUT,
    rejected: str | None = None,
    local_day: Callable[[DataFrame], Column] | None = None,
) -> WriteReport:
    """Upsert ``source`` into the dataset at ``path``; the first write creates it.

    The report counts the source rows, as the caller's ledger expects.
    ``rejected`` names a per-row count that is summed and not written; ``local_day`` is
    as in ``replace_partitions``, over the days as they are afterwards.
    """
    if not merge_keys:
        raise ValueError("an upsert needs merge keys; replace the partitions instead")
    require_columns(source, merge_keys, "the upsert source")
    spark = source.sparkSession
    finish_swap(spark, path)
    if not dataset_exists(spark, path):
        return replace_partitions(source, path, layout, rejected, local_day=local_day)

    # The source may be a long chain; its rows are made once and used from there.
    kept = scratch_path(spark, "upsert-source")
    source.write.parquet(kept)
    source = spark.read.schema(source.schema).parquet(kept)
    try:
        return _upsert_kept(source, path, list(merge_keys), layout, rejected, local_day)
    finally:
        drop_path(spark, kept)


def _upsert_kept(
    source: DataFrame,
    path: str,
    merge_keys: list[str],
    layout: tuple[str, ...],
    rejected: str | None,
    local_day: Callable[[DataFrame], Column] | None,
) -> WriteReport:
    spark = source.sparkSession
    day = layout[-1]
    keys = [day, *[key for key in merge_keys if key != day]]
    per_key = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"),
        F.sum(F.col(rejected) if rejected else F.lit(0)).alias("rejected"),
    )
    complete = ~reduce(or_, [F.col(key).isNull() for key in keys])
    summary = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"),
        F.collect_set(day).alias("days"),
        F.coalesce(F.max(F.when(complete, F.col("copies"))), F.lit(0)).alias("most"),
    ).first()
    days = tuple(sorted(summary["days"]))
    if not days:
        return WriteReport(rows=0, days=(), seconds=0.0)

    if rejected:
        source = source.drop(rejected)
    target = read_layer(spark, path, day_column=day).filter(in_days(day, days))
    repeats = None
    if summary["most"] > 1:
        source, repeats = _set_repeats_aside(source, target, per_key, complete, keys)
    merged = merge_rows(target, source, keys, layout)
    if repeats is not None:
        merged = merged.unionByName(repeats, allowMissingColumns=True)
    report = swap_days(merged, path, layout, local_day)
    return WriteReport(
        summary["rows"], days, report.seconds, summary["rejected"], report.local_days
    )


def _set_repeats_aside(
    source: DataFrame,
    target: DataFrame,
    per_key: DataFrame,
    complete,
    keys: list[str],
) -> tuple[DataFrame, DataFrame]:
    """Split off source rows whose key repeats, after proving none of them match.

    Both join inputs come straight from checkpointed rows, so a key with very
    many copies is a plain skewed shuffle that adaptive execution can split.
    """
    scratch_root(source.sparkSession)
    repeated = (
        per_key.filter(complete & (F.col("copies") > 1)).select(*keys).checkpoint()
    )
    known = target.select(*keys).distinct()
    if not repeated.join(known, keys, "left_semi").isEmpty():
        raise ValueError(f"several source rows match one target row on {keys}")
    columns = source.columns
    single = source.join(repeated, keys, "left_anti").select(*columns).checkpoint()
    repeats = source.join(repeated, keys, "left_semi").select(*columns)
    return single, repeats
