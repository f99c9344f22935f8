"""Conform raw rows to a declared schema. Ids: PRJ-1, PRJ-2, PRJ-3, SRC-11."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.parsing import text_to_date, text_to_timestamp

REJECTED = "__rejected"


def _conformed(name: str, have: T.DataType, want: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(have, T.StringType) and isinstance(want, T.TimestampType):
        return text_to_timestamp(value)
    if isinstance(have, T.StringType) and isinstance(want, T.DateType):
        return text_to_date(value)
    return value.try_cast(want)


def conform(
    frame: DataFrame, declared: Mapping[str, T.DataType], rejects: str | None = None
) -> DataFrame:
    """Bring declared columns to their declared types in one projection.

    Columns already of the declared type, undeclared columns and the column
    order stay.  A value that does not convert becomes NULL; with ``rejects``
    a column of that name counts such values per row.
    """
    columns: list[Column] = []
    failures: list[Column] = []
    for field in frame.schema.fields:
        want = declared.get(field.name)
        raw = F.col(f"`{field.name}`")
        if want is None or type(want) is type(field.dataType):
            columns.append(raw)
            continue
        value = _conformed(field.name, field.dataType, want)
        columns.append(value.alias(field.name))
        failures.append((raw.isNotNull() & value.isNull()).cast("int"))
    if rejects is not None:
        columns.append(sum(failures, F.lit(0)).alias(rejects))
    return frame.select(*columns)


def with_partition_day(frame: DataFrame) -> DataFrame:
    """Set ``PartitionDate`` (ISO text), ``year`` and ``month``; drop dayless rows.

    The day comes from ``PartitionDate``, else from the raw ``date`` column.
    """
    source = next((c for c in ("PartitionDate", "date") if c in frame.columns), None)
    if source is None:
        raise ValueError("neither PartitionDate nor date is present")
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(frame.schema[source].dataType, temporal):
        day = F.to_date(F.col(source))
    else:
        day = text_to_date(F.col(source).cast("string"))
    return frame.withColumns(
        {
            "PartitionDate": day.cast("string"),
            "year": F.year(day),
            "month": F.month(day),
        }
    ).filter(F.col("PartitionDate").isNotNull())


def with_lineage(
    frame: DataFrame,
    table_id: int,
    source_system: str = "unknown",
    as_of: datetime | None = None,
) -> DataFrame:
    """Add table, system, file and ingestion time to rows of a file scan.

    ``as_of`` (zone-aware) fixes the clock; by default it is now.
    """
    moment = as_of or datetime.now(timezone.utc)
    clock = F.lit(as_of) if as_of is not None else F.current_timestamp()
    return frame.withColumns(
        {
            "source_table_id": F.lit(table_id),
            "source_system": F.lit(source_system),
            "source_file_path": F.col("_metadata.file_path"),
            "ingestion_date": F.lit(
                moment.astimezone(timezone.utc).date().isoformat()
            ),
            "ingested_at_utc": clock,
        }
    )
