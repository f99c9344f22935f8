"""Declared table schemas. Id: SRC-3."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Configuration type names and the Spark types that hold them.
# Unsigned types take the next wider signed one; UInt64 stays bigint, and
# values past its range become NULL.
TYPE_NAMES: dict[str, T.DataType] = {
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.LongType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "Utf8": T.StringType(),
    "String": T.StringType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "Datetime": T.TimestampType(),
}


def spark_type(name: str) -> T.DataType:
    if name not in TYPE_NAMES:
        raise ValueError(f"unsupported type name {name!r}; known: {sorted(TYPE_NAMES)}")
    return TYPE_NAMES[name]


@dataclass(frozen=True)
class TableSpec:
    """What is declared about one table."""

    table_id: int
    columns: Mapping[str, T.DataType] = field(default_factory=dict)
    metrics: Mapping[str, str] = field(default_factory=dict)
    merge_keys: tuple[str, ...] = ()
    source_system: str = "unknown"

    @classmethod
    def from_config(
        cls,
        table_id: int,
        shared: Mapping[str, str],
        own: Mapping,
        source_system: str = "unknown",
    ) -> TableSpec:
        """Join shared and per-table declarations; the table's own one wins.

        The flag, float and datetime column lists are accepted and not used.
        """
        names = dict(shared) | dict(own.get("schema", {}))
        how = own.get("aggregation_map", {})
        return cls(
            table_id=table_id,
            columns={column: spark_type(name) for column, name in names.items()},
            metrics={m: how.get(m) or "mean" for m in own.get("numeric_columns", [])},
            merge_keys=tuple(own.get("merge_keys", ())),
            source_system=source_system,
        )


def read_table_spec(spark: SparkSession, folder: str, table_id: int) -> TableSpec:
    """Read the three small JSON files that describe a table."""

    def document(name: str) -> dict:
        text = spark.read.text(f"{folder}/{name}.json", wholetext=True).first()
        return json.loads(text.value)

    known = document("table_metadata").get("tables", {}).get(str(table_id), {})
    return TableSpec.from_config(
        table_id,
        document("base_schema"),
        document(f"table_{table_id}"),
        known.get("source_system", "unknown"),
    )
