"""Which type holds the values of two. Ids: SNK-6, SRC-5."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole numbers, the narrowest first.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EXACT_IN_DOUBLE = _WHOLE[:3]


def wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type that holds every value of both exactly, None if there is none.

    These are the changes that Parquet files of the narrower type are read through.
    """
    if one.simpleString() == other.simpleString():
        return one
    return _up(one, other) or _up(other, one)


def _up(low: T.DataType, high: T.DataType) -> T.DataType | None:
    """A type for both where ``high``, or one made from it, also holds ``low``."""
    if isinstance(low, T.NullType):
        return high
    if isinstance(low, _WHOLE):
        if isinstance(high, _WHOLE) and _WHOLE.index(type(low)) < _WHOLE.index(type(high)):
            return high
        if isinstance(high, T.DoubleType) and isinstance(low, _EXACT_IN_DOUBLE):
            return high
        if isinstance(high, T.DecimalType):
            # Files hold the narrower three alike, in 32 bits.
            return _decimal(20 if isinstance(low, T.LongType) else 10, 0, high)
    if isinstance(low, T.FloatType) and isinstance(high, T.DoubleType):
        return high
    if isinstance(low, T.DecimalType) and isinstance(high, T.DecimalType):
        return _decimal(low.precision - low.scale, low.scale, high)
    if isinstance(low, T.DateType) and isinstance(high, T.TimestampNTZType):
        return high
    return None


def _decimal(whole: int, scale: int, other: T.DecimalType) -> T.DecimalType | None:
    scale = max(scale, other.scale)
    precision = max(whole, other.precision - other.scale) + scale
    return T.DecimalType(precision, scale) if precision <= 38 else None


def merged_schema(
    held: T.StructType, new: T.StructType, fixed: Iterable[str] = ()
) -> T.StructType:
    """Columns of both, ``held`` first, each wide enough for both.

    A column whose types no type holds is an error.  A ``fixed`` one, a directory level,
    keeps the type it has.
    """
    fields = {f.name: f for f in held.fields}
    clashes = []
    for field in new.fields:
        known = fields.get(field.name)
        kind = field.dataType if known is None else wider(known.dataType, field.dataType)
        if known is not None and field.name in set(fixed):
            kind = kind and known.dataType
        if kind is None:
            clashes.append(
                f"{field.name}: {known.dataType.simpleString()} and "
                f"{field.dataType.simpleString()}"
            )
        else:
            fields[field.name] = T.StructField(field.name, kind)
    if clashes:
        raise ValueError(f"columns cannot change their type: {'; '.join(clashes)}")
    return T.StructType(list(fields.values()))


def as_types(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with each column in the type that ``schema`` has for it."""
    wanted = {f.name: f.dataType for f in schema.fields}
    return frame.select(
        *[
            F.col(f"`{f.name}`").cast(wanted[f.name]).alias(f.name)
            if wanted.get(f.name, f.dataType).simpleString() != f.dataType.simpleString()
            else F.col(f"`{f.name}`")
            for f in frame.schema.fields
        ]
    )


def united(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames whose columns differ in number and type.

    A column has the type wide enough for all frames, else it is text.
    """
    kinds: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            known = kinds.get(field.name)
            kind = field.dataType if known is None else wider(known, field.dataType)
            kinds[field.name] = kind or T.StringType()
    common = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
    first, *rest = [as_types(frame, common) for frame in frames]
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
