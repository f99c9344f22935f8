"""Position bins of the belt profile. Ids: FN-4, FN-5, FN-6."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The profile has 100 bins; the clamp keeps 100 % in the last one.
BIN_COUNT = 100
LOWEST, HIGHEST = 0.0, 99.999


def position_bin(value: str | Column) -> Column:
    """Clamp to the profile and floor to a bin; NULL stays NULL, NaN is last.

    The NULL guard matters: ``greatest`` skips NULL and would answer bin 0.
    """
    source = F.col(value) if isinstance(value, str) else value
    number = source.try_cast("double")
    clamped = F.least(F.greatest(number, F.lit(LOWEST)), F.lit(HIGHEST))
    return F.when(number.isNotNull(), F.floor(clamped).cast("int"))


def cell_value(value: str | Column) -> Column:
    """Increment as double, NULL counts as zero."""
    source = F.col(value) if isinstance(value, str) else value
    return F.coalesce(source.try_cast("double"), F.lit(0.0))


def bin_label(index: int) -> str:
    """Column name of a bin in the wide matrix."""
    return f"pos_{index:03d}"
