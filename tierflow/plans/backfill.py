"""Which days still have to be loaded. Ids: INC-5, INC-6, FN-16, JOIN-5, SET-3.

Only days found in data reach the ledger, so an empty day stays open and late
data for it can still arrive.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.days import calendar_days


def wanted_days(tables: DataFrame, first: str, last: str) -> DataFrame:
    """Every ``(table_id, day)`` of each table's window, days as ISO text.

    ``first`` and ``last`` name date columns of ``tables``.
    """
    days = calendar_days(F.col(first).cast("date"), F.col(last).cast("date"))
    calendar = tables.select("table_id", F.explode(days).alias("day"))
    return calendar.withColumn("day", F.col("day").cast("string"))


def missing_days(
    wanted: DataFrame, done: DataFrame, forced: Iterable[int] = ()
) -> DataFrame:
    """Wanted days not done yet; a forced table keeps all of its days.

    ``forced`` says which mode the loader must use: forced days are replaced.
    """
    forced_ids = list(forced)
    is_forced = (
        F.col("table_id").isin(forced_ids) if forced_ids else F.lit(False)
    )
    open_days = wanted.filter(~is_forced).join(done, ["table_id", "day"], "left_anti")
    return (
        open_days.union(wanted.filter(is_forced))
        .withColumn("forced", is_forced)
        .select("table_id", "day", "forced")
    )
