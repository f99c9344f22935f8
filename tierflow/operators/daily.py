"""Daily metric statistics per house. Ids: AGG-1 to AGG-6, SRT-1.

Every metric is held as a few mergeable partial columns (sum, count, extremes,
last value with its time).  That allows two equal plans:

* ``daily_stats`` aggregates enriched rows once;
* ``enriched_daily_stats`` first reduces telemetry to one row per day and
  identifiers, joins the lookups to that small result and merges.  The joins
  then never see raw rows, and a hot account has already shrunk on the map side.

All partial columns have fixed width, so Spark keeps to hash aggregation; a
``struct`` ordering for the last value would force a sort of the raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, time, timedelta, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.parsing import epoch_micros, event_time_column
from tierflow.operators.dashboard import enrich, identified
from tierflow.operators.lookups import Lookups
from tierflow.sources.scans import require_columns

# Grouping columns of the published daily statistics.
IDENTITY = (
    "Date",
    "AccountId",
    "SiteId",
    "Customer",
    "HouseIdSet",
    "HouseId",
    "HouseName",
    "HouseAlias",
    "SiteName",
    "SiteAlias",
)

# Identity columns telemetry itself carries; the rest follow from the lookups.
TELEMETRY_IDENTITY = ("Date", "AccountId", "SiteId", "HouseIdSet")

# Presentation order.
DISPLAY_ORDER = ("Date", "Customer", "HouseIdSet", "HouseId")

_ROWS = "__rows"
_LATEST = "__latest"
_WHEN = "__when"


@dataclass(frozen=True)
class _Partial:
    """How one partial column is computed from rows and merged with its like."""

    suffix: str
    from_rows: Callable[[Column, Column | None], Column]
    merge: Callable[[str], Column]


_COUNT = _Partial("count", lambda m, t: F.count(m), lambda p: F.sum(p))
_TOTAL = _Partial("total", lambda m, t: F.sum(m), lambda p: F.sum(p))
_REAL_TOTAL = _Partial(
    "real_total", lambda m, t: F.sum(m.cast("double")), lambda p: F.sum(p)
)
_HIGH = _Partial("high", lambda m, t: F.max(m), lambda p: F.max(p))
_LOW = _Partial("low", lambda m, t: F.min(m), lambda p: F.min(p))
_LAST_AT = _Partial(
    "last_at", lambda m, t: F.max(F.when(m.isNotNull(), t)), lambda p: F.max(p)
)
_LAST = _Partial(
    "last",
    lambda m, t: F.max_by(m, F.when(m.isNotNull(), t)),
    lambda p: F.max_by(p, F.col(f"{p}_at")),
)

# Aggregate name -> partial columns, and the result from a column getter.
_AGGREGATES: dict[str, tuple[tuple[_Partial, ...], Callable]] = {
    "sum": ((_TOTAL,), lambda part: part(_TOTAL)),
    "max": ((_HIGH,), lambda part: part(_HIGH)),
    "min": ((_LOW,), lambda part: part(_LOW)),
    "last": ((_LAST, _LAST_AT), lambda part: part(_LAST)),
    "delta": ((_HIGH, _LOW), lambda part: part(_HIGH) - part(_LOW)),
    "mean": (
        (_REAL_TOTAL,),
        lambda part: F.try_divide(part(_REAL_TOTAL), part(_COUNT)),
    ),
}


def aggregate_name(how: str | None) -> str:
    """Canonical aggregate; blank or unknown names mean the mean."""
    name = (how or "mean").lower()
    return name if name in _AGGREGATES else "mean"


def recency(moment: Column, dtype: T.DataType, tie_break: Column) -> Column:
    """One fixed-width number that orders by time and then by a bigint.

    Used to pick the last value repeatably when several rows share a time.
    """
    shifted = epoch_micros(moment, dtype).cast("decimal(18,0)") * F.lit(Decimal(10**20))
    # A row without a tie break comes before any other of its time.
    tie = F.coalesce(tie_break.cast("bigint"), F.lit(-(2**63)))
    return (shifted + tie.cast("decimal(19,0)")).cast("decimal(38,0)")


def _plan(metrics: Mapping[str, str]) -> list[tuple[str, _Partial]]:
    return [
        (metric, partial)
        for metric, how in metrics.items()
        for partial in (_COUNT, *_AGGREGATES[aggregate_name(how)][0])
    ]


def _name(metric: str, partial: _Partial) -> str:
    return f"__{metric}_{partial.suffix}"


def _reduced(
    rows: DataFrame,
    keys: tuple[str, ...],
    metrics: Mapping[str, str],
    time_column: str,
    tie_break: str | None,
) -> DataFrame:
    last = [m for m, how in metrics.items() if aggregate_name(how) == "last"]
    if last:
        dtype = rows.schema[time_column].dataType
        ties = {
            m: F.col(tie_break) if tie_break else F.xxhash64(F.col(f"`{m}`"))
            for m in (last[:1] if tie_break else last)
        }
        rows = rows.withColumns(
            {
                f"{_WHEN}_{m}": recency(F.col(time_column), dtype, tie)
                for m, tie in ties.items()
            }
        )

    def order_of(metric: str) -> Column | None:
        if metric not in last:
            return None
        return F.col(f"{_WHEN}_{last[0] if tie_break else metric}")

    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_ROWS),
        *[
            partial.from_rows(F.col(f"`{metric}`"), order_of(metric)).alias(
                _name(metric, partial)
            )
            for metric, partial in _plan(metrics)
        ],
        F.max(time_column).alias(_LATEST),
    )


def _merged(
    reduced: DataFrame, keys: tuple[str, ...], metrics: Mapping[str, str]
) -> DataFrame:
    return reduced.groupBy(*keys).agg(
        F.sum(_ROWS).alias(_ROWS),
        *[
            partial.merge(_name(metric, partial)).alias(_name(metric, partial))
            for metric, partial in _plan(metrics)
        ],
        F.max(_LATEST).alias(_LATEST),
    )


def _finished(
    reduced: DataFrame,
    keys: tuple[str, ...],
    metrics: Mapping[str, str],
    as_of: datetime | None,
) -> DataFrame:
    rows = F.col(_ROWS)

    def value(metric: str, how: str) -> Column:
        finish = _AGGREGATES[aggregate_name(how)][1]
        return finish(lambda partial: F.col(_name(metric, partial)))

    def nulls(metric: str) -> Column:
        return rows - F.col(_name(metric, _COUNT))

    return reduced.select(
        *keys,
        rows.alias("row_count"),
        # The alias says mean whatever the aggregate: a published contract.
        *[value(m, how).alias(f"{m}_mean") for m, how in metrics.items()],
        *[nulls(m).alias(f"{m}_null_count") for m in metrics],
        F.col(_LATEST).alias("last_record_local_ts"),
        *[(nulls(m) / rows).alias(f"{m}_null_fraction") for m in metrics],
        *day_progress("Date", as_of),
    )


def day_progress(day: str, as_of: datetime | None = None) -> list[Column]:
    """Elapsed UTC hours and fraction of the day ``as_of`` falls in, else all of it."""
    now = (as_of or datetime.now(timezone.utc)).astimezone(timezone.utc)
    midnight = datetime.combine(now.date(), time.min, timezone.utc)
    hours = (now.replace(microsecond=0) - midnight) / timedelta(hours=1)
    today = F.col(day) == F.lit(now.date())
    return [
        F.when(today, F.lit(hours)).otherwise(F.lit(24.0)).alias("elapsed_utc_hours"),
        F.when(today, F.lit(hours / 24.0))
        .otherwise(F.lit(1.0))
        .alias("day_progress_fraction"),
    ]


def _dated(frame: DataFrame, metrics: Mapping[str, str]) -> tuple[DataFrame, dict, str]:
    """Rows with a ``Date``, the metrics that exist, and the event-time column."""
    present = {m: how for m, how in metrics.items() if m in frame.columns}
    if not present:
        raise ValueError(f"none of the metrics {list(metrics)} is in the data")
    dated = frame.withColumn("Date", local_day(frame)).filter(F.col("Date").isNotNull())
    return dated, present, event_time_column(frame.columns)


def local_day(frame: DataFrame) -> Column:
    """Calendar day of the event time."""
    time_column = event_time_column(frame.columns)
    if isinstance(frame.schema[time_column].dataType, T.StringType):
        return F.col(time_column).try_cast("date")
    return F.to_date(time_column)


def daily_stats(
    rows: DataFrame,
    metrics: Mapping[str, str],
    as_of: datetime | None = None,
    tie_break: str | None = None,
    keys: tuple[str, ...] = IDENTITY,
) -> DataFrame:
    """Statistics of enriched rows per day and identity.

    ``metrics`` maps a metric to sum, max, min, last, delta or mean; metrics
    missing from the data are skipped.  ``tie_break`` names a bigint column that
    decides ``last`` among equal times; without it a hash of the value does.
    """
    dated, present, time_column = _dated(rows, metrics)
    reduced = _reduced(dated, keys, present, time_column, tie_break)
    return _finished(reduced, keys, present, as_of)


def enriched_daily_stats(
    telemetry: DataFrame,
    lookups: Lookups,
    metrics: Mapping[str, str],
    as_of: datetime | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """``daily_stats`` of the dashboard rows, aggregated before the joins.

    The first step groups by the identifiers as they come; they are cleaned on
    the reduced rows, and the merge unites those that clean to the same text.
    """
    require_columns(telemetry, ("AccountId", "SiteId"), "the telemetry")
    dated, present, time_column = _dated(telemetry, metrics)
    keys = tuple(c for c in TELEMETRY_IDENTITY if c in dated.columns)
    reduced = _reduced(dated, keys, present, time_column, tie_break)
    merged = _merged(enrich(identified(reduced), lookups), IDENTITY, present)
    return _finished(merged, IDENTITY, present, as_of)


def metric_value(
    rows: DataFrame,
    keys: list[str],
    metric: str,
    how: str,
    time_column: str | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """One metric aggregate and its NULL share per group."""
    time_column = time_column or event_time_column(rows.columns)
    metrics = {metric: how}
    reduced = _reduced(rows, tuple(keys), metrics, time_column, tie_break)
    finish = _AGGREGATES[aggregate_name(how)][1]
    nulls = F.col(_ROWS) - F.col(_name(metric, _COUNT))
    return reduced.select(
        *keys,
        F.col(_ROWS).alias("row_count"),
        finish(lambda partial: F.col(_name(metric, partial))).alias(f"{metric}_mean"),
        nulls.alias(f"{metric}_null_count"),
        (nulls / F.col(_ROWS)).alias(f"{metric}_null_fraction"),
    )


def for_display(stats: DataFrame) -> DataFrame:
    """Global presentation order; writes do without it."""
    return stats.orderBy(*DISPLAY_ORDER)
