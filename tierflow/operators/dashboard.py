"""Enrichment of telemetry with the lookups. Ids: JOIN-1 to JOIN-3, PRJ-10, PRJ-11.

All joins are left equi joins.  No side is forced to broadcast: Spark compares
the measured size of each lookup with its broadcast threshold and shuffles both
sides beyond it.  A shuffled left join would send every row with a NULL key to
one task, so such rows carry a spread value in the join key; they match nothing
either way.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.parsing import (
    EVENT_TIME_CANDIDATES,
    bigint_or_null,
    normalize_identifier,
)
from tierflow.operators.lookups import Lookups
from tierflow.sources.scans import require_columns

_SPREAD = 4096
_SPREAD_BY = ("Date", *EVENT_TIME_CANDIDATES, "AccountId", "SiteId")


def house_set(frame: DataFrame) -> Column:
    """Cleaned ``HouseIdSet``: blank or absent falls back to ``SiteId``.

    A NULL set stays NULL: it is not the same as a blank one.
    """
    site = F.col("SiteId").cast("string")
    if "HouseIdSet" not in frame.columns:
        return site
    cleaned = normalize_identifier("HouseIdSet")
    return F.when(cleaned == "", site).otherwise(cleaned)


def identified(frame: DataFrame) -> DataFrame:
    """Telemetry with its three identifiers as text, ``HouseIdSet`` cleaned."""
    require_columns(frame, ("AccountId", "SiteId"), "the telemetry")
    return frame.withColumns(
        {
            "AccountId": F.col("AccountId").cast("string"),
            "SiteId": F.col("SiteId").cast("string"),
            "HouseIdSet": house_set(frame),
        }
    )


def _left_lookup(
    facts: DataFrame, lookup: DataFrame, pairs: list[tuple[Column, str]]
) -> DataFrame:
    keys = [f"__key{i}" for i in range(len(pairs))]
    keyed = facts.withColumns({k: value for k, (value, _) in zip(keys, pairs)})
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    spread_by = [c for c in _SPREAD_BY if c in facts.columns]
    spread = F.when(
        no_key, 1 + F.pmod(F.xxhash64(*spread_by), F.lit(_SPREAD))
    ).otherwise(F.lit(0))
    keyed = keyed.withColumn("__spread", spread)
    # Zero for every lookup row, yet not a literal: Spark would fold that into a
    # residual condition and leave the spread out of the shuffle key.
    lookup = lookup.withColumn("__still", F.pmod(F.col(pairs[0][1]), F.lit(1)))
    same = [F.col(k) == F.col(column) for k, (_, column) in zip(keys, pairs)]
    joined = keyed.join(
        lookup, [*same, F.col("__spread") == F.col("__still")], "left"
    )
    return joined.drop(*keys, "__spread", "__still")


def enrich(frame: DataFrame, lookups: Lookups) -> DataFrame:
    """Join identified rows to site, house and account.

    A site row id listed under several site keys fans out, by design.  The house
    join pairs the telemetry's site with the house's account and the two
    ordinals with each other, as the source data does.  Columns of the frame
    that carry a lookup column's name give way to it.
    """
    supplied = {
        *lookups.site.columns,
        *lookups.house.columns,
        *lookups.account.columns,
        "HouseId",
    }
    rows = frame.drop(*[c for c in frame.columns if c in supplied])
    rows = _left_lookup(
        rows, lookups.site, [(bigint_or_null("HouseIdSet"), "SiteRowId")]
    )
    rows = _left_lookup(
        rows,
        lookups.house,
        [
            (bigint_or_null("SiteId"), "HouseAccountRowId"),
            (F.col("SiteOrdinal"), "HouseOrdinal"),
        ],
    )
    rows = _left_lookup(
        rows, lookups.account, [(bigint_or_null("AccountId"), "AccountRowId")]
    )
    return rows.withColumn("HouseId", F.col("AccountId"))


def dashboard(telemetry: DataFrame, lookups: Lookups) -> DataFrame:
    """Row-level telemetry with customer, house and site names."""
    return enrich(identified(telemetry), lookups)
