"""Account, house and site lookups. Ids: LKP-1, WIN-1, WIN-2, AGG-12, PRJ-7, SRC-10."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.parsing import bigint_or_null, numeric_suffix
from tierflow.operators.ordinals import number_rows
from tierflow.sources.scans import optional_column, require_columns


@dataclass(frozen=True)
class Lookups:
    """The three dimensions telemetry is enriched with."""

    account: DataFrame
    house: DataFrame
    site: DataFrame


def first_per_key(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the least by ``order`` and then by all other columns.

    An aggregate instead of a window: copies of a key shrink before the shuffle.
    """
    ranked = [*order, *[c for c in frame.columns if c not in {*keys, *order}]]
    kept = frame.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__kept"))
    return kept.select(
        *[
            F.col(c) if c in keys else F.col(f"__kept.{c}").alias(c)
            for c in frame.columns
        ]
    )


def account_lookup(accounts: DataFrame) -> DataFrame:
    """``AccountRowId`` and ``Customer``, one row per id."""
    require_columns(accounts, ("Id", "Name"), "the account lookup")
    named = accounts.select(
        bigint_or_null("Id").alias("AccountRowId"),
        F.col("Name").cast("string").alias("Customer"),
    ).dropna(subset=["AccountRowId"])
    return named.groupBy("AccountRowId").agg(F.min("Customer").alias("Customer"))


def house_lookup(houses: DataFrame) -> DataFrame:
    """Houses with their ordinal inside the account, one row per house id.

    Ordinals are join keys: they are given before duplicates go, so a duplicate
    leaves a gap.  The survivor is the one with the lowest ordinal.
    """
    require_columns(houses, ("Id", "AccountId", "Name"), "the house lookup")
    named = houses.select(
        bigint_or_null("Id").alias("HouseRowId"),
        bigint_or_null("AccountId").alias("HouseAccountRowId"),
        F.col("Name").cast("string").alias("HouseName"),
        numeric_suffix("Name").alias("HouseNameOrdinalKey"),
        optional_column(houses, "Alias").alias("HouseAlias"),
        optional_column(houses, "Town").alias("HouseTown"),
    ).dropna(subset=["HouseRowId", "HouseAccountRowId"])
    numbered = number_rows(
        named,
        ["HouseAccountRowId"],
        [F.col("HouseNameOrdinalKey").asc_nulls_last(), F.col("HouseRowId").asc()],
        "HouseOrdinal",
    )
    return first_per_key(numbered, ["HouseRowId"], ["HouseOrdinal"])


def site_lookup(sites: DataFrame) -> DataFrame:
    """Sites with their ordinal inside the site key, one row per key and row id."""
    require_columns(sites, ("SiteId", "Name"), "the site lookup")
    named = sites.select(
        bigint_or_null("SiteId").alias("SiteIdKey"),
        bigint_or_null(optional_column(sites, "Id")).alias("SiteRowId"),
        F.col("Name").cast("string").alias("SiteName"),
        numeric_suffix("Name").alias("SiteNameOrdinalKey"),
        optional_column(sites, "Alias").alias("SiteAlias"),
        optional_column(sites, "Location").alias("SiteLocation"),
    ).dropna(subset=["SiteIdKey"])
    numbered = number_rows(
        named,
        ["SiteIdKey"],
        [
            F.col("SiteNameOrdinalKey").asc_nulls_last(),
            F.col("SiteRowId").asc_nulls_last(),
        ],
        "SiteOrdinal",
    )
    return first_per_key(numbered, ["SiteIdKey", "SiteRowId"], ["SiteOrdinal"])


def build_lookups(
    accounts: DataFrame, houses: DataFrame, sites: DataFrame
) -> Lookups:
    return Lookups(account_lookup(accounts), house_lookup(houses), site_lookup(sites))
