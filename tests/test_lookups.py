from __future__ import annotations

import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tierflow.operators.dashboard import dashboard
from tierflow.operators.lookups import (
    Lookups,
    account_lookup,
    build_lookups,
    house_lookup,
    site_lookup,
)
from tierflow.operators.ordinals import number_rows, running_totals


def test_account_lookup(spark):
    raw = spark.createDataFrame(
        [("1", "Ann"), (" 1 ", "Bob"), ("x", "Eve"), ("2", None), ("", "Kim")],
        "Id string, Name string",
    )
    assert rows_of(account_lookup(raw)) == [(1, "Ann"), (2, None)]


def test_house_ordinals_are_given_before_duplicates_go(spark):
    raw = spark.createDataFrame(
        [
            ("1", "5", "House 2"),
            ("1", "5", "House 2"),
            ("2", "5", "House 10"),
            ("3", "5", "Annex"),
            ("4", "", "House 1"),
        ],
        "Id string, AccountId string, Name string",
    )
    got = house_lookup(raw)
    assert {r.HouseRowId: r.HouseOrdinal for r in got.collect()} == {1: 1, 2: 3, 3: 4}
    assert dict(got.dtypes)["HouseOrdinal"] == "int"


def test_site_lookup_keeps_a_row_id_per_site_key(spark):
    raw = spark.createDataFrame(
        [("10", "1", "S 2", "a"), ("10", "2", "S 1", "b"), (None, "1", "S 3", "c")],
        "Id string, SiteId string, Name string, Alias string",
    )
    got = [(r.SiteIdKey, r.SiteRowId, r.SiteOrdinal, r.SiteAlias) for r in site_lookup(raw).collect()]
    assert sorted(got, key=repr) == [(1, 10, 1, "a"), (1, None, 2, "c"), (2, 10, 1, "b")]


def test_site_lookup_without_row_ids(spark):
    raw = spark.createDataFrame([("1", "S 2"), ("1", "S 1")], "SiteId string, Name string")
    got = site_lookup(raw).collect()
    assert [(r.SiteName, r.SiteOrdinal, r.SiteRowId) for r in got] == [("S 1", 1, None)]


@pytest.mark.parametrize("build", [account_lookup, house_lookup, site_lookup])
def test_missing_lookup_columns(spark, build):
    with pytest.raises(ValueError):
        build(spark.range(1))


@pytest.mark.parametrize("slices", [1, 3, 8, 40])
def test_numbering_is_the_same_for_every_number_of_slices(spark, conf, slices):
    """A group with most rows, a NULL group, many copies and NULL order values."""
    conf("spark.sql.shuffle.partitions", str(slices))
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(3)
    rows = [
        (
            0 if rng.random() < 0.6 else rng.choice([None, 1, 2, 3]),
            rng.choice([None, *range(-3, 40)]),
            rng.choice([None, *range(60)]),
        )
        for _ in range(1500)
    ]
    rows += [(0, 7, 7)] * 500 + [(None, None, None)] * 3
    frame = spark.createDataFrame(rows, "g int, k int, v int")
    order = [F.col("k").asc_nulls_last(), F.col("v").asc_nulls_last()]
    groups = defaultdict(list)
    for g, k, v in rows:
        groups[g].append((k is None, k or 0, v is None, v or 0, k, v))
    want = sorted(
        (repr(g), place, repr(k), repr(v))
        for g, members in groups.items()
        for place, (*_, k, v) in enumerate(sorted(members, key=lambda m: m[:4]), 1)
    )
    numbered = number_rows(frame, ["g"], order, "n")
    got = sorted((repr(r.g), r.n, repr(r.k), repr(r.v)) for r in numbered.collect())
    assert got == want


def test_running_totals_add_and_combine(spark, conf):
    conf("spark.sql.shuffle.partitions", "7")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(4)
    rows = [(rng.choice([None, 0, 0, 0, 1]), i, rng.randint(-9, 9), rng.getrandbits(60)) for i in range(900)]
    frame = spark.createDataFrame(rows, "g int, i int, a int, x long")
    got = running_totals(frame, ["g"], [F.col("i")], {"a_sum": F.col("a")}, {"x": F.col("x")})
    assert got.columns == ["g", "i", "a", "a_sum", "x"]
    seen = {(r.g, r.i): (r.a_sum, r.x) for r in got.collect()}
    totals = defaultdict(lambda: (0, 0))
    for g, i, a, x in rows:
        assert seen[g, i] == totals[g]
        totals[g] = (totals[g][0] + a, totals[g][1] ^ x)


@pytest.mark.parametrize("suffix", ["id + 1", "7"])
def test_a_hot_account_covers_many_slices(spark, conf, suffix):
    """Houses of one account, by their number or by their row id alone."""
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    houses = spark.range(0, 40_000, 1, 4).selectExpr(
        "id as Id", "if(id % 10 = 0, id, 5) as AccountId", f"concat('House ', {suffix}) as Name"
    )
    got = house_lookup(houses)
    assert got.filter("HouseAccountRowId = 5").agg(F.max("HouseOrdinal")).first()[0] == 36_000
    sliced = spark.read.parquet(_newest_slices(spark))
    held = [r["count"] for r in sliced.filter("HouseAccountRowId = 5").groupBy("__slice").count().collect()]
    assert len(held) >= 14 and max(held) < 6_000


def _newest_slices(spark) -> str:
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    return str(max(root.glob("ordinals-*"), key=lambda p: p.stat().st_mtime_ns))


@pytest.fixture
def lookups(spark) -> Lookups:
    return build_lookups(
        spark.createDataFrame([("1", "Ann"), ("2", "Bob")], "Id string, Name string"),
        spark.createDataFrame(
            [("70", "3", "House 1"), ("71", "3", "House 2")],
            "Id string, AccountId string, Name string",
        ),
        spark.createDataFrame(
            [("12", "8", "Site 1", "w"), ("13", "8", "Site 2", "e"), ("12", "9", "Site 7", "n")],
            "Id string, SiteId string, Name string, Alias string",
        ),
    )


def telemetry(spark, rows, columns="AccountId string, SiteId string, HouseIdSet string, n int"):
    return spark.createDataFrame(rows, columns)


def test_dashboard_fans_out_and_falls_back(spark, lookups):
    raw = telemetry(
        spark,
        [("1", "3", "[13]", 1), ("1", "3", " [12] ", 2), ("2", "13", "[]", 3), (None, "3", None, 4), ("9", "x", "[12],[13]", 5)],
    )
    got = dashboard(raw, lookups).select(
        "n", "HouseIdSet", "Customer", "SiteName", "HouseName", "HouseId", "SiteAlias"
    )
    assert rows_of(got) == [
        (1, "13", "Ann", "Site 2", "House 2", "1", "e"),
        (2, "12", "Ann", "Site 1", "House 1", "1", "w"),
        (2, "12", "Ann", "Site 7", "House 1", "1", "n"),
        (3, "13", "Bob", "Site 2", None, "2", "e"),
        (4, None, None, None, None, None, None),
        (5, "12],[13", None, None, None, "9", None),
    ]


def test_absent_house_set_uses_the_site(spark, lookups):
    raw = telemetry(spark, [(1, 12)], "AccountId int, SiteId int")
    got = dashboard(raw, lookups).select("HouseIdSet", "AccountId", "SiteName")
    assert rows_of(got) == [("12", "1", "Site 1"), ("12", "1", "Site 7")]


def test_lookup_columns_win_over_telemetry_columns(spark, lookups):
    raw = telemetry(spark, [("1", "13", "x", "y")], "AccountId string, SiteId string, Customer string, SiteName string")
    got = dashboard(raw, lookups)
    assert got.select("Customer", "SiteName").first()[:] == ("Ann", "Site 2")
    assert len(got.columns) == len(set(got.columns))


def test_dashboard_needs_identifiers(spark, lookups):
    with pytest.raises(ValueError, match="SiteId"):
        dashboard(telemetry(spark, [("1",)], "AccountId string"), lookups)


def test_small_lookups_broadcast_and_large_ones_spread_null_keys(spark, lookups, conf):
    rows = [("1", "3", "[12]", 1), ("1", "3", None, 2), (None, "3", "[]", 3)] * 5
    small = dashboard(telemetry(spark, rows), lookups)
    want = rows_of(small)
    final = plan_of(small).split("== Initial Plan ==")[0]
    # Three lookups; one slice has no shift, so that join drops out.
    assert final.count("BroadcastHashJoin") == 3

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    large = dashboard(telemetry(spark, rows), lookups)
    text = plan_of(large)
    # The shifts have a row per slice at most and are broadcast at every size.
    assert text.count("SortMergeJoin") == 3
    assert text.count("__spread") >= 3
    # Both inputs of every join are plain shuffles, which skew handling needs.
    assert "Exchange hashpartitioning(AccountRowId" in text
    assert rows_of(large) == want
