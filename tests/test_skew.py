"""Hot keys: results against brute force, and plans that really split them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_sinks import content, layer
from tierflow.operators.dashboard import dashboard
from tierflow.operators.lookups import Lookups, account_lookup, house_lookup, site_lookup
from tierflow.sinks.upsert import merge_rows, upsert


@pytest.fixture
def shuffled(conf):
    """No broadcast, and partitions counted as skewed from a few kilobytes on."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "40k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")


def final_plan(frame) -> str:
    return plan_of(frame).split("== Initial Plan ==")[0]


def test_hot_account_is_split_in_the_lookup_join(spark, shuffled):
    many = spark.range(0, 400, 1, 4)
    lookups = Lookups(
        account_lookup(many.selectExpr("id as Id", "concat('c', id) as Name")),
        house_lookup(many.selectExpr("id as Id", "id % 9 as AccountId", "concat('h', id) as Name")),
        site_lookup(many.selectExpr("id as Id", "id % 9 as SiteId", "concat('s', id) as Name")),
    )
    rows = spark.range(0, 60_000, 1, 4).selectExpr(
        "id",
        "if(id % 3 = 0, 7, id % 400) as AccountId",
        "id % 9 as SiteId",
        "if(id % 3 = 1, null, concat('[', id % 400, ']')) as HouseIdSet",
        "sha2(cast(id as string), 256) as payload",
    )
    joined = dashboard(rows, lookups).select("id", "Customer", "SiteName", "payload")
    got = joined.agg(
        F.count(F.lit(1)), F.count("SiteName"), F.countDistinct("id"),
        F.count_if(F.col("Customer") == "c7"),
    ).first()
    assert got[:] == (60_000, 40_000, 60_000, sum(i % 3 == 0 or i % 400 == 7 for i in range(60_000)))
    joined.collect()
    assert "SortMergeJoin(skew=true)" in final_plan(joined)


def test_hot_target_key_is_split_in_the_upsert(spark, shuffled):
    target = spark.range(0, 60_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 7, id) as k", "sha2(cast(id as string), 256) as v",
        "'2026-05-01' as PartitionDate", "2026 as year", "5 as month",
    )
    source = target.filter("k % 2 = 1").groupBy("k", "PartitionDate", "year", "month").agg(
        F.lit("new").alias("v")
    )
    merged = merge_rows(
        target, source, ["PartitionDate", "k"], ("year", "month", "PartitionDate")
    )
    hot = merged.filter("k = 7 and v = 'new'").count()
    assert hot == sum(i % 3 == 0 or i == 7 for i in range(60_000))
    merged.collect()
    assert "SortMergeJoin(skew=true)" in final_plan(merged)


@pytest.mark.parametrize("seed", range(3))
def test_upsert_matches_brute_force(spark, path, seed):
    rng = random.Random(seed)

    def rows(count, keys, mark):
        return [
            (rng.choice([None, *keys]), f"{mark}{i}", rng.randint(1, 3))
            for i in range(count)
        ]

    target = rows(30, range(12), "t")
    # Keys 0-19 once per day at most, keys 50 and up many times but never matching.
    source = [(k, f"s{k}-{d}", d) for d in (1, 2) for k in range(0, 20, 2)]
    source += [(50 + rng.randint(0, 1), f"r{i}", 2) for i in range(15)]
    source += [(None, f"n{i}", 1) for i in range(4)]

    new = {(k, d): v for k, v, d in source if k is not None and k < 50}
    want = [(k, new.get((k, d), v), f"2026-05-0{d}") for k, v, d in target]
    old = {(k, d) for k, _, d in target}
    want += [
        (k, v, f"2026-05-0{d}") for k, v, d in source if k is None or (k, d) not in old
    ]

    upsert(layer(spark, target), path, ["k"])
    report = upsert(layer(spark, source), path, ["k"])
    assert report.rows == len(source)
    assert content(spark, path) == sorted(want, key=repr)
