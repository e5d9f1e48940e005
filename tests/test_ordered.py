"""Ordered scans over range blocks against the plain window and join forms."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plantlens.operators.joins import asof_price_join_range
from plantlens.operators.ordered import BLOCK, asof_price_carry, ranged, running_sums_by_blocks
from plantlens.operators.windows import running_sums

DAY = dt.date(2025, 1, 1)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_row_blocks(spark):
    """Blocks of a few rows: no merging of small shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")


@pytest.fixture
def many_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    one_row_blocks(spark)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def made(spark, n=400, hot=0.4, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", None, "z"])
        rows.append((key, rng.choice([None, *range(50)]), i, rng.choice([None, rng.randint(-5, 9)])))
    return spark.createDataFrame(rows, "k string, t int, id int, v long").repartition(4)


@pytest.mark.parametrize("partition", [["k"], []])
def test_running_sums_equal_the_window(spark, many_blocks, partition):
    df = made(spark)
    cols = {"total": "v", "ids": "id"}
    want = plain(running_sums(df, partition, ["k", "t", "id"], cols)) if not partition else plain(
        running_sums(df, partition, ["t", "id"], cols))
    order = ["t", "id"] if partition else ["k", "t", "id"]
    assert plain(running_sums_by_blocks(df, partition, order, cols)) == want


def test_one_key_spreads_over_many_tasks(spark, many_blocks):
    df = spark.range(1000).select(F.lit("only").alias("k"), "id", F.lit(1).cast("long").alias("v"))
    blocks = ranged(df, ["k"], ["id"]).groupBy(BLOCK).count().collect()
    assert len(blocks) >= 12 and max(r["count"] for r in blocks) < 200
    got = running_sums_by_blocks(df, ["k"], ["id"], {"n": "v"})
    assert got.filter(F.col("n") != F.col("id") + 1).count() == 0 and got.count() == 1000


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k string, t int, v long")
    assert running_sums_by_blocks(df, ["k"], ["t"], {"s": "v"}).count() == 0


def price_list(spark, seed=2):
    rng = random.Random(seed)
    rows = [(DAY + dt.timedelta(rng.randint(0, 60)), rng.choice(["NA", "EU", None]), f"S{rng.randint(1, 3)}", rng.choice(["v1", "v2"]), "b",
             float(i), f"C{i}") for i in range(60)]
    rows += [(DAY + dt.timedelta(3 * d), "NA", "S1", "hot", "b", float(d), "C") for d in range(20)]
    return spark.createDataFrame(rows, "effective_date date, region string, supplier_id string, variety string, dm_band string, "
                                       "price_usd_per_ton double, contract_id string")


def load_rows(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = [(i, None if i % 50 == 0 else DAY + dt.timedelta(rng.randint(-5, 400)), rng.choice(["NA", "EU", None, "XX"]),
             "hot" if i % 3 == 0 else rng.choice(["v1", "v2", None]), "b") for i in range(n)]
    return spark.createDataFrame(rows, "id int, date date, region string, variety string, dm_band string").repartition(5)


def test_carried_prices_equal_the_range_join(spark, many_blocks):
    loads, costs = load_rows(spark), price_list(spark)
    want = plain(asof_price_join_range(loads, costs, "2025-12-31"))
    got = asof_price_carry(loads, costs, "2025-12-31")
    assert got.columns == [*loads.columns, "price_usd_per_ton"] and plain(got) == want
    assert sum(r[-1] is not None for r in want) > 100


def test_carried_prices_of_repeated_loads_and_one_block(spark):
    loads = load_rows(spark, 50)
    loads = loads.union(loads).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    costs = price_list(spark)
    want = sorted(tuple(r) for r in asof_price_join_range(loads.drop("m"), costs, "2025-12-31").select("id", "price_usd_per_ton").fillna(-1).collect())
    got = sorted(tuple(r) for r in asof_price_carry(loads, costs, "2025-12-31").select("id", "price_usd_per_ton").fillna(-1).collect())
    assert got == want


def test_without_prices_or_loads(spark):
    loads, costs = load_rows(spark, 20), price_list(spark)
    assert asof_price_carry(loads, costs.limit(0), "2025-12-31").filter("price_usd_per_ton is not null").count() == 0
    assert asof_price_carry(loads.limit(0), costs, "2025-12-31").count() == 0


def test_a_broadcast_has_a_row_a_block(spark, many_blocks):
    """No join of the big side by key: the only join meets the carried rows."""
    plan = asof_price_carry(load_rows(spark), price_list(spark), "2025-12-31")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
