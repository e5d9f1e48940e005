"""As-of join, running sums and trailing windows on edge fixtures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from plantlens.operators.joins import asof_price_join, asof_price_join_range, stated_small
from plantlens.operators.windows import running_sums, trailing_sums, trailing_window

D = dt.date


def _costs(spark):
    rows = [
        (D(2025, 7, 10), "NA", "S2", "Russet", "<=21%", 200.0, "C1"),
        (D(2025, 7, 10), "NA", "S1", "Russet", "<=21%", 210.0, "C2"),   # tie on the first day
        (D(2025, 7, 17), "NA", "S1", "Russet", "<=21%", 220.0, "C3"),
        (D(2025, 7, 10), "EU", "S1", "Russet", "<=21%", 150.0, "C4"),
    ]
    return spark.createDataFrame(rows, "effective_date date, region string, supplier_id string, variety string, "
                                       "dm_band string, price_usd_per_ton double, contract_id string")


def _loads(spark):
    rows = [(1, D(2025, 7, 9), "NA"), (2, D(2025, 7, 10), "NA"), (3, D(2025, 7, 16), "NA"),
            (4, D(2025, 7, 17), "NA"), (5, D(2025, 12, 30), "NA"), (6, D(2025, 12, 31), "NA"),
            (7, D(2025, 7, 20), None), (8, D(2025, 7, 20), "EU")]
    return (spark.createDataFrame(rows, "id int, date date, region string")
            .withColumn("variety", F.lit("Russet")).withColumn("dm_band", F.lit("<=21%")))


def test_asof_price_edges(spark):
    got = {r["id"]: r["price_usd_per_ton"] for r in
           asof_price_join(_loads(spark), _costs(spark), "2025-12-31").collect()}
    assert got[1] is None            # day before the first price
    assert got[2] == 200.0           # tie: the last supplier in (supplier_id, contract, price) order wins
    assert got[3] == 200.0           # last day of the first interval
    assert got[4] == 220.0           # first day of the next interval
    assert got[5] == 220.0           # open interval up to the default end
    assert got[6] is None            # the default end itself is exclusive
    assert got[7] is None            # NULL region never matches
    assert got[8] == 150.0


def test_asof_day_table_equals_range_join(spark):
    a = asof_price_join(_loads(spark), _costs(spark), "2025-12-31")
    b = asof_price_join_range(_loads(spark), _costs(spark), "2025-12-31")
    assert sorted(a.select("id", "price_usd_per_ton").collect()) == sorted(b.select("id", "price_usd_per_ton").collect())
    assert a.count() == _loads(spark).count()      # at most one price per load


def test_broadcast_hint_only_where_stated(spark):
    small = spark.range(10)
    assert "broadcast" in str(stated_small(small, True)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(stated_small(small, False)._jdf.queryExecution().logical()).lower()


def _days(spark, n=40, gaps=()):
    start = D(2025, 1, 1)
    rows = [(start + dt.timedelta(days=i), 1.0) for i in range(n) if i not in gaps]
    return spark.createDataFrame(rows, "date date, v double")


def test_trailing_window_keeps_n_plus_one_days(spark):
    df = _days(spark)
    assert trailing_window(df, "date", 30).count() == 31
    assert trailing_window(df, "date", 7).count() == 8
    assert trailing_window(df, "date", 30, inclusive=False).count() == 30
    assert trailing_sums(df, "date", 30, {"s": F.col("v")}).collect()[0]["s"] == 31.0
    assert trailing_sums(df, "date", 7, {"s": F.col("v")}).collect()[0]["s"] == 8.0


def test_trailing_window_gaps_and_empty(spark):
    df = _days(spark, gaps=(39, 35))
    # anchor = day 38; window [8, 38] minus the gap at 35
    assert trailing_window(df, "date", 30).count() == 30
    empty = spark.createDataFrame([], "date date, v double")
    assert trailing_sums(empty, "date", 30, {"s": F.col("v")}).collect()[0]["s"] is None


def test_running_sums_non_decreasing(spark):
    rows = [("NA", D(2025, 1, i), float(i)) for i in range(1, 20)] + [("EU", D(2025, 1, i), 2.0) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "region string, date date, v double")
    r = running_sums(df, ["region"], ["date"], {"cum": "v"}).orderBy("region", "date").collect()
    na = [x["cum"] for x in r if x["region"] == "NA"]
    assert na == sorted(na) and na[-1] == sum(range(1, 20))
    assert [x["cum"] for x in r if x["region"] == "EU"] == [2.0, 4.0, 6.0, 8.0]


def test_asof_plans_agree(spark):
    """Stated small, left to Spark, and salted: the same rows."""
    loads, costs = _loads(spark), _costs(spark)
    want = sorted(asof_price_join_range(loads, costs, "2025-12-31").select("id", "price_usd_per_ton").collect())
    for kw in ({"small": True}, {}, {"salt_buckets": 4}):
        got = asof_price_join(loads, costs, "2025-12-31", **kw)
        assert sorted(got.select("id", "price_usd_per_ton").collect()) == want, kw


def test_cumulative_costs_missing_days(spark):
    """A cost day without revenue gives a NULL margin until revenue
    appears; a revenue day without cost is dropped (parity) or kept (all_days)."""
    from plantlens.plans.gold import cumulative_costs

    exp = spark.createDataFrame(
        [(D(2025, 7, 10), "NA-P1", 100.0, 1.0), (D(2025, 7, 11), "NA-P1", 50.0, 2.0), (D(2025, 7, 13), "NA-P1", 10.0, 0.0)],
        "date date, plant_name string, raw_potato_spend_usd double, over_quality_waste_usd double")
    rev = spark.createDataFrame([(D(2025, 7, 11), "NA", 500.0), (D(2025, 7, 12), "NA", 70.0)],
                                "date date, region string, net_sales_usd double")
    got = {r.date: (r.cumulative_spend_usd, r.cumulative_gross_margin_usd)
           for r in cumulative_costs(exp, rev).collect()}
    assert got == {D(2025, 7, 10): (100.0, None), D(2025, 7, 11): (150.0, 350.0), D(2025, 7, 13): (160.0, 340.0)}
    every = {r.date: (r.cumulative_spend_usd, r.cumulative_gross_margin_usd)
             for r in cumulative_costs(exp, rev, all_days=True).collect()}
    assert every[D(2025, 7, 12)] == (150.0, 420.0)
    assert every[D(2025, 7, 13)] == (160.0, 410.0)


def test_date_spine_week(spark):
    """one week including a Sunday: Sunday = 1, Saturday = 7, Monday week start."""
    from plantlens.plans.gold import date_spine_between

    days = spark.createDataFrame([(D(2025, 7, 16),), (D(2025, 7, 10),)], "date date")
    rows = date_spine_between(days).orderBy("date").collect()
    assert [r.dow for r in rows] == [5, 6, 7, 1, 2, 3, 4]
    assert [r.is_weekend for r in rows] == [False, False, True, True, False, False, False]
    assert rows[0].week_start == dt.datetime(2025, 7, 7) and rows[-1].week_start == dt.datetime(2025, 7, 14)


def test_salted_join_equals_plain_join_on_a_hot_key(spark):
    from plantlens.operators.joins import salted_join

    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(3000)], "id int, k string")
    small = spark.createDataFrame([("hot", 1.0), ("k1", 2.0), ("k4", 3.0)], "k string, v double")
    for how in ("left", "inner"):
        want = sorted(big.join(small, ["k"], how).collect())
        got = salted_join(big, small, ["k"], how, buckets=8)
        assert sorted(got.collect()) == want
        assert got.columns == big.join(small, ["k"], how).columns
    # the salt spreads the hot key: its rows use all 8 salts
    salts = big.filter("k = 'hot'").select(F.pmod(F.xxhash64("id", "k"), F.lit(8)).alias("s")).distinct().count()
    assert salts == 8


def test_asof_salted_tier(spark):
    loads, costs = _loads(spark), _costs(spark)
    want = sorted(asof_price_join(loads, costs, "2025-12-31").select("id", "price_usd_per_ton").collect())
    got = asof_price_join(loads, costs, "2025-12-31", salt_buckets=4)
    assert sorted(got.select("id", "price_usd_per_ton").collect()) == want


def test_change_alignment_fallbacks_agree(spark, small_dir):
    from plantlens.plans import gold
    from plantlens.plans.layers import from_test_tables

    p = from_test_tables(spark, small_dir)
    cols = ["date", "hour", "plant_name", "plant_line", "product_name", "downtime_cat_1", "downtime_cat_2",
            "oee_event_count"]
    want = sorted(gold.change_alignment(p.hourly(), p.oee()).select(*cols).collect())
    for kw in ({}, {"salt_buckets": 4}):
        got = gold.change_alignment(p.hourly(), p.oee(), **kw).select(*cols)
        assert sorted(got.collect()) == want
