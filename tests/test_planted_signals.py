"""
with one over- and one under-quality episode; flags appear there and
nowhere else, the weekly table counts them, and the QA summary sees them."""

from __future__ import annotations

import datetime as dt

from plantlens.plans import gold, silver, signals
from plantlens.sources.schemas import LINE_QUALITY_EVENTS, PRODUCT_SPECS

T0 = dt.datetime(2025, 8, 4)       # a Monday


def _specs(spark):
    rows = []
    for pid, plant, lines in [(1, "NA-X1", 2), (3, "EU-X3", 1)]:
        for line in range(1, lines + 1):
            for k, prod in enumerate(["CC-13", "SC-9"]):
                rows.append((pid, plant, f"L{line}", 100 + k, prod, 60, 70, 80, 0.7, 0.3, 4.0, 3.0, 2.0, 1.0, 0.0,
                             2500, 21.5, 22.5, ["Russet"]))
    return spark.createDataFrame(rows, PRODUCT_SPECS)


def _events(spark):
    rows = []
    for h in range(24 * 14):                       # two weeks, hourly, both plants and products
        ts = T0 + dt.timedelta(hours=h)
        for pid, plant in [(1, "NA-X1"), (3, "EU-X3")]:
            for prod in ["CC-13", "SC-9"]:
                dm = 22.0                          # inside [21.5 - 0.3, 22.5 + 0.3]
                if plant == "NA-X1" and prod == "CC-13" and 30 <= h < 42:
                    dm = 20.8                      # planted under-quality episode, 12 hours
                if plant == "EU-X3" and prod == "SC-9" and 200 <= h < 206:
                    dm = 23.6                      # planted over-quality episode, 6 hours
                rows.append((ts, pid, plant, prod, prod, "russet", 70, 1, 2, 3, 0, 0, 1500, dm))
    return spark.createDataFrame(rows, LINE_QUALITY_EVENTS)


def test_flags_only_in_planted_episodes(spark):
    ev = silver.line_quality_events(_events(spark))
    hourly = gold.line_hourly_quality(ev, silver.product_specs(_specs(spark)))
    under = hourly.filter("under_quality_flag")
    over = hourly.filter("over_quality_flag")
    # NA-X1 has 2 lines making CC-13: 12 readings fan out to 24 line-hours (H2)
    assert under.count() == 24
    assert {(r.plant_name, r.product_name) for r in under.select("plant_name", "product_name").distinct().collect()} \
        == {("NA-X1", "CC-13")}
    assert over.count() == 6
    assert {(r.plant_name, r.product_name, r.plant_line) for r in over.select(
        "plant_name", "product_name", "plant_line").distinct().collect()} == {("EU-X3", "SC-9", "L1")}
    # weekly table: the under episode is in week 1, the over episode in week 2
    weekly = {(r.week_start, r.plant_name): (r.hours_under_quality, r.hours_over_quality)
              for r in gold.quality_weekly(hourly).collect()}
    assert weekly[(T0, "NA-X1")] == (24, 0)
    assert weekly[(T0 + dt.timedelta(days=7), "EU-X3")] == (0, 6)
    assert sum(u + o for u, o in weekly.values()) == 30
    # breach episodes: exactly one per planted signal, with its length
    eps = {(r.plant_name, r.plant_line, r.kind): r.n_readings for r in signals.breach_episodes(hourly).collect()}
    assert eps == {("NA-X1", "L1", "under"): 12, ("NA-X1", "L2", "under"): 12, ("EU-X3", "L1", "over"): 6}


def test_story_signals_see_the_planted_means(spark):
    ev = silver.line_quality_events(_events(spark))
    w = signals.EventWindow(start="2025-08-05", end="2025-08-05", over_plant="EU-X3", over_product="SC-9",
                            under_plant="NA-X1", under_product="CC-13")
    empty_loads = spark.createDataFrame([], "plant_name string, load_number string, dry_matter_pct double")
    empty_oee = spark.createDataFrame([], "datetime timestamp, plant_name string, plant_line string, "
                                          "downtime_cat_1 string")
    got = {r.signal: (r.mean_a, r.n) for r in signals.story_signals(ev, empty_loads, empty_oee, w).collect()}
    # 2025-08-05 holds hours 24..47: the under episode covers 12 of its 24 readings
    mean_a, n = got["under_quality_dm_defects"]
    assert n == 24 and abs(mean_a - (12 * 20.8 + 12 * 22.0) / 24) < 1e-9
    assert got["over_quality_dm"] == (22.0, 24)
    assert got["supplier_dm_after_tranche"][1] == 0
