"""README-question jobs (D1, D3, D4, D5, D7) on inline fixtures."""

from __future__ import annotations

import datetime as dt

from plantlens.plans import scenario, signals

D = dt.date


def test_signed_deviation_sign_and_null_spec(spark):
    rows = [(23.0, 21.5, 22.5), (21.0, 21.5, 22.5), (22.0, 21.5, 22.5), (30.0, None, None)]
    df = spark.createDataFrame(rows, "dry_solids_pct double, min_dry_matter_pct double, max_dry_matter_pct double")
    got = [round(r.d, 9) for r in df.select(signals.signed_deviation(df).alias("d")).collect()]
    assert got == [0.2, -0.2, 0.0, 0.0]      # above max+0.3, below min-0.3, inside, no spec


def test_window_costs_inclusive_days(spark):
    rows = [(D(2025, 8, 1), "NA-P1", "A", 10.0, 1.0, 2.0), (D(2025, 8, 5), "NA-P1", "A", 20.0, 0.0, 0.0),
            (D(2025, 8, 6), "NA-P1", "A", 40.0, 0.0, 0.0)]
    x = spark.createDataFrame(rows, "date date, plant_name string, product_name string, raw_potato_spend_usd double, "
                                    "over_quality_waste_usd double, downgrade_rework_exposure_usd double")
    r = signals.window_costs(x, "2025-08-01", "2025-08-05").collect()[0]
    assert (r.spend_usd, r.n_days) == (30.0, 2)


def test_code_correlation_constant_series_is_null(spark):
    hourly = spark.createDataFrame(
        [(D(2025, 8, d), "NA-P1", True, False) for d in range(1, 5)] +
        [(D(2025, 8, d), "NA-P1", False, False) for d in range(1, 5) for _ in range(d)],
        "date date, plant_name string, under_quality_flag boolean, over_quality_flag boolean")
    oee = spark.createDataFrame(
        [(D(2025, 8, d), "NA-P1", "maintenance", "cutter", float(d)) for d in range(1, 5)] +
        [(D(2025, 8, d), "NA-P1", "maintenance", "fryer", 5.0) for d in range(1, 5)],
        "date date, plant_name string, downtime_cat_1 string, downtime_cat_2 string, downtime_min double")
    got = {r.downtime_cat_2: r.corr_downtime_flagged for r in signals.code_drift_correlation(hourly, oee).collect()}
    assert got["fryer"] is None                  # constant downtime: no correlation, no ANSI error
    assert got["cutter"] < -0.9                  # more downtime on days with a lower flagged share


def test_top_actions_ties_and_limit(spark):
    rows = [("REC-b", "equipment_upgrade", "NA-P1", "L1", 500.0), ("REC-a", "load_reallocation", "NA-P1", "L2", 500.0),
            ("REC-c", "load_reallocation", "NA-P1", "L3", 100.0), ("REC-d", "load_reallocation", "NA-P1", "L4", 900.0),
            ("REC-e", "load_reallocation", "EU-P3", "L1", 1.0)]
    rec = spark.createDataFrame(rows, "recommendation_id string, type string, plant_name string, plant_line string, "
                                      "expected_savings_usd double")
    got = [(r.plant_name, r.rank, r.recommendation_id) for r in
           scenario.top_actions(rec, 3).orderBy("plant_name", "rank").collect()]
    assert got == [("EU-P3", 1, "REC-e"), ("NA-P1", 1, "REC-d"), ("NA-P1", 2, "REC-a"), ("NA-P1", 3, "REC-b")]


def test_upgrade_ranking_per_line(spark):
    rows = [("NA-P1", "L1", "EQ-1", "cutter", D(2015, 1, 1), 10.0, 9.0),
            ("NA-P1", "L1", "EQ-2", "fryer", D(2020, 1, 1), 10.0, 9.5),
            ("NA-P1", "L1", "EQ-3", "packer", D(2024, 1, 1), 10.0, 10.0),
            ("NA-P1", "L2", "EQ-4", "cutter", D(2010, 1, 1), 5.0, None)]
    eq = spark.createDataFrame(rows, "plant_name string, plant_line string, equipment_id string, equipment_type string, "
                                     "commission_date date, equipment_rated_throughput_tph double, "
                                     "effective_rated_throughput_tph double")
    got = {r.equipment_id: (r.rank, r.lost_value_usd, r.payback_years)
           for r in scenario.upgrade_ranking(eq).collect()}
    assert got["EQ-1"] == (1, 10000.0, 10.0)
    assert got["EQ-2"] == (2, 5000.0, 20.0)
    assert got["EQ-3"] == (3, 0.0, None)         # nothing lost: no payback
    assert got["EQ-4"] == (1, 0.0, None)         # missing effective value counts as no loss


def test_oee_parts_full_join_days(spark):
    hourly = spark.createDataFrame(
        [(D(2025, 8, 1), "NA-P1", "L1", True, False), (D(2025, 8, 1), "NA-P1", "L1", False, False),
         (D(2025, 8, 2), "NA-P1", "L1", False, False)],
        "date date, plant_name string, plant_line string, under_quality_flag boolean, over_quality_flag boolean")
    oee = spark.createDataFrame(
        [(D(2025, 8, 1), "NA-P1", "L1", 100.0, 25.0, 500.0), (D(2025, 8, 3), "NA-P1", "L1", 60.0, 0.0, 60.0)],
        "date date, plant_name string, plant_line string, duration_min double, downtime_min double, qty_packed double")
    got = {r.date: (r.availability, r.performance_kg_per_min, r.quality)
           for r in signals.oee_parts(hourly, oee).collect()}
    assert got[D(2025, 8, 1)] == (0.75, 5.0, 0.5)
    assert got[D(2025, 8, 2)] == (None, None, 1.0)       # readings, no OEE rows
    assert got[D(2025, 8, 3)] == (1.0, 1.0, None)        # OEE rows, no readings


def test_supplier_mix_shares_sum_to_one(spark):
    rows = [("NA-P1", "NA-P1-20250801-1-S1", D(2025, 8, 1), 10.0, 22.0),
            ("NA-P1", "NA-P1-20250801-2-S2", D(2025, 8, 1), 30.0, 23.0),
            ("NA-P1", "NA-P1-bad-3", D(2025, 8, 1), 10.0, 21.0),
            ("NA-P1", "NA-P1-20250820-1-S2", D(2025, 8, 20), 5.0, 24.0)]
    loads = spark.createDataFrame(rows, "plant_name string, load_number string, arrival_date date, tons double, "
                                        "dry_matter_pct double")
    got = {(r.period, r.id_supplier): r.tons_share for r in signals.supplier_mix(loads, "2025-08-15").collect()}
    assert got == {("before", "S1"): 0.2, ("before", "S2"): 0.6, ("before", None): 0.2, ("after", "S2"): 1.0}


def test_load_id_summary_malformed_group(spark):
    rows = [("NA-P1-20250801-1-S1",), ("NA-P1-20250803-7-S1",), ("EU-P3-bad-2",), ("NA-P1-20259999-1-S2",)]
    loads = spark.createDataFrame(rows, "load_number string")
    got = {(r.id_plant, r.id_supplier): (r.n_loads, r.first_date, r.last_date, r.max_seq)
           for r in signals.load_id_summary(loads).collect()}
    assert got[("NA-P1", "S1")] == (2, D(2025, 8, 1), D(2025, 8, 3), 7)
    assert got[(None, None)] == (1, None, None, None)
    assert got[("NA-P1", "S2")] == (1, None, None, 1)     # eight digits that are not a day
