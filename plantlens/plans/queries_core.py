"""Registered queries for the 22 silver and gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlens.oracle.layers_sql import dominant_class_sql, KPI_SQL, OPTION_SQL
from plantlens.plans import gold
from plantlens.plans.layers import from_test_tables
from plantlens.plans.registry import MONEY, RATIO, register

SHARES = {f"fry_color_{i}_share": RATIO for i in range(5)}


@register("g1_silver_specs",
          oracle="SELECT * REPLACE (array_to_string(approved_potato_varieties, ',') AS approved_potato_varieties) "
                 "FROM silver_product_specifications",
          digits={"pct_min_50mm_length": RATIO, "pct_min_75mm_length": RATIO,
                  **{f"max_usda_color_{i}_pct": RATIO for i in range(5)},
                  "min_dry_matter_pct": RATIO, "max_dry_matter_pct": RATIO})
def g1(spark, sf_dir):
    """G1: cleaned product specs (array column rendered as text for hashing)."""
    df = from_test_tables(spark, sf_dir).specs()
    return df.withColumn("approved_potato_varieties", F.array_join("approved_potato_varieties", ","))


@register("g2_silver_costs", oracle="SELECT * FROM silver_variety_costs",
          digits={"price_usd_per_ton": MONEY})
def g2(spark, sf_dir):
    """Cleaned variety price list."""
    return from_test_tables(spark, sf_dir).costs()


@register("g3_silver_revenue", oracle="SELECT * FROM silver_revenue_by_line",
          digits={"units_packed_kg": MONEY, "net_sales_usd": MONEY, "price_per_kg": RATIO})
def g3(spark, sf_dir):
    """Revenue with region and guarded price per kg."""
    return from_test_tables(spark, sf_dir).revenue()


@register("g4_silver_demand", oracle="SELECT * FROM silver_product_demand",
          digits={"orders_kg": RATIO, "forecast_kg": RATIO})
def g4(spark, sf_dir):
    """Demand signals."""
    return from_test_tables(spark, sf_dir).demand()


LOAD_DIGITS = {"tons": RATIO, **{f"usda_color_{i}_share": RATIO for i in range(5)}, "dry_matter_pct": RATIO}


@register("g5_silver_loads", oracle="SELECT * FROM silver_potato_load_quality", digits=LOAD_DIGITS)
def g5(spark, sf_dir):
    """Loads with region, variety, arrival date, tons, shares, band."""
    return from_test_tables(spark, sf_dir).loads()


@register("g6_silver_line_events", oracle="SELECT * FROM silver_line_quality_events",
          digits={"dry_solids_pct": RATIO, **SHARES})
def g6(spark, sf_dir):
    """Hourly readings with date/hour/week and colour shares."""
    return from_test_tables(spark, sf_dir).events()


OEE_DIGITS = {"duration_min": RATIO, "downtime_min": RATIO, "qty_packed": MONEY, "num_totes_on": RATIO}


@register("g7_silver_oee", oracle="SELECT * FROM silver_oee_events", digits=OEE_DIGITS)
def g7(spark, sf_dir):
    """OEE segments with minutes and parsed end time."""
    return from_test_tables(spark, sf_dir).oee()


@register("g8_silver_equipment", oracle="SELECT * FROM silver_line_equipment",
          digits={"equipment_rated_throughput_tph": RATIO, "equipment_age_years": RATIO,
                  "effective_rated_throughput_tph": RATIO})
def g8(spark, sf_dir):
    """Equipment with age and depreciated throughput (as of a fixed date)."""
    return from_test_tables(spark, sf_dir).equipment()


@register("g9_silver_downtime", oracle="SELECT * FROM silver_downtime_events",
          digits={"duration_min": RATIO, "downtime_min": RATIO})
def g9(spark, sf_dir):
    """Downtime display table with key-hash ids."""
    return from_test_tables(spark, sf_dir).downtime()


@register("g10_date_spine", oracle="SELECT * FROM gold_date_spine")
def g10(spark, sf_dir):
    """Date spine of the reference's demo range."""
    return from_test_tables(spark, sf_dir).spine()


HOURLY_DIGITS = {"dry_solids_pct": RATIO, **SHARES, "min_dry_matter_pct": RATIO, "max_dry_matter_pct": RATIO}


@register("g11_hourly_quality", oracle="SELECT * FROM gold_line_hourly_quality", digits=HOURLY_DIGITS)
def g11(spark, sf_dir):
    """Readings fanned out to lines and flagged against the spec."""
    return from_test_tables(spark, sf_dir).hourly()


@register("g12_quality_weekly", oracle="SELECT * FROM gold_quality_weekly",
          digits={"avg_dry_solids_pct": RATIO, "avg_defect_points": RATIO})
def g12(spark, sf_dir):
    """Weekly plant quality, dominant colour class, breach hours."""
    return from_test_tables(spark, sf_dir).weekly()


OEE_KPI_DIGITS = {"total_downtime_min": RATIO, "run_duration_min": RATIO, "qty_packed_kg": MONEY,
                  "num_totes_on": RATIO, "oee_performance": RATIO}


@register("g13_oee_kpis", oracle="SELECT * FROM gold_oee_kpis", digits=OEE_KPI_DIGITS)
def g13(spark, sf_dir):
    """Daily OEE aggregates per line."""
    return from_test_tables(spark, sf_dir).oee_daily()


EXPOSURE_DIGITS = {"tons_processed": RATIO, "avg_dry_matter_pct": RATIO, "raw_potato_spend_usd": MONEY,
                   "over_quality_waste_usd": MONEY, "downgrade_rework_exposure_usd": MONEY}


@register("g14_cost_exposure", oracle="SELECT * FROM gold_cost_exposure", digits=EXPOSURE_DIGITS)
def g14(spark, sf_dir):
    """Daily cost exposure per plant and product (as-of priced)."""
    return from_test_tables(spark, sf_dir).exposure()


@register("g15_cumulative_costs", oracle="SELECT * FROM gold_cumulative_costs",
          digits={"cumulative_spend_usd": MONEY, "cumulative_over_quality_waste_usd": MONEY,
                  "cumulative_gross_margin_usd": MONEY})
def g15(spark, sf_dir):
    """Running spend, waste and margin per region."""
    return from_test_tables(spark, sf_dir).cumulative()


@register("g16_line_daily_metrics", oracle="SELECT * FROM gold_line_daily_metrics",
          digits={"blend_dm_pct": RATIO, "defect_points": RATIO})
def g16(spark, sf_dir):
    """Daily line/product quality metrics."""
    return from_test_tables(spark, sf_dir).line_daily()


@register("g17_change_alignment", oracle="SELECT * FROM gold_change_alignment",
          digits={"dry_solids_pct": RATIO, "duration_min": RATIO, "downtime_min": RATIO})
def g17(spark, sf_dir):
    """Readings aligned with the day's OEE activity per code pair."""
    return from_test_tables(spark, sf_dir).alignment()


@register("g18_kpi_tons_30d", oracle=KPI_SQL["g18"], digits={"total_tons_last_30d": MONEY})
def g18(spark, sf_dir):
    """Tons over the trailing 30 days (31 inclusive)."""
    return from_test_tables(spark, sf_dir).kpi_tons()


@register("g19_kpi_spend_30d", oracle=KPI_SQL["g19"], digits={"raw_potato_spend_last_30d_usd": MONEY})
def g19(spark, sf_dir):
    """Raw spend over the trailing 30 days."""
    return from_test_tables(spark, sf_dir).kpi_spend()


@register("g20_kpi_performance_7d", oracle=KPI_SQL["g20"], digits={"oee_performance_avg_last_7d": RATIO})
def g20(spark, sf_dir):
    """Mean daily performance over the trailing 7 days."""
    return from_test_tables(spark, sf_dir).kpi_performance()


@register("g21_kpi_downgrade_30d", oracle=KPI_SQL["g21"],
          digits={"downgrade_rework_exposure_last_30d_usd": MONEY})
def g21(spark, sf_dir):
    """Downgrade exposure over the trailing 30 days."""
    return from_test_tables(spark, sf_dir).kpi_downgrade()


@register("g22_scenarios",
          oracle="SELECT * REPLACE (CAST(expected_quality_delta_pp AS DOUBLE) AS expected_quality_delta_pp, "
                 "CAST(confidence AS DOUBLE) AS confidence) FROM gold_scenario_recommendations",
          digits={"expected_savings_usd": MONEY, "expected_quality_delta_pp": RATIO, "confidence": RATIO})
def g22(spark, sf_dir):
    """Per-machine upgrade / reallocation suggestions (the two DECIMAL(2,1)
    constants shown as doubles, so pandas-based hashing sees one type)."""
    df = from_test_tables(spark, sf_dir).scenarios()
    return df.withColumns({c: F.col(c).cast("double") for c in ("expected_quality_delta_pp", "confidence")})



READING_DIGITS = {"dry_solids_pct": RATIO, **SHARES, "min_dry_matter_pct": RATIO, "max_dry_matter_pct": RATIO}


@register("g11_reading_grain", oracle=OPTION_SQL["reading_quality"], digits=READING_DIGITS)
def g11_readings(spark, sf_dir):
    """H2 option: each reading once, flagged if any line making the product would flag it."""
    return from_test_tables(spark, sf_dir).readings()


@register("g12_weekly_reading_grain",
          oracle="""SELECT week_start, plant_name, AVG(dry_solids_pct) AS avg_dry_solids_pct,
  AVG(total_defect_points) AS avg_defect_points,
  """ + dominant_class_sql([f"AVG(fry_color_{i}_share)" for i in range(5)]) + """ AS fry_color_class_mode,
  CAST(count_if(under_quality_flag) AS BIGINT) AS hours_under_quality,
  CAST(count_if(over_quality_flag) AS BIGINT) AS hours_over_quality
FROM (""" + OPTION_SQL["reading_quality"] + """) GROUP BY week_start, plant_name""",
          digits={"avg_dry_solids_pct": RATIO, "avg_defect_points": RATIO})
def g12_readings(spark, sf_dir):
    """H2 option: weekly quality with breach hours counted once per reading."""
    return gold.quality_weekly(from_test_tables(spark, sf_dir).readings())


@register("g14_exposure_shared", oracle=OPTION_SQL["exposure_shared"], digits=EXPOSURE_DIGITS)
def g14_shared(spark, sf_dir):
    """H3 option: a load's tons shared evenly over its plant's products."""
    p = from_test_tables(spark, sf_dir)
    return gold.cost_exposure(p.loads(), p.costs(), p.specs(), share_by_products=True)


@register("g15_cumulative_all_days", oracle=OPTION_SQL["cumulative_all_days"],
          digits={"cumulative_spend_usd": MONEY, "cumulative_over_quality_waste_usd": MONEY,
                  "cumulative_gross_margin_usd": MONEY})
def g15_all_days(spark, sf_dir):
    """H14 option: running costs and margin over every day with cost or revenue."""
    p = from_test_tables(spark, sf_dir)
    return gold.cumulative_costs(p.exposure(), p.revenue(), all_days=True)
