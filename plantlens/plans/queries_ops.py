"""Registered queries for single operators (S, P, J, A, W, Q, F ids).

Each one exercises one operator over the whole stand-in tables and reduces
the result to a small, checkable table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plantlens.functions import columns as C
from plantlens.functions.timestamps import iso_utc_ms, native_ms, parse_iso_timestamp, try_timestamp
from plantlens.operators.joins import price_intervals, stated_small
from plantlens.operators.ordered import asof_price_carry, running_sums_by_blocks
from plantlens.operators.windows import running_sums, trailing_window
from plantlens.oracle.layers_sql import dominant_class_sql
from plantlens.plans import gold
from plantlens.plans.layers import from_test_tables
from plantlens.plans.queries_core import LOAD_DIGITS
from plantlens.plans.registry import MONEY, RATIO, register
from plantlens.session import checkpoint_dir
from plantlens.sources import sinks
from plantlens.sources.readers import read_mixed_dir, read_parquet_dir
from plantlens.sources.schemas import OEE_EVENTS


def _P(spark, sf_dir):
    return from_test_tables(spark, sf_dir)


REGION_SQL = "CASE WHEN plant_name LIKE 'NA-%' THEN 'NA' WHEN plant_name LIKE 'EU-%' THEN 'EU' END"

# ---- sources and sinks --------------------------------------------------------


@register("s1_scan_glob", oracle="SELECT event_type, COUNT(*) AS n, SUM(value) AS total_value FROM events GROUP BY 1",
          digits={"total_value": MONEY})
def s1(spark, sf_dir):
    """Parquet folder scan with a file-name glob (only two columns read)."""
    df = read_parquet_dir(spark, f"{sf_dir}/events.parquet")
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"))


@register("s2_part_files", oracle="SELECT * FROM silver_potato_load_quality", digits=LOAD_DIGITS)
def s2(spark, sf_dir):
    """Loads written as part files of a bounded row count and read back."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/plantlens-sinks/s2-{uuid.uuid4().hex}"
    sinks.write_parts(_P(spark, sf_dir).loads(), out, rows_per_file=1_000_000)
    return spark.read.parquet(out)


@register("s1_mixed_parts", oracle="""
SELECT plant_name, COUNT(*) AS n, SUM(duration) AS duration, COUNT(start_time) AS n_started,
  date_trunc('millisecond', MIN(datetime)) AS first_ms, date_trunc('millisecond', MAX(datetime)) AS last_ms
FROM raw_oee_events GROUP BY plant_name""", digits={"duration": MONEY})
def s1_mixed(spark, sf_dir):
    """One raw folder whose part files have ISO text or native
    timestamps and int or bigint numbers, read under the declared schema."""
    raw = _P(spark, sf_dir).raw["raw_oee_events"]
    base = f"{checkpoint_dir(spark).rstrip('/')}/plantlens-sinks/mixed-{uuid.uuid4().hex}"
    old, new = F.col("duration") % 2 == 0, F.col("duration") % 2 == 1
    sinks.save_raw(raw.filter(old), "oee_events", f"{base}/raw_both")
    sinks.save_raw(raw.filter(new).withColumn("duration", F.col("duration").cast("int")), "raw_oee_events_new",
                   f"{base}/raw_both", timestamps="native")
    both = read_mixed_dir(spark, f"{base}/raw_both", OEE_EVENTS)
    return both.groupBy("plant_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").cast("double").alias("duration"), F.count("start_time").alias("n_started"),
        F.min("datetime").alias("first_ms"), F.max("datetime").alias("last_ms"))


ISO_SQL = ("COALESCE(strftime(date_trunc('millisecond', {c}), '%Y-%m-%dT%H:%M:%S.%g') || 'Z', 'NaT')")


@register("s3_iso_encode", oracle=f"""
SELECT plant_name, plant_line, {ISO_SQL.format(c='datetime')} AS datetime_iso,
  {ISO_SQL.format(c='end_time_ts')} AS end_time_iso,
  COALESCE(CAST(nullif({ISO_SQL.format(c='datetime')}, 'NaT') AS TIMESTAMP) = date_trunc('millisecond', datetime), FALSE)
    AS round_trip_ok
FROM silver_oee_events""")
def s3(spark, sf_dir):
    """S3: timestamps as ISO-8601 UTC text with milliseconds, 'NaT' for missing,
    and the parse back (H8)."""
    o = _P(spark, sf_dir).oee()
    iso = iso_utc_ms(F.col("datetime"))
    return o.select("plant_name", "plant_line", iso.alias("datetime_iso"),
                    iso_utc_ms(F.col("end_time_ts")).alias("end_time_iso"),
                    F.coalesce(parse_iso_timestamp(iso) == native_ms(F.col("datetime")), F.lit(False))
                    .alias("round_trip_ok"))


@register("s4_native_ts", oracle="""
SELECT plant_name, date_trunc('millisecond', datetime) AS datetime_ms, date_trunc('millisecond', end_time_ts) AS end_ms
FROM silver_oee_events""")
def s4(spark, sf_dir):
    """Timestamps kept native, floored to milliseconds."""
    o = _P(spark, sf_dir).oee()
    return o.select("plant_name", native_ms(F.col("datetime")).alias("datetime_ms"),
                    native_ms(F.col("end_time_ts")).alias("end_ms"))


@register("s8_save_table", oracle="SELECT * FROM gold_oee_kpis", digits={
    "total_downtime_min": RATIO, "run_duration_min": RATIO, "qty_packed_kg": MONEY, "num_totes_on": RATIO,
    "oee_performance": RATIO})
def s8(spark, sf_dir):
    """Daily line totals saved as a commented, date-partitioned table at a
    path and read back."""
    tag = uuid.uuid4().hex[:12]
    path = f"{checkpoint_dir(spark).rstrip('/')}/plantlens-tables/oee_kpis_{tag}"
    name = sinks.save_table(spark, _P(spark, sf_dir).oee_daily(), f"gold_oee_kpis_{tag}", "plantlens_check",
                            path, "Daily line totals.", partition_by="date")
    return spark.table(name)


@register("s11_params", oracle=f"""
SELECT l.region, COUNT(*) AS n_loads, p.k_region, p.downgrade_loss_per_ton
FROM silver_potato_load_quality l
LEFT JOIN (SELECT 'NA' AS region, CAST(25.0 AS DOUBLE) AS k_region, CAST(180.0 AS DOUBLE) AS downgrade_loss_per_ton
           UNION ALL SELECT 'EU', CAST(28.0 AS DOUBLE), CAST(170.0 AS DOUBLE)) p ON l.region = p.region
GROUP BY l.region, p.k_region, p.downgrade_loss_per_ton""",
          digits={"k_region": RATIO, "downgrade_loss_per_ton": RATIO})
def s11(spark, sf_dir):
    """Regional parameters attached to loads (as a CASE, no join)."""
    l = _P(spark, sf_dir).loads()
    r = F.col("region")
    return l.groupBy("region").agg(F.count(F.lit(1)).alias("n_loads")).select(
        "region", "n_loads", gold.regional_param(r, 1).alias("k_region"),
        gold.regional_param(r, 2).alias("downgrade_loss_per_ton"))


@register("s12_date_spine", oracle="""
SELECT CAST(d AS DATE) AS date, CAST(dayofweek(d) + 1 AS INTEGER) AS dow,
  dayofweek(d) + 1 IN (1, 7) AS is_weekend, CAST(date_trunc('week', CAST(d AS DATE)) AS TIMESTAMP) AS week_start
FROM (SELECT MIN(arrival_date) AS lo, MAX(arrival_date) AS hi FROM silver_potato_load_quality) b,
     LATERAL (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d)""")
def s12(spark, sf_dir):
    """A date spine spanning the loads' arrival days."""
    return gold.date_spine_between(_P(spark, sf_dir).loads(), "arrival_date")


# ---- predicates and projections ------------------------------------------------


@register("p7_region_prefix", oracle="""
SELECT region, COUNT(*) AS n_loads, SUM(tons) AS tons FROM silver_potato_load_quality GROUP BY region""",
          digits={"tons": MONEY})
def p7(spark, sf_dir):
    """Region from the plant-name prefix ('NA-'/'EU-', else NULL)."""
    return _P(spark, sf_dir).loads().groupBy("region").agg(F.count(F.lit(1)).alias("n_loads"),
                                                           F.sum("tons").alias("tons"))


@register("p9_bands", oracle="SELECT dm_band, COUNT(*) AS n_loads FROM silver_potato_load_quality GROUP BY dm_band")
def p9(spark, sf_dir):
    """Loads per dry-matter band (half-open bands, asymmetric top edge)."""
    return _P(spark, sf_dir).loads().groupBy("dm_band").agg(F.count(F.lit(1)).alias("n_loads"))


@register("p10_ratio_guard", oracle="""
SELECT channel, COUNT(*) AS n, CAST(count_if(price_per_kg IS NULL) AS BIGINT) AS n_unpriced,
       AVG(price_per_kg) AS avg_price_per_kg
FROM silver_revenue_by_line GROUP BY channel""", digits={"avg_price_per_kg": RATIO})
def p10(spark, sf_dir):
    """P10: guarded price per kg (zero kilograms -> NULL, never a divide error)."""
    r = _P(spark, sf_dir).revenue()
    return r.groupBy("channel").agg(F.count(F.lit(1)).alias("n"),
                                    F.count_if(F.col("price_per_kg").isNull()).alias("n_unpriced"),
                                    F.avg("price_per_kg").alias("avg_price_per_kg"))


@register("p11_tolerance_flags", oracle="""
SELECT plant_name, product_name, COUNT(*) AS n, CAST(count_if(under_quality_flag) AS BIGINT) AS n_under,
       CAST(count_if(over_quality_flag) AS BIGINT) AS n_over
FROM gold_line_hourly_quality GROUP BY plant_name, product_name""")
def p11(spark, sf_dir):
    """under/over flags with the 0.3-point tolerance."""
    h = _P(spark, sf_dir).hourly()
    return h.groupBy("plant_name", "product_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("under_quality_flag").alias("n_under"),
        F.count_if("over_quality_flag").alias("n_over"))


# ---- joins ---------------------------------------------------------------------------


@register("j1_spec_join", oracle="""
SELECT plant_name, plant_line, COUNT(*) AS n_rows, COUNT(min_dry_matter_pct) AS n_matched
FROM gold_line_hourly_quality GROUP BY plant_name, plant_line""")
def j1(spark, sf_dir):
    """Readings fanned out to every line making the product."""
    h = _P(spark, sf_dir).hourly()
    return h.groupBy("plant_name", "plant_line").agg(F.count(F.lit(1)).alias("n_rows"),
                                                     F.count("min_dry_matter_pct").alias("n_matched"))


@register("j2_day_alignment", oracle="""
SELECT plant_name, plant_line, COUNT(*) AS n_rows, CAST(SUM(oee_event_count) AS BIGINT) AS oee_events,
       SUM(downtime_min) AS downtime_min
FROM gold_change_alignment GROUP BY plant_name, plant_line""", digits={"downtime_min": MONEY})
def j2(spark, sf_dir):
    """Readings joined to the day's OEE activity of their line."""
    a = _P(spark, sf_dir).alignment()
    return a.groupBy("plant_name", "plant_line").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("oee_event_count").alias("oee_events"),
        F.sum("downtime_min").alias("downtime_min"))


@register("j3_asof_price", oracle="""
SELECT region, variety, dm_band, COUNT(*) AS n_loads, COUNT(price_usd_per_ton) AS n_priced,
       SUM(price_usd_per_ton * tons) AS priced_spend_usd
FROM loads_priced GROUP BY region, variety, dm_band""", digits={"priced_spend_usd": MONEY})
def j3(spark, sf_dir):
    """As-of price join (price in force on the arrival day)."""
    p = _P(spark, sf_dir)
    lp = gold.loads_priced(p.loads(), p.costs())
    return lp.groupBy("region", "variety", "dm_band").agg(
        F.count(F.lit(1)).alias("n_loads"), F.count("price_usd_per_ton").alias("n_priced"),
        F.sum(F.col("price_usd_per_ton") * F.col("tons")).alias("priced_spend_usd"))


@register("g17_event_alignment", oracle="""
SELECT q.plant_name, q.plant_line, downtime_cat_1, COUNT(*) AS n_rows, SUM(duration_min) AS duration_min,
  SUM(downtime_min) AS downtime_min, COUNT(DISTINCT duration_min) AS n_durations
FROM gold_line_hourly_quality q LEFT JOIN silver_oee_events o
  ON q.date = o.date AND q.plant_name = o.plant_name AND q.plant_line = o.plant_line
GROUP BY ALL""", digits={"duration_min": MONEY, "downtime_min": MONEY})
def g17_events(spark, sf_dir):
    """G17/J2 at event grain: the expansion of the factorised alignment, as many
    rows as the literal join, with each event's own durations.  Equal rows of the
    columns read here are counted, not repeated."""
    p = _P(spark, sf_dir)
    a = gold.expand_alignment(gold.alignment_factors(p.hourly(), p.oee()),
                              counted=["downtime_cat_1", "duration_min", "downtime_min"])
    return a.groupBy("plant_name", "plant_line", "downtime_cat_1").agg(
        F.sum("copies").alias("n_rows"), F.sum(F.col("duration_min") * F.col("copies")).alias("duration_min"),
        F.sum(F.col("downtime_min") * F.col("copies")).alias("downtime_min"),
        F.count_distinct("duration_min").alias("n_durations"))


J3_SQL = """
SELECT region, variety, dm_band, COUNT(*) AS n_loads, COUNT(price_usd_per_ton) AS n_priced,
       SUM(price_usd_per_ton * tons) AS priced_spend_usd
FROM loads_priced GROUP BY region, variety, dm_band"""


@register("j3_asof_carry", oracle=J3_SQL, digits={"priced_spend_usd": MONEY})
def j3_carry(spark, sf_dir):
    """The same prices from one ordered scan of loads and prices, carried
    across range blocks."""
    p = _P(spark, sf_dir)
    loads = p.loads().select(F.col("arrival_date").alias("date"), "region", "variety", "dm_band", "tons")
    lp = asof_price_carry(loads, p.costs(), gold.PRICE_OPEN_END)
    return lp.groupBy("region", "variety", "dm_band").agg(
        F.count(F.lit(1)).alias("n_loads"), F.count("price_usd_per_ton").alias("n_priced"),
        F.sum(F.col("price_usd_per_ton") * F.col("tons")).alias("priced_spend_usd"))


@register("j4_threshold_fanout", oracle="""
SELECT l.plant_name, t.product_name, COUNT(*) AS n_rows, SUM(l.tons) AS tons
FROM silver_potato_load_quality l
LEFT JOIN (SELECT DISTINCT plant_name, product_name, min_dry_matter_pct, max_dry_matter_pct
           FROM silver_product_specifications) t ON l.plant_name = t.plant_name
GROUP BY l.plant_name, t.product_name""", digits={"tons": MONEY})
def j4(spark, sf_dir):
    """Loads fanned out to the distinct thresholds of their plant."""
    p = _P(spark, sf_dir)
    t = gold.spec_thresholds(p.specs())
    j = p.loads().select("plant_name", "tons").join(stated_small(t, True), "plant_name", "left")
    return j.groupBy("plant_name", "product_name").agg(F.count(F.lit(1)).alias("n_rows"),
                                                       F.sum("tons").alias("tons"))


J6_SQL = f"""
SELECT date, region, sum(spend) AS spend_usd, sum(waste) AS over_quality_waste_usd, sum(sales) AS revenue_usd
FROM (SELECT date, {REGION_SQL} AS region, raw_potato_spend_usd AS spend, over_quality_waste_usd AS waste, NULL AS sales, TRUE AS cost
      FROM gold_cost_exposure
      UNION ALL
      SELECT date, region, NULL, NULL, net_sales_usd, FALSE FROM silver_revenue_by_line WHERE region IS NOT NULL)
GROUP BY date, region HAVING bool_or(cost)"""


@register("j6_cost_revenue", oracle=J6_SQL,
          digits={"spend_usd": MONEY, "over_quality_waste_usd": MONEY, "revenue_usd": MONEY})
def j6(spark, sf_dir):
    """Daily cost LEFT JOIN daily revenue, both pre-aggregated."""
    p = _P(spark, sf_dir)
    cost = (p.exposure().withColumn("region", C.region_of("plant_name")).groupBy("date", "region")
            .agg(F.sum("raw_potato_spend_usd").alias("spend_usd"),
                 F.sum("over_quality_waste_usd").alias("over_quality_waste_usd")))
    rev = p.revenue().groupBy("date", "region").agg(F.sum("net_sales_usd").alias("revenue_usd"))
    return cost.join(rev, ["date", "region"], "left")


# ---- aggregates -------------------------------------------------------------------------


@register("a2_count_if", oracle="""
SELECT week_start, plant_name, CAST(count_if(under_quality_flag) AS BIGINT) AS n_count_if,
       CAST(SUM(CASE WHEN under_quality_flag THEN 1 ELSE 0 END) AS DOUBLE) AS n_sum_case
FROM gold_line_hourly_quality GROUP BY week_start, plant_name
UNION ALL
SELECT NULL, NULL, CAST(COUNT(CASE WHEN under_quality_flag THEN 1 END) AS BIGINT),
       CAST(SUM(CASE WHEN under_quality_flag THEN 1 ELSE 0 END) AS DOUBLE)
FROM gold_line_hourly_quality WHERE plant_name = 'no such plant'""", digits={"n_sum_case": RATIO})
def a2(spark, sf_dir):
    """COUNT_IF vs SUM(CASE): equal on groups, 0 vs NULL on empty input.
    (The nullable sum is shown as a double so every client reads NULL alike.)"""
    h = _P(spark, sf_dir).hourly()
    cnt = F.count_if("under_quality_flag").alias("n_count_if")
    sc = F.sum(F.when(F.col("under_quality_flag"), 1).otherwise(0)).cast("double").alias("n_sum_case")
    grouped = h.groupBy("week_start", "plant_name").agg(cnt, sc)
    empty = h.filter(F.col("plant_name") == "no such plant").agg(cnt, sc).select(
        F.lit(None).cast("timestamp").alias("week_start"), F.lit(None).cast("string").alias("plant_name"),
        "n_count_if", "n_sum_case")
    return grouped.unionByName(empty)


@register("a3_dominant_class", oracle="""
SELECT date, plant_name,
  """ + dominant_class_sql([f"AVG(fry_color_{i}_share)" for i in range(5)]) + """ AS dominant_class
FROM silver_line_quality_events GROUP BY date, plant_name""")
def a3(spark, sf_dir):
    """A3: arg-max over five averaged colour shares (ties -> lowest class)."""
    e = _P(spark, sf_dir).events()
    return e.groupBy("date", "plant_name").agg(
        C.dominant_class([F.avg(f"fry_color_{i}_share") for i in range(5)]).alias("dominant_class"))


@register("a5_exposure", oracle="""
SELECT plant_name, SUM(tons_processed) AS tons, SUM(raw_potato_spend_usd) AS spend_usd,
       SUM(over_quality_waste_usd) AS waste_usd, SUM(downgrade_rework_exposure_usd) AS downgrade_usd
FROM gold_cost_exposure GROUP BY plant_name""",
          digits={"tons": MONEY, "spend_usd": MONEY, "waste_usd": MONEY, "downgrade_usd": MONEY})
def a5(spark, sf_dir):
    """Exposure sums (price or slope fallback, waste, downgrade) per plant."""
    x = _P(spark, sf_dir).exposure()
    return x.groupBy("plant_name").agg(
        F.sum("tons_processed").alias("tons"), F.sum("raw_potato_spend_usd").alias("spend_usd"),
        F.sum("over_quality_waste_usd").alias("waste_usd"),
        F.sum("downgrade_rework_exposure_usd").alias("downgrade_usd"))


@register("a7_group_by_expr", oracle=f"""
SELECT {REGION_SQL} AS region, SUM(raw_potato_spend_usd) AS spend_usd FROM gold_cost_exposure GROUP BY 1""",
          digits={"spend_usd": MONEY})
def a7(spark, sf_dir):
    """Grouping by a CASE expression rather than a column."""
    x = _P(spark, sf_dir).exposure()
    return x.groupBy(C.region_of("plant_name").alias("region")).agg(F.sum("raw_potato_spend_usd").alias("spend_usd"))


@register("a12_distinct", oracle="""
SELECT DISTINCT plant_name, product_name, min_dry_matter_pct, max_dry_matter_pct FROM silver_product_specifications""",
          digits={"min_dry_matter_pct": RATIO, "max_dry_matter_pct": RATIO})
def a12(spark, sf_dir):
    """DISTINCT thresholds per plant and product."""
    return gold.spec_thresholds(_P(spark, sf_dir).specs())


@register("a13_mean_ratio", oracle="""
SELECT plant_name, plant_line, AVG(oee_performance) AS mean_of_daily_ratio,
       SUM(qty_packed_kg) / SUM(run_duration_min) AS ratio_of_sums
FROM gold_oee_kpis GROUP BY plant_name, plant_line""",
          digits={"mean_of_daily_ratio": RATIO, "ratio_of_sums": RATIO})
def a13(spark, sf_dir):
    """Mean of daily ratios next to the ratio of sums, per line."""
    k = _P(spark, sf_dir).oee_daily()
    return k.groupBy("plant_name", "plant_line").agg(
        F.avg("oee_performance").alias("mean_of_daily_ratio"),
        (F.sum("qty_packed_kg") / F.sum("run_duration_min")).alias("ratio_of_sums"))


# ---- windows, set operations, subqueries ------------------------------------------


@register("w1_lead_default", oracle="""
SELECT price.*, ifnull(min(later.effective_date), DATE '2025-12-31') AS next_effective_date
FROM (SELECT region, variety, dm_band, effective_date, supplier_id, contract_id, price_usd_per_ton FROM silver_variety_costs) price
LEFT JOIN silver_variety_costs later
  ON (price.region, price.variety, price.dm_band) = (later.region, later.variety, later.dm_band)
 AND (later.effective_date, later.supplier_id, later.contract_id, later.price_usd_per_ton)
   > (price.effective_date, price.supplier_id, price.contract_id, price.price_usd_per_ton)
GROUP BY ALL""", digits={"price_usd_per_ton": MONEY})
def w1(spark, sf_dir):
    """LEAD with a default date and a total-order tie-break (H1)."""
    return price_intervals(_P(spark, sf_dir).costs(), gold.PRICE_OPEN_END)


W2_SQL = """
SELECT here.plant_name, here.date, SUM(up_to.tons) AS cumulative_tons
FROM (SELECT DISTINCT plant_name, arrival_date AS date FROM silver_potato_load_quality) here
JOIN (SELECT plant_name, arrival_date AS date, SUM(tons) AS tons FROM silver_potato_load_quality GROUP BY ALL) up_to
  ON up_to.plant_name = here.plant_name AND up_to.date <= here.date
GROUP BY here.plant_name, here.date"""


@register("w2_running_sum_rows", oracle=W2_SQL, digits={"cumulative_tons": MONEY})
def w2_rows(spark, sf_dir):
    """W2-W4 over raw loads: a running sum a row, each plant spread over range
    blocks; shown at the end of each day."""
    loads = _P(spark, sf_dir).loads().select("plant_name", F.col("arrival_date").alias("date"), "load_number", "tons")
    r = running_sums_by_blocks(loads, ["plant_name"], ["date", "load_number", "tons"], {"cumulative_tons": "tons"})
    return r.groupBy("plant_name", "date").agg(F.max("cumulative_tons").alias("cumulative_tons"))


@register("w2_running_sum", oracle="""
SELECT plant_name, date, tons, SUM(tons) OVER (PARTITION BY plant_name ORDER BY date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_tons
FROM (SELECT plant_name, arrival_date AS date, SUM(tons) AS tons FROM silver_potato_load_quality GROUP BY 1, 2)""",
          digits={"tons": RATIO, "cumulative_tons": MONEY})
def w2(spark, sf_dir):
    """Running sum of daily tons per plant (aggregate first, then window)."""
    d = (_P(spark, sf_dir).loads().groupBy("plant_name", F.col("arrival_date").alias("date"))
         .agg(F.sum("tons").alias("tons")))
    return running_sums(d, ["plant_name"], ["date"], {"cumulative_tons": "tons"})


@register("w4_running_margin", oracle=f"""
SELECT here.date, here.region, sum(up_to.revenue_usd) AS cumulative_revenue_usd,
  sum(up_to.revenue_usd) - sum(up_to.spend_usd) AS cumulative_gross_margin_usd
FROM ({J6_SQL}) here JOIN ({J6_SQL}) up_to ON up_to.region IS NOT DISTINCT FROM here.region AND up_to.date <= here.date
GROUP BY here.date, here.region""", digits={"cumulative_revenue_usd": MONEY, "cumulative_gross_margin_usd": MONEY})
def w4(spark, sf_dir):
    """Running revenue minus running spend (NULL until the first revenue day)."""
    j = j6(spark, sf_dir)
    r = running_sums(j, ["region"], ["date"], {"cumulative_revenue_usd": "revenue_usd", "cum_spend": "spend_usd"})
    return r.select("date", "region", "cumulative_revenue_usd",
                    (F.col("cumulative_revenue_usd") - F.col("cum_spend")).alias("cumulative_gross_margin_usd"))


@register("q1_union_all", oracle="""
SELECT 'loads' AS source, region, SUM(tons) AS total FROM silver_potato_load_quality GROUP BY region
UNION ALL
SELECT 'revenue', region, SUM(net_sales_usd) FROM silver_revenue_by_line GROUP BY region""",
          digits={"total": MONEY})
def q1(spark, sf_dir):
    """Q1: UNION ALL of two per-region summaries (duplicates kept)."""
    p = _P(spark, sf_dir)
    a = p.loads().groupBy("region").agg(F.sum("tons").alias("total")).select(
        F.lit("loads").alias("source"), "region", "total")
    b = p.revenue().groupBy("region").agg(F.sum("net_sales_usd").alias("total")).select(
        F.lit("revenue").alias("source"), "region", "total")
    return a.unionByName(b)


@register("q2_trailing_kpi", oracle="""
SELECT plant_name, COUNT(DISTINCT date) AS n_days, SUM(qty_packed_kg) AS qty_packed_kg
FROM gold_oee_kpis WHERE date BETWEEN (SELECT MAX(date) FROM gold_oee_kpis) - 30 AND (SELECT MAX(date) FROM gold_oee_kpis)
GROUP BY plant_name""", digits={"qty_packed_kg": MONEY})
def q2(spark, sf_dir):
    """Q2: trailing 30 days (31 inclusive) anchored on the latest day, per plant."""
    w = trailing_window(_P(spark, sf_dir).oee_daily(), "date", 30)
    return w.groupBy("plant_name").agg(F.count_distinct("date").alias("n_days"),
                                       F.sum("qty_packed_kg").alias("qty_packed_kg"))


# ---- scalar functions ------------------------------------------------------------------


@register("f2_try_timestamp", oracle="""
SELECT plant_name, COUNT(*) AS n, COUNT(TRY_CAST(end_time AS TIMESTAMP)) AS n_parsed,
  COUNT(COALESCE(TRY_CAST(end_time AS TIMESTAMP), try_strptime(end_time, '%m/%d/%Y %H:%M:%S'))) AS n_parsed_with_us
FROM raw_oee_events GROUP BY plant_name""")
def f2(spark, sf_dir):
    """TRY_CAST of end-time text (US dates -> NULL) and the optional extra format (H9)."""
    raw = _P(spark, sf_dir).raw["raw_oee_events"]
    return raw.groupBy("plant_name").agg(
        F.count(F.lit(1)).alias("n"), F.count(try_timestamp(F.col("end_time"))).alias("n_parsed"),
        F.count(try_timestamp(F.col("end_time"), ["MM/dd/yyyy HH:mm:ss"])).alias("n_parsed_with_us"))


@register("f4_initcap", oracle="SELECT channel, tier, COUNT(*) AS n FROM silver_revenue_by_line GROUP BY ALL")
def f4(spark, sf_dir):
    """INITCAP(TRIM(x)) on channel and tier ('PrivateLabel' -> 'Privatelabel')."""
    return _P(spark, sf_dir).revenue().groupBy("channel", "tier").agg(F.count(F.lit(1)).alias("n"))


@register("f6_regex_date", oracle="""
SELECT arrival_date, COUNT(*) AS n_loads FROM silver_potato_load_quality
WHERE regexp_matches(load_number, '^.*-[0-9]{8}-.*$') GROUP BY arrival_date
UNION ALL
SELECT NULL, COUNT(*) FROM silver_potato_load_quality WHERE NOT regexp_matches(load_number, '^.*-[0-9]{8}-.*$')""")
def f6(spark, sf_dir):
    """arrival day parsed from the id; ids without a date counted apart."""
    l = _P(spark, sf_dir).loads()
    ok = F.col("load_number").rlike(C.LOAD_DATE_TEST)
    parsed = l.filter(ok).groupBy("arrival_date").agg(F.count(F.lit(1)).alias("n_loads"))
    rest = l.filter(~ok).agg(F.count(F.lit(1)).alias("n_loads")).select(
        F.lit(None).cast("date").alias("arrival_date"), "n_loads")
    return parsed.unionByName(rest)


@register("f9_hash_date", oracle="""
SELECT load_number, arrival_date, COUNT(*) AS n_loads FROM silver_potato_load_quality
WHERE NOT regexp_matches(load_number, '^.*-[0-9]{8}-.*$') GROUP BY load_number, arrival_date""")
def f9(spark, sf_dir):
    """fallback day ABS(HASH(id)) % 114 for ids without a date."""
    l = _P(spark, sf_dir).loads()
    return (l.filter(~F.col("load_number").rlike(C.LOAD_DATE_TEST))
            .groupBy("load_number", "arrival_date").agg(F.count(F.lit(1)).alias("n_loads")))


@register("f11_week", oracle="""
SELECT week_start, CAST(dayofweek(week_start) + 1 AS INTEGER) AS dow, COUNT(*) AS n
FROM silver_line_quality_events GROUP BY week_start""")
def f11(spark, sf_dir):
    """Monday week start (a TIMESTAMP) and its day of week (Sunday = 1)."""
    e = _P(spark, sf_dir).events()
    return e.groupBy("week_start").agg(F.count(F.lit(1)).alias("n")).select(
        "week_start", F.dayofweek("week_start").alias("dow"), "n")


@register("f16_age", oracle="""
SELECT CAST(floor(equipment_age_years) AS BIGINT) AS age_year, COUNT(*) AS n, AVG(equipment_age_years) AS avg_age
FROM silver_line_equipment GROUP BY 1""", digits={"avg_age": RATIO})
def f16(spark, sf_dir):
    """Equipment age in years (2 decimals) as of the fixed date."""
    e = _P(spark, sf_dir).equipment()
    return e.groupBy(F.floor("equipment_age_years").alias("age_year")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("equipment_age_years").alias("avg_age"))


@register("f22_depreciation", oracle="""
SELECT plant_name, plant_line, SUM(equipment_rated_throughput_tph) AS rated_tph,
       SUM(effective_rated_throughput_tph) AS effective_tph
FROM silver_line_equipment GROUP BY plant_name, plant_line""",
          digits={"rated_tph": RATIO, "effective_tph": RATIO})
def f22(spark, sf_dir):
    """depreciated throughput max(rated(1 - 0.005 age), 0.7 rated), per line."""
    e = _P(spark, sf_dir).equipment()
    return e.groupBy("plant_name", "plant_line").agg(
        F.sum("equipment_rated_throughput_tph").alias("rated_tph"),
        F.sum("effective_rated_throughput_tph").alias("effective_tph"))

