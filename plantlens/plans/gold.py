"""Gold layer (G10-G22): aggregates, flags, cost exposure, KPIs, scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens.functions import columns as C
from plantlens.operators.joins import asof_price_join, salted_join, spec_join, stated_small
from plantlens.operators.windows import running_sums, trailing_sums
from plantlens.plans.silver import copy_key, numbered_copies

# Fixed values that must equal the reference for right results.
# Regional cost parameters: (region, k_region USD per point-ton, downgrade loss USD per ton)
REGIONAL_PARAMS = [("NA", 25.0, 180.0), ("EU", 28.0, 170.0)]
SPEND_FALLBACK_DM_BASE = 21.0        # A6: fallback spend = k * max(dm - 21, 0)
PRICE_OPEN_END = "2025-12-31"        # W1: LEAD default for the last price interval
SAVINGS_PER_TPH = 10000              # G22: USD per lost t/h
SCENARIO_QUALITY_DELTA_PP = "0.2"    # G22: DECIMAL(2,1) constant
SCENARIO_CONFIDENCE = "0.6"          # G22: DECIMAL(2,1) constant
UPGRADE_TYPE = "cutter"              # G22: equipment type that gets an upgrade
RATIONALE = "Based on equipment age and throughput vs rated for "    # G22


def _day_attributes(days: DataFrame) -> DataFrame:
    """date -> date, day of week (Sunday = 1), weekend flag, Monday week start."""
    d = F.col("date")
    return days.select(d, F.dayofweek(d).alias("dow"),
                       F.when(F.dayofweek(d).isin(1, 7), F.lit(True)).otherwise(F.lit(False)).alias("is_weekend"),
                       C.week_start(d).alias("week_start"))


def date_spine_between(df: DataFrame, date_col: str = "date") -> DataFrame:
    """G10 over data: spine from the first to the last date present in ``df``.
    The bounds are one aggregate; the spine itself is generated, not scanned."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return _day_attributes(bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date")))


def line_hourly_quality(events: DataFrame, specs: DataFrame, tolerance: float = C.FLAG_TOLERANCE_PP,
                        small: bool = False) -> DataFrame:
    """G11 (J1, P11): readings fanned out to lines, flagged against the spec."""
    j = spec_join(events, specs, small=small)
    return j.select(
        "datetime", "date", "hour", "week_start", "plant_id", "plant_name",
        C.unknown("plant_line").alias("plant_line"),
        "product_name", "variety", "avg_length_mm",
        *[f"usda_color_{i}" for i in range(5)],
        "total_defect_points", "dry_solids_pct",
        *[f"fry_color_{i}_share" for i in range(5)],
        "min_dry_matter_pct", "max_dry_matter_pct",
        C.below("dry_solids_pct", "min_dry_matter_pct", tolerance).alias("under_quality_flag"),
        C.above("dry_solids_pct", "max_dry_matter_pct", tolerance).alias("over_quality_flag"),
    )


def reading_quality(events: DataFrame, specs: DataFrame, tolerance: float = C.FLAG_TOLERANCE_PP,
                    small: bool = False) -> DataFrame:
    """G11 at reading grain (H2 option): each reading once, flagged when any
    line making its product would flag it.

    A line flags ``under`` when dm < its min - tol, so some line does iff
    dm < max(min) - tol over the lines; likewise ``over`` iff dm > min(max) +
    tol.  The spec side is reduced to that envelope per (plant, product); where
    the caller states it small, readings are neither fanned out nor shuffled."""
    env = (specs.groupBy("plant_id", "plant_name", "product_name")
           .agg(F.max("min_dry_matter_pct").alias("min_dry_matter_pct"),
                F.min("max_dry_matter_pct").alias("max_dry_matter_pct")))
    j = events.join(stated_small(env, small), ["plant_id", "plant_name", "product_name"], "left")
    return j.select(
        "datetime", "date", "hour", "week_start", "plant_id", "plant_name", "product_name", "variety",
        "total_defect_points", "dry_solids_pct", *[f"fry_color_{i}_share" for i in range(5)],
        "min_dry_matter_pct", "max_dry_matter_pct",
        C.below("dry_solids_pct", "min_dry_matter_pct", tolerance).alias("under_quality_flag"),
        C.above("dry_solids_pct", "max_dry_matter_pct", tolerance).alias("over_quality_flag"),
    )


def quality_weekly(hourly: DataFrame) -> DataFrame:
    """G12 (A1-A3): weekly plant aggregates, dominant colour class, breach hours."""
    avgs = [F.avg(f"fry_color_{i}_share") for i in range(5)]
    return hourly.groupBy("week_start", "plant_name").agg(
        F.avg("dry_solids_pct").alias("avg_dry_solids_pct"),
        F.avg("total_defect_points").alias("avg_defect_points"),
        C.dominant_class(avgs).alias("fry_color_class_mode"),
        F.count_if("under_quality_flag").alias("hours_under_quality"),
        F.count_if("over_quality_flag").alias("hours_over_quality"),
    )


def quality_weekly_of_readings(events: DataFrame, specs: DataFrame, tolerance: float = C.FLAG_TOLERANCE_PP,
                               small: bool = False) -> DataFrame:
    """G12 straight from the readings: the rows of ``quality_weekly`` over the
    fanned-out table, without fanning out.

    Each reading meets its product's lines as one array of limits.  It counts once a line (once, where no
    line makes the product): means are weighted by that number, and breach
    hours are the number of limits it breaks."""
    lines = specs.groupBy("plant_id", "plant_name", "product_name").agg(
        F.collect_list(F.struct(F.col("min_dry_matter_pct").alias("lo"), F.col("max_dry_matter_pct").alias("hi"))).alias("lines"))
    j = events.join(stated_small(lines, small), ["plant_id", "plant_name", "product_name"], "left")
    dm = F.col("dry_solids_pct")
    under = F.size(F.filter("lines", lambda x: F.coalesce(dm < x["lo"] - F.lit(tolerance), F.lit(False))))
    over = F.size(F.filter("lines", lambda x: F.coalesce(dm > x["hi"] + F.lit(tolerance), F.lit(False))))
    j = j.select("week_start", "plant_name", dm, "total_defect_points", *[f"fry_color_{i}_share" for i in range(5)],
                 F.coalesce(F.nullif(F.size("lines"), F.lit(-1)), F.lit(1)).alias("n"),
                 F.greatest(under, F.lit(0)).alias("under"), F.greatest(over, F.lit(0)).alias("over"))

    def mean(name: str) -> Column:
        c = F.col(name)
        return F.sum(c * F.col("n")) / F.sum(F.when(c.isNotNull(), F.col("n")))

    return j.groupBy("week_start", "plant_name").agg(
        mean("dry_solids_pct").alias("avg_dry_solids_pct"), mean("total_defect_points").alias("avg_defect_points"),
        C.dominant_class([mean(f"fry_color_{i}_share") for i in range(5)]).alias("fry_color_class_mode"),
        F.sum("under").alias("hours_under_quality"), F.sum("over").alias("hours_over_quality"))


def oee_kpis(oee: DataFrame) -> DataFrame:
    """G13 (A4, P10): daily OEE aggregates per line with the kg/min proxy."""
    agg = oee.groupBy("date", "plant_name", "plant_line").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("downtime_min").alias("total_downtime_min"),
        F.sum("duration_min").alias("run_duration_min"),
        F.sum("qty_packed").alias("qty_packed_kg"),
        F.sum("num_totes_on").alias("num_totes_on"),
    )
    return agg.withColumn("oee_performance", C.safe_ratio("qty_packed_kg", "run_duration_min"))


def regional_param(region, which: int):
    """J5 as an expression: the two-row parameter table becomes a CASE, so no
    join is planned at all.  ``which``: 1 = k_region, 2 = downgrade loss."""
    expr = None
    for row in REGIONAL_PARAMS:
        cond = region == row[0]
        expr = F.when(cond, F.lit(row[which])) if expr is None else expr.when(cond, F.lit(row[which]))
    return expr


def spec_thresholds(specs: DataFrame) -> DataFrame:
    """DISTINCT (plant, product, min, max) from the spec dimension."""
    return specs.select("plant_name", "product_name", "min_dry_matter_pct", "max_dry_matter_pct").distinct()


def loads_priced(loads: DataFrame, costs: DataFrame, open_end: str = PRICE_OPEN_END,
                 small: bool = False, salt_buckets: int = 0) -> DataFrame:
    """Loads with the price in force on their arrival date."""
    l = loads.select(F.col("arrival_date").alias("date"), "plant_name", "region", "variety",
                     "dm_band", "tons", "dry_matter_pct")
    return asof_price_join(l, costs, open_end, load_date="date", small=small, salt_buckets=salt_buckets)


def cost_exposure(loads: DataFrame, costs: DataFrame, specs: DataFrame,
                  open_end: str = PRICE_OPEN_END, small: bool = False,
                  share_by_products: bool = False, pre_aggregate: bool = False,
                  salt_buckets: int = 0, tolerance: float = 0.0) -> DataFrame:
    """G14 (W1 J3 J4 J5 A5 A6 A12 S11): daily exposure per plant and product.

    Plan: loads get their price (as-of join, no load shuffle), fan out to
    their plant's products through the distinct thresholds (map side where
    the caller states them ``small``), and are reduced by a partial aggregate keyed by (day,
    plant, region, product).  The only shuffle carries one partial row per
    group and task, whatever the distribution of the loads.

    ``pre_aggregate=True`` first combines loads per (day, plant, region,
    dry matter, price) -- the only per-load values the sums depend on -- so
    the fan-out runs on fewer rows.  That pays off when dry matter is
    recorded to a fixed precision (few distinct values) and costs a shuffle
    of nearly every load when it is not, hence off by default.
    ``tolerance`` (H4 option) widens the spec band on both sides, as the
    quality flags do.  ``share_by_products=True`` (H3 option) splits a load's tons evenly over
    the plant's products instead of counting them once per product.
    """
    lp = loads_priced(loads, costs, open_end, small, salt_buckets)
    dm = F.col("dry_matter_pct")
    if pre_aggregate:
        lp = lp.groupBy("date", "plant_name", "region", "dry_matter_pct", "price_usd_per_ton").agg(
            F.sum("tons").alias("tons"), F.count(dm).alias("n_dm"))
        dm_sum, dm_n = F.sum(dm * F.col("n_dm")), F.sum("n_dm")
    else:
        dm_sum, dm_n = F.sum(dm), F.count(dm)
    thresholds = spec_thresholds(specs)
    if share_by_products:
        n = thresholds.groupBy("plant_name").agg(F.count(F.lit(1)).alias("n_products"))
        thresholds = thresholds.join(n, "plant_name")
    j = lp.join(stated_small(thresholds, small), "plant_name", "left")
    k = regional_param(F.col("region"), 1)
    loss = regional_param(F.col("region"), 2)
    tons = F.col("tons") / F.coalesce(F.col("n_products"), F.lit(1)) if share_by_products else F.col("tons")
    spend_rate = F.coalesce(F.col("price_usd_per_ton"),
                            k * F.greatest(dm - F.lit(SPEND_FALLBACK_DM_BASE), F.lit(0.0)))
    top, bottom = F.col("max_dry_matter_pct"), F.col("min_dry_matter_pct")
    if tolerance:
        top, bottom = top + F.lit(tolerance), bottom - F.lit(tolerance)
    over = F.when(dm > top, dm - top).otherwise(F.lit(0.0))
    under = F.when(dm < bottom, bottom - dm).otherwise(F.lit(0.0))
    return j.groupBy("date", "plant_name", "region", "product_name").agg(
        F.sum(tons).alias("tons_processed"),
        C.safe_ratio(dm_sum, dm_n).alias("avg_dry_matter_pct"),
        F.sum(spend_rate * tons).alias("raw_potato_spend_usd"),
        F.sum(over * k * tons).alias("over_quality_waste_usd"),
        F.sum(under * loss * tons).alias("downgrade_rework_exposure_usd"),
    )


def cumulative_costs(exposure: DataFrame, revenue: DataFrame, all_days: bool = False) -> DataFrame:
    """G15 (A7 A8 J6 W2-W4): running spend, waste and margin per region.

    Both sides are reduced to (date, region) before the join and the window,
    so the window partitions hold one row per day.  Cost-first LEFT JOIN:
    revenue on a day without cost is not counted (H14, parity);
    ``all_days=True`` keeps every day with cost or revenue.
    """
    spend_by_day = (exposure.withColumn("region", C.region_of("plant_name"))
                  .groupBy("date", "region")
                  .agg(F.sum("raw_potato_spend_usd").alias("spend_usd"),
                       F.sum("over_quality_waste_usd").alias("over_quality_waste_usd")))
    sales_by_day = revenue.groupBy("date", "region").agg(F.sum("net_sales_usd").alias("revenue_usd"))
    # all_days (H14 option): a day with revenue but no cost is kept too.
    j = spend_by_day.join(sales_by_day, ["date", "region"], "full" if all_days else "left")
    r = running_sums(j, ["region"], ["date"], {
        "cumulative_spend_usd": "spend_usd",
        "cumulative_over_quality_waste_usd": "over_quality_waste_usd",
        "cumulative_revenue_usd": "revenue_usd",
    })
    return r.select("date", "region", "cumulative_spend_usd", "cumulative_over_quality_waste_usd",
                    (F.col("cumulative_revenue_usd") - F.col("cumulative_spend_usd"))
                    .alias("cumulative_gross_margin_usd"))


def line_daily_metrics(hourly: DataFrame) -> DataFrame:
    """G16 (A9, A10): daily line/product aggregates of the hourly table."""
    return hourly.groupBy("date", "plant_name", "plant_line", "product_name").agg(
        F.avg("dry_solids_pct").alias("blend_dm_pct"),
        F.avg("total_defect_points").alias("defect_points"),
        F.sum(F.when(F.col("under_quality_flag"), 1).otherwise(0)).alias("hours_under_quality"),
        F.sum(F.when(F.col("over_quality_flag"), 1).otherwise(0)).alias("hours_over_quality"),
    )


def oee_daily_by_code(oee: DataFrame) -> DataFrame:
    """OEE rows reduced to one row per (date, plant, line, code, component)."""
    return oee.groupBy("date", "plant_name", "plant_line", "downtime_cat_1", "downtime_cat_2").agg(
        F.count(F.lit(1)).alias("oee_event_count"),
        F.sum("duration_min").alias("duration_min"),
        F.sum("downtime_min").alias("downtime_min"),
    )


def change_alignment(hourly: DataFrame, oee: DataFrame, salt_buckets: int = 0) -> DataFrame:
    """G17 (J2): quality readings aligned with the day's OEE activity on their line.

    The reference joins every reading to every OEE row of the same day and
    line (all pairs of the group).  Here the OEE side is first reduced to one
    row per (day, line, code, component) with the event count and summed
    minutes, so a reading meets at most one row per downtime code pair, a
    number fixed by the code list rather than by the data.  Summing
    ``duration_min``/``downtime_min`` over this table gives the same totals
    as over the reference's.  Spark broadcasts the reduced OEE side (days x lines
    x codes) if it measures small; else it is a shuffle join on (day, plant,
    line), where AQE splits a hot day-line, or an explicitly salted join.
    """
    q = hourly.select("date", "hour", "plant_name", "plant_line", "product_name", "dry_solids_pct",
                      "under_quality_flag", "over_quality_flag")
    keys = ["date", "plant_name", "plant_line"]
    o = oee_daily_by_code(oee)
    if salt_buckets > 0:
        return salted_join(q, o, keys, "left", salt_buckets)
    return q.join(o, keys, "left")


ALIGN_KEYS = ["date", "plant_name", "plant_line"]
ALIGN_READING = ["hour", "product_name", "dry_solids_pct", "under_quality_flag", "over_quality_flag"]
ALIGN_EVENT = ["downtime_cat_1", "downtime_cat_2", "duration_min", "downtime_min"]
ALIGN_CHUNK = 1000


def _in_chunks(df: DataFrame, fields: list[str], name: str, chunk: int) -> DataFrame:
    """One row for each day, line and chunk: an array of about ``chunk`` different
    rows with their number of copies.  Equal rows are counted first and chunks
    dealt by a hash of the row, so a hot day and line has many bounded arrays."""
    same = df.groupBy(*ALIGN_KEYS, *fields).agg(F.count(F.lit(1)).alias("copies"))
    sizes = same.groupBy(*[F.col(k).alias(f"{k}_of") for k in ALIGN_KEYS]).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"))
    on = [same[k].eqNullSafe(sizes[f"{k}_of"]) for k in ALIGN_KEYS]
    dealt = same.join(sizes, on).withColumn("chunk", F.pmod(F.xxhash64(*fields), F.col("chunks")))
    return dealt.groupBy(*ALIGN_KEYS, "chunk").agg(F.collect_list(F.struct(*fields, "copies")).alias(name)).drop("chunk")


def alignment_factors(hourly: DataFrame, oee: DataFrame, chunk: int = ALIGN_CHUNK) -> DataFrame:
    """G17 (J2) at event grain, factorised: the readings and the OEE events of a
    day and line side by side as arrays, not as all their pairs.

    A row stands for the product of its two arrays, so r readings and e events
    take r + e entries and not r x e rows; beyond ``chunk`` entries a side is cut
    and its chunks meet each chunk of the other.  ``expand_alignment`` gives the
    literal join's rows, in the tasks that read them, without another join."""
    readings = _in_chunks(hourly.select(*ALIGN_KEYS, *ALIGN_READING), ALIGN_READING, "readings", chunk)
    events = _in_chunks(oee.select(*ALIGN_KEYS, *ALIGN_EVENT), ALIGN_EVENT, "events", chunk)
    return readings.join(events, ALIGN_KEYS, "left")


def expand_alignment(factors: DataFrame, counted: list[str] | None = None) -> DataFrame:
    """The rows of ``hourly LEFT JOIN oee`` on day, plant and line.

    ``counted`` names the reading and event columns that the caller reads.  The same
    rows then come with only these (and the keys), and equal ones are not repeated but
    counted in ``copies`` (possibly in several parts): a side none of whose columns is
    read is its number of rows, so nothing grows with readings times events."""
    if counted is not None:
        return _counted_alignment(factors, counted)
    rows = factors.select(*ALIGN_KEYS, F.explode("readings").alias("r"), "events").select(
        *ALIGN_KEYS, "r", F.explode_outer("events").alias("e"))
    copies = F.col("r.copies") * F.coalesce(F.col("e.copies"), F.lit(1))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"))
    return rows.select(*ALIGN_KEYS, *[F.col(f"r.{c}").alias(c) for c in ALIGN_READING], *[F.col(f"e.{c}").alias(c) for c in ALIGN_EVENT])


def _counted_alignment(factors: DataFrame, counted: list[str]) -> DataFrame:
    unknown = [c for c in counted if c not in ALIGN_READING + ALIGN_EVENT]
    if unknown:
        raise ValueError(f"not columns of the alignment: {unknown}")

    def rows_of(side: str) -> Column:
        return F.aggregate(side, F.lit(0).cast("long"), lambda n, x: n + x["copies"])

    reading, event = [c for c in ALIGN_READING if c in counted], [c for c in ALIGN_EVENT if c in counted]
    r = F.explode("readings") if reading else F.struct(rows_of("readings").alias("copies"))
    e = F.explode_outer("events") if event else F.struct(rows_of("events").alias("copies"))
    rows = factors.select(*ALIGN_KEYS, r.alias("r"), "events").select(*ALIGN_KEYS, "r", e.alias("e"))
    copies = F.col("r.copies") * F.coalesce(F.col("e.copies"), F.lit(1))
    return rows.select(*ALIGN_KEYS, *[F.col(f"r.{c}").alias(c) for c in reading], *[F.col(f"e.{c}").alias(c) for c in event],
                       copies.alias("copies"))


def kpi_total_tons_30d(oee_daily: DataFrame, anchor: Column | None = None) -> DataFrame:
    """SUM(qty_packed_kg)/1000 over the trailing 30 days (31 inclusive).
    ``anchor`` is the latest day, where it is known without a scan."""
    s = trailing_sums(oee_daily, "date", 30, {"qty": F.col("qty_packed_kg")}, anchor=anchor)
    return s.select((F.col("qty") / 1000.0).alias("total_tons_last_30d"))


def kpi_raw_spend_30d(exposure: DataFrame, anchor: Column | None = None) -> DataFrame:
    """Raw spend over the trailing 30 days."""
    return trailing_sums(exposure, "date", 30, {"raw_potato_spend_last_30d_usd": F.col("raw_potato_spend_usd")},
                         anchor=anchor)


def kpi_oee_performance_7d(oee_daily: DataFrame, anchor: Column | None = None) -> DataFrame:
    """G20 (A13): mean of the daily line ratios over the trailing 7 days (8
    inclusive): the mean of ratios, not the ratio of sums."""
    p = F.col("oee_performance")
    s = trailing_sums(oee_daily, "date", 7, {"s": p, "n": F.when(p.isNotNull(), F.lit(1))}, anchor=anchor)
    return s.select(C.safe_ratio("s", "n").alias("oee_performance_avg_last_7d"))


def kpi_downgrade_30d(exposure: DataFrame, anchor: Column | None = None) -> DataFrame:
    """Downgrade exposure over the trailing 30 days."""
    return trailing_sums(exposure, "date", 30,
                         {"downgrade_rework_exposure_last_30d_usd": F.col("downgrade_rework_exposure_usd")}, anchor=anchor)


def scenario_recommendations(equipment: DataFrame) -> DataFrame:
    """One suggestion per machine: cutters -> upgrade, others -> reallocation;
    savings = lost t/h x 10,000.  Ids hash the machine key (H5), with a number
    from the second of equal machines on."""
    columns = ["plant_name", "plant_line", "equipment_id", "commission_date", "equipment_rated_throughput_tph", "equipment_type",
               "equipment_description", "effective_rated_throughput_tph"]
    equipment = numbered_copies(equipment.select(columns))
    lost = F.greatest(F.coalesce(F.col("equipment_rated_throughput_tph")
                                 - F.col("effective_rated_throughput_tph"), F.lit(0.0)), F.lit(0.0))
    key = F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in (
        F.col("plant_name"), F.col("plant_line"), F.col("equipment_id"), F.date_format("commission_date", "yyyy-MM-dd"),
        F.expr("cast(cast(round(equipment_rated_throughput_tph * 1000) as bigint) as string)"),
        F.col("equipment_type"), F.col("equipment_description"))])
    return equipment.select(
        F.concat(F.lit("REC-"), F.md5(copy_key(key))).alias("recommendation_id"),
        F.when(F.col("equipment_type") == UPGRADE_TYPE, F.lit("equipment_upgrade"))
        .otherwise(F.lit("load_reallocation")).alias("type"),
        "plant_name", "plant_line",
        F.round(lost * SAVINGS_PER_TPH, 0).alias("expected_savings_usd"),
        F.lit(SCENARIO_QUALITY_DELTA_PP).cast("decimal(2,1)").alias("expected_quality_delta_pp"),
        F.lit(SCENARIO_CONFIDENCE).cast("decimal(2,1)").alias("confidence"),
        F.concat(F.lit(RATIONALE), F.col("equipment_id"))
        .alias("rationale"),
    )
