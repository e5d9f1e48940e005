"""Signal jobs: QA summaries (X1), load-id parsing (X2) and the README
questions D1-D4 and D6.  Definitions of D* are ours (the reference only
asks the questions)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens.functions import columns as C

# Plant code, yyyyMMdd, sequence, supplier, anchored at both ends (H7).
LOAD_ID_PATTERN = r"^(.+)-([0-9]{8})-([0-9]+)-(S[0-9]+)$"


@dataclass(frozen=True)
class EventWindow:
    """Story parameters of the QA summaries (H12: the end is inclusive by day)."""
    start: str = "2024-01-10"
    end: str = "2024-01-20"
    over_plant: str = "EU-P3"
    over_product: str = "PRD-2"
    under_plant: str = "NA-P1"
    under_product: str = "PRD-0"
    supplier_plant: str = "EU-P3"
    supplier: str = "S7"
    tranche_start: str = "2024-01-15"
    oee_plant: str = "NA-P1"
    oee_line: str = "L3"


def in_window(ts: Column, w: EventWindow) -> Column:
    """start <= ts < end + 1 day (the end day is included whole)."""
    return (ts >= F.lit(w.start).cast("timestamp")) & (ts < F.date_add(F.lit(w.end).cast("date"), 1).cast("timestamp"))


def parse_load_id(loads: DataFrame, col: str = "load_number") -> DataFrame:
    """Plant code, arrival date, sequence and supplier out of the load id.
    Malformed ids give NULLs in all four."""
    c = F.col(col)
    ok = c.rlike(LOAD_ID_PATTERN)
    part = lambda i: F.when(ok, F.regexp_extract(c, LOAD_ID_PATTERN, i))
    return loads.withColumns({
        "id_plant": part(1),
        "id_date": F.try_to_timestamp(part(2), F.lit("yyyyMMdd")).cast("date"),
        "id_seq": part(3).try_cast("int"),          # an over-long sequence -> NULL, not an ANSI error
        "id_supplier": part(4),
    })


def load_id_summary(loads: DataFrame) -> DataFrame:
    """X2 as a table: loads per (plant code, supplier) with first/last day."""
    p = parse_load_id(loads)
    return p.groupBy("id_plant", "id_supplier").agg(
        F.count(F.lit(1)).alias("n_loads"),
        F.min("id_date").alias("first_date"),
        F.max("id_date").alias("last_date"),
        F.max("id_seq").alias("max_seq"),
    )


def story_signals(events: DataFrame, loads: DataFrame, oee: DataFrame,
                  w: EventWindow = EventWindow()) -> DataFrame:
    """The four QA signals as rows (signal, mean_a, mean_b, n).

    Each source table is filtered to the rows that any of its signals counts (the
    window reaches the scan) and aggregated once with conditional aggregates;
    each one-row result is exploded into its signal rows and the three are
    unioned (no join of single rows, no table read twice)."""
    ts = F.col("datetime")
    over = in_window(ts, w) & (F.col("plant_name") == w.over_plant) & (F.col("product_name") == w.over_product)
    under = in_window(ts, w) & (F.col("plant_name") == w.under_plant) & (F.col("product_name") == w.under_product)
    ev = events.filter(in_window(ts, w)).filter(over | under).agg(
        F.avg(F.when(over, F.col("dry_solids_pct"))).alias("o_a"),
        F.count_if(over).alias("o_n"),
        F.avg(F.when(under, F.col("dry_solids_pct"))).alias("u_a"),
        F.avg(F.when(under, F.col("total_defect_points").cast("double"))).alias("u_b"),
        F.count_if(under).alias("u_n"),
    )
    p = parse_load_id(loads)
    sup = ((F.col("plant_name") == w.supplier_plant) & (F.col("id_supplier") == w.supplier)
           & (F.col("id_date") >= F.lit(w.tranche_start).cast("date")))
    ld = p.filter(sup).agg(F.avg(F.when(sup, F.col("dry_matter_pct"))).alias("s_a"), F.count_if(sup).alias("s_n"))
    down = (in_window(ts, w) & (F.col("plant_name") == w.oee_plant) & (F.col("plant_line") == w.oee_line)
            & (F.col("downtime_cat_1") != "run"))
    oe = oee.filter(in_window(ts, w)).filter(down).agg(F.count_if(down).alias("d_n"))
    none = F.lit(None).cast("double")

    def row(signal, a, b, n):
        return F.struct(F.lit(signal).alias("signal"), a.alias("mean_a"), b.alias("mean_b"), n.alias("n"))

    # Each table is aggregated once; its single row fans out to its signals.
    ev_rows = ev.select(F.explode(F.array(
        row("over_quality_dm", F.col("o_a"), none, F.col("o_n")),
        row("under_quality_dm_defects", F.col("u_a"), F.col("u_b"), F.col("u_n")))).alias("r")).select("r.*")
    ld_rows = ld.select(row("supplier_dm_after_tranche", F.col("s_a"), none, F.col("s_n")).alias("r")).select("r.*")
    oe_rows = oe.select(row("downtime_events_in_window", none, none, F.col("d_n")).alias("r")).select("r.*")
    return ev_rows.unionByName(ld_rows).unionByName(oe_rows)


def signed_deviation(hourly: DataFrame, tol: float = C.FLAG_TOLERANCE_PP) -> Column:
    """Points beyond the tolerance band: positive above max+tol, negative
    below min-tol, 0 inside (GREATEST skips NULLs, so a missing spec gives 0)."""
    dm, lo, hi = F.col("dry_solids_pct"), F.col("min_dry_matter_pct"), F.col("max_dry_matter_pct")
    return (F.greatest(dm - (hi + F.lit(tol)), F.lit(0.0)) - F.greatest((lo - F.lit(tol)) - dm, F.lit(0.0)))


def daily_deviation(hourly: DataFrame, tol: float = C.FLAG_TOLERANCE_PP) -> DataFrame:
    """D1 per day and line/product: mean signed deviation, worst over, worst under."""
    d = hourly.withColumn("deviation_pp", signed_deviation(hourly, tol))
    return d.groupBy("date", "plant_name", "plant_line", "product_name").agg(
        F.avg("deviation_pp").alias("avg_deviation_pp"),
        F.max("deviation_pp").alias("max_over_pp"),
        F.min("deviation_pp").alias("max_under_pp"),
        F.count_if(F.col("deviation_pp") != 0).alias("n_outside"),
    )


def breach_episodes(hourly: DataFrame, gap_minutes: int = 120,
                    keys=("plant_name", "plant_line", "product_name")) -> DataFrame:
    """Persistent breaches as episodes of flagged readings of one kind
    whose consecutive gaps are shorter than ``gap_minutes`` (session-window
    semantics).

    Planned for skew: flagged readings are first reduced to one piece per
    (key, kind, clock hour) by an ordinary aggregate (map-side combined, so
    a hot line is split across tasks); only these pieces, at most 24 per key
    and day, go through the gaps-and-islands window.  An hour is shorter than
    the gap, so the readings of one piece always belong to one episode.
    """
    kind = (F.when(F.col("under_quality_flag"), F.lit("under"))
            .when(F.col("over_quality_flag"), F.lit("over")))
    flagged = hourly.select(*keys, "datetime", kind.alias("kind")).filter(F.col("kind").isNotNull())
    pieces = flagged.groupBy(*keys, "kind", F.date_trunc("HOUR", "datetime").alias("hour_ts")).agg(
        F.min("datetime").alias("first_ts"), F.max("datetime").alias("last_ts"),
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys, "kind").orderBy("first_ts")
    prev_last = F.lag("last_ts").over(w)
    new = F.when(prev_last.isNull(), 1).when(
        F.col("first_ts") >= F.timestamp_add("MINUTE", F.lit(gap_minutes), prev_last), 1).otherwise(0)
    islands = pieces.withColumn("episode", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "kind", "episode").agg(
        F.min("first_ts").alias("episode_start"),
        F.max("last_ts").alias("episode_end"),
        F.sum("n").alias("n_readings"),
    ).drop("episode")


def supplier_mix(loads: DataFrame, split_date: str) -> DataFrame:
    """Each supplier's share of a plant's tons before and after a date
    (by arrival day).  Loads whose id names no supplier stay in the table
    under a NULL supplier, so the shares of a plant sum to 1."""
    p = parse_load_id(loads)
    period = (F.when(F.col("arrival_date") < F.lit(split_date).cast("date"), F.lit("before"))
              .otherwise(F.lit("after")))
    agg = p.groupBy("plant_name", period.alias("period"), "id_supplier").agg(
        F.sum("tons").alias("tons"), F.avg("dry_matter_pct").alias("avg_dry_matter_pct"))
    total = F.sum("tons").over(Window.partitionBy("plant_name", "period"))
    return agg.withColumn("tons_share", F.col("tons") / total)


def window_costs(exposure: DataFrame, start: str, end: str) -> DataFrame:
    """D3: cost exposure inside an event window, per plant and product."""
    inside = exposure.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return inside.groupBy("plant_name", "product_name").agg(
        F.sum("raw_potato_spend_usd").alias("spend_usd"),
        F.sum("over_quality_waste_usd").alias("over_quality_waste_usd"),
        F.sum("downgrade_rework_exposure_usd").alias("downgrade_rework_exposure_usd"),
        F.count(F.lit(1)).alias("n_days"),
    )


def oee_parts(hourly: DataFrame, oee: DataFrame) -> DataFrame:
    """Daily availability, performance proxy and quality per line.

    availability = 1 - downtime / run minutes; quality = 1 - flagged
    readings / readings.  Both sides are aggregated to (day, line) before
    the join, so the join is one-to-one."""
    o = oee.groupBy("date", "plant_name", "plant_line").agg(
        F.sum("downtime_min").alias("downtime_min"), F.sum("duration_min").alias("run_min"),
        F.sum("qty_packed").alias("qty_packed_kg"))
    q = hourly.groupBy("date", "plant_name", "plant_line").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("under_quality_flag") | F.col("over_quality_flag")).alias("flagged"))
    j = o.join(q, ["date", "plant_name", "plant_line"], "full")
    return j.select(
        "date", "plant_name", "plant_line",
        (F.lit(1.0) - C.safe_ratio("downtime_min", "run_min")).alias("availability"),
        C.safe_ratio("qty_packed_kg", "run_min").alias("performance_kg_per_min"),
        (F.lit(1.0) - C.safe_ratio(F.col("flagged").cast("double"), "readings")).alias("quality"),
    )


def code_drift_correlation(hourly: DataFrame, oee: DataFrame) -> DataFrame:
    """Per plant and downtime code, Pearson correlation over the plant's
    reading days between the code's downtime minutes (0 on days without it)
    and the day's flagged-reading share.

    Computed from sufficient statistics instead of a days x codes grid: the
    per-plant sums of y and y^2 over its days, and the per-(plant, code)
    sums of x, x^2 and xy over the days the code occurred (zero days add
    nothing to them).  One aggregate per source and one join of two small
    aggregates; a constant series gives NULL rather than a divide error.
    """
    # one row per (day, plant)
    q = hourly.groupBy("date", "plant_name").agg(
        (F.count_if(F.col("under_quality_flag") | F.col("over_quality_flag")) / F.count(F.lit(1)))
        .alias("y"))
    per_plant = q.groupBy("plant_name").agg(
        F.count(F.lit(1)).alias("n_days"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"))
    codes = oee.filter(F.col("downtime_cat_1") != "run").groupBy("date", "plant_name", "downtime_cat_2").agg(
        F.sum("downtime_min").alias("x"))
    # Left join: a code seen only on days without readings still gets a row
    # (all its sums 0, so a NULL correlation), as in the grid formulation.
    on_days = codes.join(q, ["date", "plant_name"], "left")
    x_on = F.when(F.col("y").isNotNull(), F.col("x"))
    per_code = on_days.groupBy("plant_name", "downtime_cat_2").agg(
        F.sum(x_on).alias("sx"), F.sum(x_on * x_on).alias("sxx"), F.sum(x_on * F.col("y")).alias("sxy"))
    j = per_code.join(per_plant, "plant_name")
    n = F.col("n_days").cast("double")
    sx, sxx, sxy = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("sx", "sxx", "sxy"))
    vx = n * sxx - sx * sx
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    cov = n * sxy - sx * F.col("sy")
    return j.select("plant_name", "downtime_cat_2", "n_days",
                    F.when((vx > 0) & (vy > 0), F.try_divide(cov, F.sqrt(vx * vy))).alias("corr_downtime_flagged"))


def reallocation(loads: DataFrame, high_dm: float = 23.0, low_dm: float = 21.0) -> DataFrame:
    """Greedy move of high-dry-matter tons to plants short of dry matter,
    inside a region and day.

    Donors (kilograms above ``high_dm``) and receivers (kilograms at or
    below ``low_dm``) are laid on two axes by running sums ordered by plant.
    The tons moved between a donor and a receiver are the overlap of their
    intervals; it is found by a sweep rather than a join: the interval ends
    of both axes are put in one ordered list per (day, region), each gap
    between consecutive ends belongs to the next donor end and the next
    receiver end at or after it, and the gaps are summed per pair.  One scan,
    one aggregate, windows over a few rows per (day, region), no self-join.
    The axes are whole kilograms, so the sweep is exact.  The receiver's
    blended dry matter after all its moves is reported too.
    """
    kg = F.round(F.col("tons") * 1000).cast("bigint")
    dm = F.col("dry_matter_pct")
    g = loads.filter(F.col("region").isNotNull()).groupBy(
        F.col("arrival_date").alias("date"), "region", "plant_name").agg(
        F.sum(F.when(dm > high_dm, kg)).alias("high_kg"),
        F.sum(F.when(dm > high_dm, kg * dm)).alias("high_dm_kg"),
        F.sum(F.when(dm <= low_dm, kg)).alias("low_kg"),
        F.sum(kg).alias("kg"),
        F.sum(kg * dm).alias("dm_kg"),
    )
    day = Window.partitionBy("date", "region")
    axis = day.orderBy("plant_name").rowsBetween(Window.unboundedPreceding, 0)
    high, low = F.coalesce(F.col("high_kg"), F.lit(0)), F.coalesce(F.col("low_kg"), F.lit(0))
    ends = g.withColumns({"cum_high": F.sum(high).over(axis), "cum_low": F.sum(low).over(axis)}).select(
        "date", "region",
        F.explode(F.array(
            F.struct(F.col("cum_high").alias("pos"),
                     F.when(high > 0, F.struct(F.col("plant_name").alias("plant"),
                                               (F.col("high_dm_kg") / F.col("high_kg")).alias("high_dm")))
                     .alias("donor"),
                     F.lit(None).cast("struct<plant:string,kg:bigint,dm_kg:double>").alias("receiver")),
            F.struct(F.col("cum_low").alias("pos"),
                     F.lit(None).cast("struct<plant:string,high_dm:double>").alias("donor"),
                     F.when(low > 0, F.struct(F.col("plant_name").alias("plant"), F.col("kg").alias("kg"),
                                              F.col("dm_kg").alias("dm_kg"))).alias("receiver")),
        )).alias("e"),
    ).select("date", "region", "e.*")
    ends = ends.filter(F.col("donor").isNotNull() | F.col("receiver").isNotNull())
    sweep = day.orderBy("pos", F.col("donor").isNull()).rowsBetween(0, Window.unboundedFollowing)
    order = day.orderBy("pos", F.col("donor").isNull())
    seg = ends.select(
        "date", "region",
        (F.col("pos") - F.coalesce(F.lag("pos").over(order), F.lit(0))).alias("seg_kg"),
        F.first("donor", ignorenulls=True).over(sweep).alias("d"),
        F.first("receiver", ignorenulls=True).over(sweep).alias("r"),
    ).filter((F.col("seg_kg") > 0) & F.col("d").isNotNull() & F.col("r").isNotNull())
    pairs = seg.groupBy("date", "region", F.col("d.plant").alias("donor_plant"),
                        F.col("r.plant").alias("receiver_plant")).agg(
        F.sum("seg_kg").alias("moved_kg"), F.first("d.high_dm").alias("donor_high_dm"),
        F.first("r.kg").alias("r_kg"), F.first("r.dm_kg").alias("r_dm_kg"))
    rw = Window.partitionBy("date", "region", "receiver_plant")
    after = ((F.col("r_dm_kg") + F.sum(F.col("moved_kg") * F.col("donor_high_dm")).over(rw))
             / (F.col("r_kg") + F.sum("moved_kg").over(rw)))
    return pairs.select("date", "region", "donor_plant", "receiver_plant",
                        (F.col("moved_kg") / 1000.0).alias("moved_tons"), "donor_high_dm",
                        (F.col("r_dm_kg") / F.col("r_kg")).alias("receiver_dm_before"),
                        after.alias("receiver_dm_after"))
