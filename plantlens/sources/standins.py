"""Raw-table stand-ins projected from the driver's test tables.

The reference generates its raw tables with a single-machine simulator; that
is not rebuilt.  Instead each raw table is a pure column projection of one of
the shared test tables (see FIXTURES.md, section B), so every job downstream
reads data whose size grows with the inputs.  All numbers come from integer
arithmetic on keys, so the DuckDB oracle reproduces them bit for bit.

Every function here is a narrow projection (no shuffle) except the two tiny
dimension tables, which are the distinct keys of ``part``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.sources.readers import read_table

# Fixed values of the stand-in layout (FIXTURES.md, section B):
# (plant_id, plant_name, number of lines)
PLANTS = [(1, "NA-P1", 4), (2, "NA-P2", 3), (3, "EU-P3", 5), (4, "EU-P4", 4)]
N_PRODUCTS = 3
DAY0 = "2024-01-01"
N_DAYS = 45
DM_BANDS = ["<=21%", "21-22%", "22-23%", ">=23%"]
COST_REGIONS = [" na ", "eu"]
EQUIPMENT_TYPES = ["cutter", "Fryer", "peeler", "blancher", "packer"]
DOWNTIME_COMPONENTS = ["Cutter ", "FRYER", "conveyor"]
TIERS = ["gold", "silver", "bronze"]


def _case(key: Column, values: list) -> Column:
    """CASE key WHEN i THEN values[i] ... over a small fixed list."""
    expr = F.when(key == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(key == i, F.lit(v))
    return expr


def plant_name_of(plant_id: Column) -> Column:
    expr = None
    for pid, name, _ in PLANTS:
        expr = (F.when(plant_id == pid, F.lit(name)) if expr is None
                else expr.when(plant_id == pid, F.lit(name)))
    return expr


def n_lines_of(plant_id: Column) -> Column:
    expr = None
    for pid, _, n in PLANTS:
        expr = (F.when(plant_id == pid, F.lit(n)) if expr is None
                else expr.when(plant_id == pid, F.lit(n)))
    return expr


def _day(key: Column) -> Column:
    return F.date_add(F.lit(DAY0).cast("date"), (key % N_DAYS).cast("int"))


def _product_name(k: Column) -> Column:
    return F.concat(F.lit("PRD-"), k.cast("string"))


def product_specs_from(parts: DataFrame) -> DataFrame:
    """The (plant, line, product) combinations that the part keys name: at most
    48 rows, less those of one product that its plant makes without a spec."""
    offsets, acc = [], 0
    for _, _, n in PLANTS:
        offsets.append(acc)
        acc += n
    pk = F.col("p_partkey")
    ids = parts.select((pk % acc).alias("line"), (F.floor(pk / acc) % N_PRODUCTS).alias("product")).distinct()
    ids = ids.filter((F.col("line") < offsets[3]) | (F.col("product") != N_PRODUCTS - 1))
    line_idx, k = F.col("line"), F.col("product").cast("int")
    plant_id = (F.when(line_idx < offsets[1], 1).when(line_idx < offsets[2], 2)
                .when(line_idx < offsets[3], 3).otherwise(4))
    return (ids.select(plant_id.cast("int").alias("plant_id"), line_idx.alias("li"), k.alias("k"))
            .select(
                "plant_id",
                plant_name_of(F.col("plant_id")).alias("plant_name"),
                F.concat(F.lit("L"), (F.col("li") - _case(F.col("plant_id") - 1, offsets) + 1)
                         .cast("string")).alias("plant_line"),
                (F.col("k") + 100).cast("bigint").alias("product_id"),
                _product_name(F.col("k")).alias("product_name"),
                (60 + 5 * F.col("k")).cast("int").alias("average_length_grading_mm_min"),
                (70 + 5 * F.col("k")).cast("int").alias("average_length_grading_mm_target"),
                (80 + 5 * F.col("k")).cast("int").alias("average_length_grading_mm_max"),
                F.lit(0.7).cast("double").alias("pct_min_50mm_length"),
                F.lit(0.3).cast("double").alias("pct_min_75mm_length"),
                *[F.lit(float(4 - i)).alias(f"max_usda_color_{i}_pct") for i in range(5)],
                F.lit(2500).cast("int").alias("max_defect_points"),
                (F.lit(21.505) + F.lit(0.4) * F.col("k")).cast("double").alias("min_dry_matter_pct"),
                (F.lit(22.105) + F.lit(0.4) * F.col("k")).cast("double").alias("max_dry_matter_pct"),
                F.array(F.lit("variety 0"), F.concat(F.lit("variety "), F.col("k").cast("string")))
                .alias("approved_potato_varieties"),
            ))


def line_quality_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly quality readings: events of type view/click/signup."""
    return line_quality_events_from(read_table(spark, sf_dir, "events"))


def line_quality_events_from(events: DataFrame) -> DataFrame:
    """The reading projection over any events frame, batch or streaming."""
    ev = events.filter(F.col("event_type").isin("view", "click", "signup"))
    eid = F.col("event_id")
    plant_id = (F.col("user_id") % 4 + 1).cast("int")
    zero = eid % 97 == 0
    mods = [5, 7, 11, 13, 3]
    return ev.select(
        F.col("ts").cast("timestamp").alias("datetime"),
        plant_id.alias("plant_id"),
        plant_name_of(plant_id).alias("plant_name"),
        F.when(eid % 509 != 0, (eid % N_PRODUCTS + 100).cast("string")).alias("product_id"),
        F.when(eid % 521 != 0, _product_name(eid % N_PRODUCTS)).alias("product_name"),
        F.when(eid % 503 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("variety "), (eid % 5).cast("string"))).alias("variety"),
        (60 + eid % 30).cast("int").alias("avg_length_mm"),
        *[F.when(zero, F.lit(0).cast("bigint")).otherwise(eid % m).cast("bigint").alias(f"usda_color_{i}")
          for i, m in enumerate(mods)],
        (1200 + eid % 2400).cast("bigint").alias("total_defect_points"),
        (F.lit(20.0) + (F.round(F.col("value") * 100).cast("bigint") % 450) / 100.0)
        .alias("dry_solids_pct"),
    )


def oee_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run segments and downtime: events of type purchase/error."""
    return oee_events_from(read_table(spark, sf_dir, "events"))


def oee_events_from(events: DataFrame) -> DataFrame:
    ev = events.filter(F.col("event_type").isin("purchase", "error"))
    eid = F.col("event_id")
    plant_id = (F.col("user_id") % 4 + 1).cast("int")
    duration = (600 + (eid * 7919) % 17400).cast("bigint")
    # three stretches of days, so that the trailing windows leave rows out
    ts = F.timestamp_add("DAY", (eid % 3) * 20, F.col("ts").cast("timestamp"))
    end_ts = F.timestamp_add("SECOND", duration, ts)
    is_error = F.col("event_type") == "error"
    return ev.select(
        ts.alias("datetime"),
        plant_id.alias("plant_id"),
        plant_name_of(plant_id).alias("plant_name"),
        F.concat(F.lit("L"), (eid % n_lines_of(plant_id) + 1).cast("string")).alias("plant_line"),
        F.when(is_error, F.lit(" Maintenance ")).otherwise(F.lit("Run")).alias("downtime_cat_1"),
        F.when(is_error, _case(eid % 3, DOWNTIME_COMPONENTS)).alias("downtime_cat_2"),
        _product_name(eid % N_PRODUCTS).alias("product_name"),
        ts.alias("start_time"),
        F.when(eid % 20 < 3, F.date_format(end_ts, "MM/dd/yyyy HH:mm:ss"))
        .when(eid % 20 == 3, F.date_format(end_ts, "yyyy-MM-dd HH:mm"))
        .otherwise(F.date_format(end_ts, "yyyy-MM-dd HH:mm:ss")).alias("end_time"),
        duration.alias("duration"),
        ((duration * (F.col("user_id") % 4)) / 10).cast("bigint").alias("downtime_duration"),
        (F.col("value") * 100).alias("qty_packed"),
        F.when(eid % 499 == 0, F.lit(None).cast("double"))
        .otherwise((eid % 9).cast("double")).alias("num_totes_on"),
    )


def load_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One potato load per lineitem row."""
    return load_quality_from(read_table(spark, sf_dir, "lineitem"))


def load_quality_from(li: DataFrame) -> DataFrame:
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    plant_id = (sk % 4 + 1).cast("int")
    plant_name = plant_name_of(plant_id)
    line_no = F.col("l_linenumber").cast("string")
    day = _day(ok)
    yyyymmdd = (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("string")
    well_formed = F.concat_ws("-", plant_name, yyyymmdd, line_no,
                              F.concat(F.lit("S"), (sk % 12 + 1).cast("string")))
    return li.select(
        plant_id.alias("plant_id"),
        plant_name.alias("plant_name"),
        F.when(ok % 331 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("variety "), (pk % 5).cast("string"))).alias("VarietyLabel"),
        F.when(ok % 401 == 0, F.concat_ws("-", plant_name, F.lit("bad"), line_no))
        .otherwise(well_formed).alias("load_number"),
        (12000 + F.col("l_quantity") * 320).cast("int").alias("effective_actual_weight"),
        (60 + pk % 30).cast("int").alias("average_length_grading_mm"),
        (40 + ok % 20).cast("double").alias("usda_color_0_pct"),
        (20 + pk % 15).cast("double").alias("usda_color_1_pct"),
        (10 + sk % 10).cast("double").alias("usda_color_2_pct"),
        (F.col("l_linenumber") % 5).cast("double").alias("usda_color_3_pct"),
        (ok % 3).cast("double").alias("usda_color_4_pct"),
        (1000 + pk % 2000).cast("int").alias("total_defect_points"),
        F.when(ok % 409 != 0, F.lit(20.0) + F.col("l_discount") * 45).alias("dry_matter_pct"),
    )


N_PRICES = 7 * 2 * 12 * 5 * 4
PRICES_PER_PART = 17


def variety_costs_from(parts: DataFrame) -> DataFrame:
    """Weekly price list of the entries that the part keys name, 17 each: at most
    7 weeks x 2 regions x 12 suppliers x 5 varieties x 4 bands.  (Not the line
    keys: a dimension should not cost a scan of the largest table.)

    A (region, variety, band, week) key has up to 12 tied supplier rows on purpose.
    """
    i = F.col("id")
    each = F.explode(F.sequence(F.lit(0), F.lit(PRICES_PER_PART - 1)))
    ids = parts.select("p_partkey", each.alias("j")).select(
        ((F.col("p_partkey") * PRICES_PER_PART + F.col("j")) % N_PRICES).alias("id")).distinct()
    b, v, s = i % 4, F.floor(i / 4) % 5, F.floor(i / 20) % 12
    r, w = F.floor(i / 240) % 2, F.floor(i / 480)
    return ids.select(
        F.date_add(F.lit(DAY0).cast("date"), (7 * w).cast("int")).alias("effective_date"),
        _case(r, COST_REGIONS).alias("region"),
        F.concat(F.lit("S"), (s + 1).cast("string")).alias("supplier_id"),
        F.concat(F.lit("variety "), v.cast("string")).alias("variety"),
        _case(b, DM_BANDS).alias("dm_band"),
        (180 + (31 * w + 17 * r + 13 * s + 7 * v + 29 * b) % 180).cast("double").alias("price_usd_per_ton"),
        F.concat(F.lit("C"), w.cast("string"), F.lit("-"), (s + 1).cast("string")).alias("contract_id"),
    )


def line_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One machine per part row."""
    return line_equipment_from(read_table(spark, sf_dir, "part"))


def line_equipment_from(p: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    plant_id = (pk % 4 + 1).cast("int")
    return p.select(
        plant_id.alias("plant_id"),
        plant_name_of(plant_id).alias("plant_name"),
        F.concat(F.lit("L"), (pk % n_lines_of(plant_id) + 1).cast("string")).alias("plant_line"),
        F.concat(F.lit("EQ-"), (pk % 50).cast("string")).alias("equipment_id"),
        _case(pk % 5, EQUIPMENT_TYPES).alias("equipment_type"),
        F.col("p_name").alias("equipment_description"),
        (F.lit(4.5) + F.col("p_size") / 10.0).alias("equipment_rated_throughput_tph"),
        F.when(pk % 83 == 0, F.lit(None).cast("date")).when(pk % 89 == 0, F.lit("1950-01-01").cast("date"))
        .otherwise(F.date_add(F.lit("2015-01-01").cast("date"), ((pk * 37) % 3650).cast("int"))).alias("commission_date"),
    )


def revenue_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by_line_from(read_table(spark, sf_dir, "orders"))


def revenue_by_line_from(o: DataFrame) -> DataFrame:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    plant_id = (ck % 4 + 1).cast("int")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select(
        _day(ok).alias("date"),
        plant_id.alias("plant_id"),
        plant_name_of(plant_id).alias("plant_name"),
        F.concat(F.lit("L"), (ok % n_lines_of(plant_id) + 1).cast("string")).alias("plant_line"),
        (ok % N_PRODUCTS + 100).cast("string").alias("product_id"),
        _product_name(ok % N_PRODUCTS).alias("product_name"),
        F.when(ok % 499 == 0, F.lit(0.0)).otherwise((12000 + ck % 36000).cast("double"))
        .alias("units_packed_kg"),
        F.col("o_totalprice").alias("net_sales_usd"),
        F.when(urgent, F.lit("PrivateLabel")).otherwise(F.lit(" retail ")).alias("channel"),
        F.when(ok % 503 == 0, F.lit(None).cast("string")).otherwise(_case(ok % 3, TIERS)).alias("tier"),
    )


def product_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_demand_from(read_table(spark, sf_dir, "orders"))


def product_demand_from(o: DataFrame) -> DataFrame:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select(
        _day(ok).alias("date"),
        _case(ck % 2, COST_REGIONS).alias("region"),
        F.when(urgent, F.lit("PrivateLabel")).otherwise(F.lit(" retail ")).alias("channel"),
        (ok % N_PRODUCTS + 100).cast("string").alias("product_id"),
        _product_name(ok % N_PRODUCTS).alias("product_name"),
        (F.col("o_totalprice") / 10).alias("orders_kg"),
        (F.col("o_totalprice") / 10 + (ck % 100)).alias("forecast_kg"),
        (ok % 10 == 0).alias("promo_flag"),
    )


class RawTables(Mapping):
    """The eight raw stand-ins, each built on first access.

    Building a stand-in opens its source table (file listing and footer
    read); a query that needs two raw tables should not pay for all five
    sources, and two stand-ins over the same source share one read."""

    BUILDERS = {
        "raw_product_specifications": lambda spark, read: product_specs_from(read("part")),
        "raw_line_equipment": lambda spark, read: line_equipment_from(read("part")),
        "raw_potato_load_quality": lambda spark, read: load_quality_from(read("lineitem")),
        "raw_oee_events": lambda spark, read: oee_events_from(read("events")),
        "raw_line_quality_events": lambda spark, read: line_quality_events_from(read("events")),
        "raw_variety_costs": lambda spark, read: variety_costs_from(read("part")),
        "raw_revenue_by_line": lambda spark, read: revenue_by_line_from(read("orders")),
        "raw_product_demand": lambda spark, read: product_demand_from(read("orders")),
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._sources: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = read_table(self.spark, self.sf_dir, name)
        return self._sources[name]

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._built:
            self._built[key] = self.BUILDERS[key](self.spark, self._read)
        return self._built[key]

    def __iter__(self):
        return iter(self.BUILDERS)

    def __len__(self) -> int:
        return len(self.BUILDERS)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """All eight raw stand-ins, keyed like the reference's raw tables (lazy)."""
    return RawTables(spark, sf_dir)
