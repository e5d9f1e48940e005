"""Silver layer (G1-G9): typed, cleaned raw tables.

Each builder is a single narrow projection of one raw table (no shuffle), so
Catalyst fuses it into whatever reads it and prunes unused columns down to
the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.functions import columns as C
from plantlens.functions.timestamps import try_timestamp


def product_specs(raw: DataFrame) -> DataFrame:
    """G1: specs with product id as text and percent caps as doubles."""
    return raw.select(
        "plant_id",
        C.unknown("plant_name").alias("plant_name"),
        C.unknown("plant_line").alias("plant_line"),
        F.col("product_id").cast("string").alias("product_id"),
        C.unknown("product_name").alias("product_name"),
        "average_length_grading_mm_min", "average_length_grading_mm_target",
        "average_length_grading_mm_max", "pct_min_50mm_length", "pct_min_75mm_length",
        *[F.col(f"max_usda_color_{i}_pct").cast("double").alias(f"max_usda_color_{i}_pct")
          for i in range(5)],
        "max_defect_points",
        F.col("min_dry_matter_pct").cast("double").alias("min_dry_matter_pct"),
        F.col("max_dry_matter_pct").cast("double").alias("max_dry_matter_pct"),
        "approved_potato_varieties",
    )


def variety_costs(raw: DataFrame) -> DataFrame:
    """Price list with trimmed/upper region and capitalised variety."""
    return raw.select(
        "effective_date",
        F.upper(F.trim("region")).alias("region"),
        "supplier_id",
        C.initcap_trim("variety").alias("variety"),
        F.trim("dm_band").alias("dm_band"),
        F.col("price_usd_per_ton").cast("double").alias("price_usd_per_ton"),
        "contract_id",
    )


def revenue_by_line(raw: DataFrame) -> DataFrame:
    """Revenue with region and guarded price per kg; keeps both *_raw columns."""
    pid_raw, pname_raw = C.mutual_fallback("product_id", "product_name")
    return raw.select(
        "date", "plant_id",
        C.unknown("plant_name").alias("plant_name"),
        C.unknown("plant_line").alias("plant_line"),
        pid_raw.alias("product_id_raw"),
        pname_raw.alias("product_name_raw"),
        F.col("units_packed_kg").cast("double").alias("units_packed_kg"),
        F.col("net_sales_usd").cast("double").alias("net_sales_usd"),
        C.initcap_trim("channel").alias("channel"),
        C.initcap_trim("tier").alias("tier"),
        C.region_of("plant_name").alias("region"),
        C.safe_ratio("net_sales_usd", "units_packed_kg").alias("price_per_kg"),
        pid_raw.alias("product_id"),
        pname_raw.alias("product_name"),
    )


def product_demand(raw: DataFrame) -> DataFrame:
    """Demand signals."""
    pid_raw, pname_raw = C.mutual_fallback("product_id", "product_name")
    return raw.select(
        "date",
        F.upper(F.trim("region")).alias("region"),
        C.initcap_trim("channel").alias("channel"),
        pid_raw.alias("product_id_raw"),
        pname_raw.alias("product_name_raw"),
        F.col("orders_kg").cast("double").alias("orders_kg"),
        F.col("forecast_kg").cast("double").alias("forecast_kg"),
        F.col("promo_flag").cast("boolean").alias("promo_flag"),
        pid_raw.alias("product_id"),
        pname_raw.alias("product_name"),
    )


def load_quality(raw: DataFrame) -> DataFrame:
    """Loads with region, variety, arrival date, tons, colour shares and band."""
    return raw.select(
        "plant_id",
        C.unknown("plant_name").alias("plant_name"),
        C.region_of("plant_name").alias("region"),
        C.initcap_trim(C.unknown("VarietyLabel")).alias("variety"),
        "load_number",
        C.load_arrival_date("load_number").alias("arrival_date"),
        (F.col("effective_actual_weight").cast("double") / 1000.0).alias("tons"),
        "average_length_grading_mm",
        *[(F.coalesce(F.col(f"usda_color_{i}_pct"), F.lit(0.0)) / 100.0).alias(f"usda_color_{i}_share")
          for i in range(5)],
        "total_defect_points",
        F.col("dry_matter_pct").cast("double").alias("dry_matter_pct"),
        C.dm_band("dry_matter_pct").alias("dm_band"),
    )


def line_quality_events(raw: DataFrame) -> DataFrame:
    """Hourly readings with date/hour/week helpers and colour shares."""
    counts = [F.col(f"usda_color_{i}") for i in range(5)]
    total = C.nonzero_or_one(counts[0] + counts[1] + counts[2] + counts[3] + counts[4])
    pid_raw, pname_raw = C.mutual_fallback("product_id", "product_name")
    return raw.select(
        "datetime",
        F.to_date("datetime").alias("date"),
        F.hour("datetime").alias("hour"),
        C.week_start("datetime").alias("week_start"),
        "plant_id",
        C.unknown("plant_name").alias("plant_name"),
        pid_raw.alias("product_id"),
        pname_raw.alias("product_name"),
        C.initcap_trim(C.unknown("variety")).alias("variety"),
        "avg_length_mm",
        *[f"usda_color_{i}" for i in range(5)],
        "total_defect_points",
        F.col("dry_solids_pct").cast("double").alias("dry_solids_pct"),
        *[(counts[i] / total).alias(f"fry_color_{i}_share") for i in range(5)],
    )


def oee_events(raw: DataFrame, end_time_formats: list[str] | None = None) -> DataFrame:
    """Run segments with minutes and parsed end time.

    ``end_time_formats`` (H9) adds formats tried after the plain cast; the
    default keeps the reference behaviour where US dates become NULL.
    """
    return raw.select(
        "datetime",
        F.to_date("datetime").alias("date"),
        C.week_start("datetime").alias("week_start"),
        "plant_id",
        C.unknown("plant_name").alias("plant_name"),
        C.unknown("plant_line").alias("plant_line"),
        F.trim(F.lower(C.unknown("downtime_cat_1", "unknown"))).alias("downtime_cat_1"),
        F.trim(F.lower(C.unknown("downtime_cat_2", "unknown"))).alias("downtime_cat_2"),
        C.unknown("product_name").alias("product_name"),
        "start_time",
        try_timestamp(F.col("end_time"), end_time_formats).alias("end_time_ts"),
        (F.col("duration").cast("double") / 60.0).alias("duration_min"),
        (F.col("downtime_duration").cast("double") / 60.0).alias("downtime_min"),
        "qty_packed", "num_totes_on",
    )


def line_equipment(raw: DataFrame, as_of: str | _dt.date) -> DataFrame:
    """Equipment with age and depreciated throughput as of a fixed date."""
    age = C.age_years("commission_date", F.lit(str(as_of)).cast("date"))
    return raw.select(
        "plant_id",
        C.unknown("plant_name").alias("plant_name"),
        C.unknown("plant_line").alias("plant_line"),
        "equipment_id",
        F.trim(F.lower(C.unknown("equipment_type", "unknown"))).alias("equipment_type"),
        "equipment_description", "equipment_rated_throughput_tph", "commission_date",
        age.alias("equipment_age_years"),
        C.depreciated_throughput("equipment_rated_throughput_tph", age).alias("effective_rated_throughput_tph"),
    )


def numbered_copies(df: DataFrame) -> DataFrame:
    """``df`` with ``copy``: 1, 2, ... among rows that are equal in all columns.
    Equal rows are counted by a partial aggregate and unfolded again, so a row
    that a third of the table repeats is one row a task in the shuffle."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")


def copy_key(key: Column) -> Column:
    """A row's key with the number of its copy from the second on."""
    return F.concat(key, F.when(F.col("copy") > 1, F.concat(F.lit("|"), F.col("copy").cast("string"))).otherwise(F.lit("")))


def downtime_events(raw: DataFrame, distinct_rows: bool = False) -> DataFrame:
    """Display table of downtime events.

    The id is a hash of the row's natural key, missing parts as '-', rather than
    a layout-dependent monotonically increasing id (H5), so a re-run or a retried
    task gives the same id.  Equal raw rows are numbered, so ids are unique; a
    caller who states that there are none (``distinct_rows``) saves that shuffle.
    """
    used = raw.select("plant_name", "plant_line", "datetime", "duration", "downtime_duration", "downtime_cat_1", "downtime_cat_2",
                      "product_name", "end_time")
    rows = used.withColumn("copy", F.lit(1).cast("long")) if distinct_rows else numbered_copies(used)
    key = F.concat_ws("|", C.unknown("plant_name", "-"), C.unknown("plant_line", "-"),
                      F.coalesce(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("-")),
                      F.coalesce(F.col("duration").cast("string"), F.lit("-")), F.coalesce(F.col("downtime_duration").cast("string"), F.lit("-")),
                      C.unknown("downtime_cat_1", "-"), C.unknown("downtime_cat_2", "-"), C.unknown("product_name", "-"),
                      C.unknown("end_time", "-"))
    return rows.select(
        F.concat(F.lit("EVT-"), F.md5(copy_key(key))).alias("event_id"),
        "plant_name", "plant_line",
        F.col("datetime").cast("timestamp").alias("event_time"),
        (F.col("duration").cast("double") / 60.0).alias("duration_min"),
        (F.col("downtime_duration").cast("double") / 60.0).alias("downtime_min"),
        F.trim(F.lower(C.unknown("downtime_cat_2", "unknown"))).alias("component"),
        F.trim(F.lower(C.unknown("downtime_cat_1", "unknown"))).alias("code"),
        F.lit(None).cast("string").alias("notes"),
    )
