"""Declared schemas of the eight raw tables.

Timestamps arrive either as ISO-8601 text (default sink mode) or as real
timestamps; both are accepted on read and normalised in the silver layer.
"""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


PRODUCT_SPECS = T.StructType([
    _f("plant_id", _I), _f("plant_name", _S), _f("plant_line", _S),
    _f("product_id", _L), _f("product_name", _S),
    _f("average_length_grading_mm_min", _I), _f("average_length_grading_mm_target", _I),
    _f("average_length_grading_mm_max", _I),
    _f("pct_min_50mm_length", _D), _f("pct_min_75mm_length", _D),
    *[_f(f"max_usda_color_{i}_pct", _D) for i in range(5)],
    _f("max_defect_points", _I), _f("min_dry_matter_pct", _D), _f("max_dry_matter_pct", _D),
    _f("approved_potato_varieties", T.ArrayType(_S)),
])

LINE_EQUIPMENT = T.StructType([
    _f("plant_id", _I), _f("plant_name", _S), _f("plant_line", _S),
    _f("equipment_id", _S), _f("equipment_type", _S), _f("equipment_description", _S),
    _f("equipment_rated_throughput_tph", _D), _f("commission_date", T.DateType()),
])

LOAD_QUALITY = T.StructType([
    _f("plant_id", _I), _f("plant_name", _S), _f("VarietyLabel", _S), _f("load_number", _S),
    _f("effective_actual_weight", _I), _f("average_length_grading_mm", _I),
    *[_f(f"usda_color_{i}_pct", _D) for i in range(5)],
    _f("total_defect_points", _I), _f("dry_matter_pct", _D),
])

OEE_EVENTS = T.StructType([
    _f("datetime", T.TimestampType()), _f("plant_id", _I), _f("plant_name", _S),
    _f("plant_line", _S), _f("downtime_cat_1", _S), _f("downtime_cat_2", _S),
    _f("product_name", _S), _f("start_time", T.TimestampType()), _f("end_time", _S),
    _f("duration", _L), _f("downtime_duration", _L), _f("qty_packed", _D),
    _f("num_totes_on", _D),
])

LINE_QUALITY_EVENTS = T.StructType([
    _f("datetime", T.TimestampType()), _f("plant_id", _I), _f("plant_name", _S),
    _f("product_id", _S), _f("product_name", _S), _f("variety", _S), _f("avg_length_mm", _I),
    *[_f(f"usda_color_{i}", _L) for i in range(5)],
    _f("total_defect_points", _L), _f("dry_solids_pct", _D),
])

VARIETY_COSTS = T.StructType([
    _f("effective_date", T.DateType()), _f("region", _S), _f("supplier_id", _S),
    _f("variety", _S), _f("dm_band", _S), _f("price_usd_per_ton", _D), _f("contract_id", _S),
])

REVENUE_BY_LINE = T.StructType([
    _f("date", T.DateType()), _f("plant_id", _I), _f("plant_name", _S), _f("plant_line", _S),
    _f("product_id", _S), _f("product_name", _S), _f("units_packed_kg", _D),
    _f("net_sales_usd", _D), _f("channel", _S), _f("tier", _S),
])

PRODUCT_DEMAND = T.StructType([
    _f("date", T.DateType()), _f("region", _S), _f("channel", _S), _f("product_id", _S),
    _f("product_name", _S), _f("orders_kg", _D), _f("forecast_kg", _D),
    _f("promo_flag", T.BooleanType()),
])

RAW_SCHEMAS = {
    "raw_product_specifications": PRODUCT_SPECS,
    "raw_line_equipment": LINE_EQUIPMENT,
    "raw_potato_load_quality": LOAD_QUALITY,
    "raw_oee_events": OEE_EVENTS,
    "raw_line_quality_events": LINE_QUALITY_EVENTS,
    "raw_variety_costs": VARIETY_COSTS,
    "raw_revenue_by_line": REVENUE_BY_LINE,
    "raw_product_demand": PRODUCT_DEMAND,
}

# Columns whose raw form may be ISO text instead of a timestamp.
TIMESTAMP_COLUMNS = {
    "raw_oee_events": ("datetime", "start_time"),
    "raw_line_quality_events": ("datetime",),
}
