"""DuckDB text of the raw stand-ins (same projections as
plantlens.sources.standins), used only by the oracle checks."""

PLANT_NAME = ("CASE {c} WHEN 1 THEN 'NA-P1' WHEN 2 THEN 'NA-P2' WHEN 3 THEN 'EU-P3' "
              "WHEN 4 THEN 'EU-P4' END")
N_LINES = "CASE {c} WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 5 WHEN 4 THEN 4 END"
DAY = "(DATE '2024-01-01' + CAST(({k}) % 45 AS INTEGER))"


def _pn(c):
    return PLANT_NAME.format(c=c)


def _nl(c):
    return N_LINES.format(c=c)


RAW_CTES = {
    "raw_product_specifications": f"""
SELECT plant_id, {_pn('plant_id')} AS plant_name,
  'L' || CAST(li - (CASE plant_id WHEN 1 THEN 0 WHEN 2 THEN 4 WHEN 3 THEN 7 ELSE 12 END) + 1 AS VARCHAR) AS plant_line,
  CAST(k + 100 AS BIGINT) AS product_id, 'PRD-' || CAST(k AS VARCHAR) AS product_name,
  CAST(60 + 5 * k AS INTEGER) AS average_length_grading_mm_min,
  CAST(70 + 5 * k AS INTEGER) AS average_length_grading_mm_target,
  CAST(80 + 5 * k AS INTEGER) AS average_length_grading_mm_max,
  CAST(0.7 AS DOUBLE) AS pct_min_50mm_length, CAST(0.3 AS DOUBLE) AS pct_min_75mm_length,
  CAST(4.0 AS DOUBLE) AS max_usda_color_0_pct, CAST(3.0 AS DOUBLE) AS max_usda_color_1_pct,
  CAST(2.0 AS DOUBLE) AS max_usda_color_2_pct, CAST(1.0 AS DOUBLE) AS max_usda_color_3_pct,
  CAST(0.0 AS DOUBLE) AS max_usda_color_4_pct,
  CAST(2500 AS INTEGER) AS max_defect_points,
  CAST(21.505 AS DOUBLE) + CAST(0.4 AS DOUBLE) * k AS min_dry_matter_pct,
  CAST(22.105 AS DOUBLE) + CAST(0.4 AS DOUBLE) * k AS max_dry_matter_pct,
  ['variety 0', 'variety ' || CAST(k AS VARCHAR)] AS approved_potato_varieties
FROM (
  SELECT li, k, CASE WHEN li < 4 THEN 1 WHEN li < 7 THEN 2 WHEN li < 12 THEN 3 ELSE 4 END AS plant_id
  FROM (SELECT DISTINCT p_partkey % 16 AS li, (p_partkey // 16) % 3 AS k FROM part)
  WHERE NOT (li >= 12 AND k = 2)
)""",
    "raw_line_quality_events": f"""
SELECT ts AS datetime, pid AS plant_id, {_pn('pid')} AS plant_name,
  CASE WHEN event_id % 509 <> 0 THEN CAST(event_id % 3 + 100 AS VARCHAR) END AS product_id,
  CASE WHEN event_id % 521 <> 0 THEN 'PRD-' || CAST(event_id % 3 AS VARCHAR) END AS product_name,
  CASE WHEN event_id % 503 = 0 THEN NULL ELSE 'variety ' || CAST(event_id % 5 AS VARCHAR) END AS variety,
  CAST(60 + event_id % 30 AS INTEGER) AS avg_length_mm,
  CASE WHEN event_id % 97 = 0 THEN 0 ELSE event_id % 5 END AS usda_color_0,
  CASE WHEN event_id % 97 = 0 THEN 0 ELSE event_id % 7 END AS usda_color_1,
  CASE WHEN event_id % 97 = 0 THEN 0 ELSE event_id % 11 END AS usda_color_2,
  CASE WHEN event_id % 97 = 0 THEN 0 ELSE event_id % 13 END AS usda_color_3,
  CASE WHEN event_id % 97 = 0 THEN 0 ELSE event_id % 3 END AS usda_color_4,
  CAST(1200 + event_id % 2400 AS BIGINT) AS total_defect_points,
  CAST(20.0 AS DOUBLE) + CAST(CAST(round(value * 100) AS BIGINT) % 450 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS dry_solids_pct
FROM (SELECT *, CAST(user_id % 4 + 1 AS INTEGER) AS pid FROM events
      WHERE event_type IN ('view', 'click', 'signup'))""",
    "raw_oee_events": f"""
SELECT ts AS datetime, pid AS plant_id, {_pn('pid')} AS plant_name,
  'L' || CAST(event_id % ({_nl('pid')}) + 1 AS VARCHAR) AS plant_line,
  CASE WHEN event_type = 'error' THEN ' Maintenance ' ELSE 'Run' END AS downtime_cat_1,
  CASE WHEN event_type = 'error' THEN (CASE event_id % 3 WHEN 0 THEN 'Cutter ' WHEN 1 THEN 'FRYER' ELSE 'conveyor' END) END AS downtime_cat_2,
  'PRD-' || CAST(event_id % 3 AS VARCHAR) AS product_name,
  ts AS start_time,
  CASE WHEN event_id % 20 < 3 THEN strftime(ts + to_seconds(duration), '%m/%d/%Y %H:%M:%S')
       WHEN event_id % 20 = 3 THEN strftime(ts + to_seconds(duration), '%Y-%m-%d %H:%M')
       ELSE strftime(ts + to_seconds(duration), '%Y-%m-%d %H:%M:%S') END AS end_time,
  duration,
  CAST((duration * (user_id % 4)) // 10 AS BIGINT) AS downtime_duration,
  value * 100 AS qty_packed,
  CASE WHEN event_id % 499 = 0 THEN NULL ELSE CAST(event_id % 9 AS DOUBLE) END AS num_totes_on
FROM (SELECT * REPLACE (ts + to_days(CAST((event_id % 3) * 20 AS INTEGER)) AS ts), CAST(user_id % 4 + 1 AS INTEGER) AS pid,
             CAST(600 + (event_id * 7919) % 17400 AS BIGINT) AS duration
      FROM events WHERE event_type IN ('purchase', 'error'))""",
    "raw_potato_load_quality": f"""
SELECT pid AS plant_id, pname AS plant_name,
  CASE WHEN l_orderkey % 331 = 0 THEN NULL ELSE 'variety ' || CAST(l_partkey % 5 AS VARCHAR) END AS VarietyLabel,
  CASE WHEN l_orderkey % 401 = 0 THEN concat_ws('-', pname, 'bad', CAST(l_linenumber AS VARCHAR))
       ELSE concat_ws('-', pname, strftime({DAY.format(k='l_orderkey')}, '%Y%m%d'), CAST(l_linenumber AS VARCHAR),
                      'S' || CAST(l_suppkey % 12 + 1 AS VARCHAR)) END AS load_number,
  CAST(trunc(12000 + l_quantity * 320) AS INTEGER) AS effective_actual_weight,
  CAST(60 + l_partkey % 30 AS INTEGER) AS average_length_grading_mm,
  CAST(40 + l_orderkey % 20 AS DOUBLE) AS usda_color_0_pct,
  CAST(20 + l_partkey % 15 AS DOUBLE) AS usda_color_1_pct,
  CAST(10 + l_suppkey % 10 AS DOUBLE) AS usda_color_2_pct,
  CAST(l_linenumber % 5 AS DOUBLE) AS usda_color_3_pct,
  CAST(l_orderkey % 3 AS DOUBLE) AS usda_color_4_pct,
  CAST(1000 + l_partkey % 2000 AS INTEGER) AS total_defect_points,
  CASE WHEN l_orderkey % 409 <> 0 THEN CAST(20.0 AS DOUBLE) + l_discount * 45 END AS dry_matter_pct
FROM (SELECT *, CAST(l_suppkey % 4 + 1 AS INTEGER) AS pid, {_pn('CAST(l_suppkey % 4 + 1 AS INTEGER)')} AS pname
      FROM lineitem)""",
    "raw_variety_costs": """
SELECT DATE '2024-01-01' + CAST(7 * w AS INTEGER) AS effective_date,
  CASE r WHEN 0 THEN ' na ' ELSE 'eu' END AS region,
  'S' || CAST(s + 1 AS VARCHAR) AS supplier_id,
  'variety ' || CAST(v AS VARCHAR) AS variety,
  CASE b WHEN 0 THEN '<=21%' WHEN 1 THEN '21-22%' WHEN 2 THEN '22-23%' ELSE '>=23%' END AS dm_band,
  CAST(180 + (31 * w + 17 * r + 13 * s + 7 * v + 29 * b) % 180 AS DOUBLE) AS price_usd_per_ton,
  'C' || CAST(w AS VARCHAR) || '-' || CAST(s + 1 AS VARCHAR) AS contract_id
FROM (SELECT id % 4 AS b, (id // 4) % 5 AS v, (id // 20) % 12 AS s, (id // 240) % 2 AS r, id // 480 AS w
      FROM (SELECT DISTINCT (p_partkey * 17 + j) % 3360 AS id FROM part, (SELECT unnest(range(17)) AS j)))""",
    "raw_line_equipment": f"""
SELECT pid AS plant_id, {_pn('pid')} AS plant_name,
  'L' || CAST(p_partkey % ({_nl('pid')}) + 1 AS VARCHAR) AS plant_line,
  'EQ-' || CAST(p_partkey % 50 AS VARCHAR) AS equipment_id,
  CASE p_partkey % 5 WHEN 0 THEN 'cutter' WHEN 1 THEN 'Fryer' WHEN 2 THEN 'peeler' WHEN 3 THEN 'blancher' ELSE 'packer' END AS equipment_type,
  p_name AS equipment_description,
  CAST(4.5 AS DOUBLE) + p_size / CAST(10.0 AS DOUBLE) AS equipment_rated_throughput_tph,
  CASE WHEN p_partkey % 83 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN DATE '1950-01-01'
       ELSE DATE '2015-01-01' + CAST((p_partkey * 37) % 3650 AS INTEGER) END AS commission_date
FROM (SELECT *, CAST(p_partkey % 4 + 1 AS INTEGER) AS pid FROM part)""",
    "raw_revenue_by_line": f"""
SELECT {DAY.format(k='o_orderkey')} AS date, pid AS plant_id, {_pn('pid')} AS plant_name,
  'L' || CAST(o_orderkey % ({_nl('pid')}) + 1 AS VARCHAR) AS plant_line,
  CAST(o_orderkey % 3 + 100 AS VARCHAR) AS product_id, 'PRD-' || CAST(o_orderkey % 3 AS VARCHAR) AS product_name,
  CASE WHEN o_orderkey % 499 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(12000 + o_custkey % 36000 AS DOUBLE) END AS units_packed_kg,
  o_totalprice AS net_sales_usd,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PrivateLabel' ELSE ' retail ' END AS channel,
  CASE WHEN o_orderkey % 503 = 0 THEN NULL ELSE (CASE o_orderkey % 3 WHEN 0 THEN 'gold' WHEN 1 THEN 'silver' ELSE 'bronze' END) END AS tier
FROM (SELECT *, CAST(o_custkey % 4 + 1 AS INTEGER) AS pid FROM orders)""",
    "raw_product_demand": f"""
SELECT {DAY.format(k='o_orderkey')} AS date,
  CASE o_custkey % 2 WHEN 0 THEN ' na ' ELSE 'eu' END AS region,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PrivateLabel' ELSE ' retail ' END AS channel,
  CAST(o_orderkey % 3 + 100 AS VARCHAR) AS product_id, 'PRD-' || CAST(o_orderkey % 3 AS VARCHAR) AS product_name,
  o_totalprice / 10 AS orders_kg,
  o_totalprice / 10 + (o_custkey % 100) AS forecast_kg,
  o_orderkey % 10 = 0 AS promo_flag
FROM orders""",
}
