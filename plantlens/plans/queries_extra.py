"""Registered queries for the jobs outside the SQL (X, D ids)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlens.plans import scenario, signals, transcripts
from plantlens.plans.layers import from_test_tables
from plantlens.plans.registry import MONEY, RATIO, register
from plantlens.sources.readers import read_table

EW = signals.EventWindow()
LOAD_ID = r"'^(.+)-([0-9]{8})-([0-9]+)-(S[0-9]+)$'"


def _win(ts: str) -> str:
    return (f"({ts} >= TIMESTAMP '{EW.start}' AND {ts} < CAST(DATE '{EW.end}' + 1 AS TIMESTAMP))")


# ---- X1 / X2 ----------------------------------------------------------------

X1_SQL = f"""
SELECT 'over_quality_dm' AS signal, AVG(CASE WHEN m THEN dry_solids_pct END) AS mean_a,
       CAST(NULL AS DOUBLE) AS mean_b, CAST(count_if(m) AS BIGINT) AS n
FROM (SELECT *, {_win('datetime')} AND plant_name = '{EW.over_plant}' AND product_name = '{EW.over_product}' AS m
      FROM silver_line_quality_events)
UNION ALL
SELECT 'under_quality_dm_defects', AVG(CASE WHEN m THEN dry_solids_pct END),
       AVG(CASE WHEN m THEN CAST(total_defect_points AS DOUBLE) END), CAST(count_if(m) AS BIGINT)
FROM (SELECT *, {_win('datetime')} AND plant_name = '{EW.under_plant}' AND product_name = '{EW.under_product}' AS m
      FROM silver_line_quality_events)
UNION ALL
SELECT 'supplier_dm_after_tranche', AVG(CASE WHEN m THEN dry_matter_pct END), CAST(NULL AS DOUBLE),
       CAST(count_if(m) AS BIGINT)
FROM (SELECT *, COALESCE(plant_name = '{EW.supplier_plant}'
        AND regexp_matches(load_number, {LOAD_ID})
        AND regexp_extract(load_number, {LOAD_ID}, 4) = '{EW.supplier}'
        AND CAST(try_strptime(regexp_extract(load_number, {LOAD_ID}, 2), '%Y%m%d') AS DATE) >= DATE '{EW.tranche_start}', FALSE) AS m
      FROM silver_potato_load_quality)
UNION ALL
SELECT 'downtime_events_in_window', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(count_if(m) AS BIGINT)
FROM (SELECT *, {_win('datetime')} AND plant_name = '{EW.oee_plant}' AND plant_line = '{EW.oee_line}'
        AND downtime_cat_1 <> 'run' AS m FROM silver_oee_events)
"""


@register("x1_story_signals", oracle=X1_SQL, digits={"mean_a": RATIO, "mean_b": RATIO})
def x1(spark, sf_dir):
    """The four event-window QA signals, one row each."""
    p = from_test_tables(spark, sf_dir)
    return signals.story_signals(p.events(), p.loads(), p.oee(), EW)


X2_SQL = f"""
SELECT id_plant, id_supplier, COUNT(*) AS n_loads, MIN(id_date) AS first_date, MAX(id_date) AS last_date,
       CAST(MAX(id_seq_int) AS DOUBLE) AS max_seq
FROM (SELECT CASE WHEN ok THEN regexp_extract(load_number, {LOAD_ID}, 1) END AS id_plant,
             CASE WHEN ok THEN regexp_extract(load_number, {LOAD_ID}, 4) END AS id_supplier,
             CASE WHEN ok THEN CAST(try_strptime(regexp_extract(load_number, {LOAD_ID}, 2), '%Y%m%d') AS DATE) END AS id_date,
             CASE WHEN ok THEN TRY_CAST(regexp_extract(load_number, {LOAD_ID}, 3) AS INTEGER) END AS id_seq_int
      FROM (SELECT *, regexp_matches(load_number, {LOAD_ID}) AS ok FROM silver_potato_load_quality))
GROUP BY id_plant, id_supplier
"""


@register("x2_load_id_parse", oracle=X2_SQL, digits={"max_seq": RATIO})
def x2(spark, sf_dir):
    """Plant, date, sequence and supplier parsed from every load id.
    (The sequence is NULL for malformed ids; shown as a double so every
    client reads that NULL alike.)"""
    df = signals.load_id_summary(from_test_tables(spark, sf_dir).loads())
    return df.withColumn("max_seq", F.col("max_seq").cast("double"))


# ---- D1-D7 --------------------------------------------------------------------

D1_SQL = """
SELECT date, plant_name, plant_line, product_name, AVG(dev) AS avg_deviation_pp, MAX(dev) AS max_over_pp,
       MIN(dev) AS max_under_pp, CAST(count_if(dev <> 0) AS BIGINT) AS n_outside
FROM (SELECT *, greatest(dry_solids_pct - (max_dry_matter_pct + CAST(0.3 AS DOUBLE)), CAST(0.0 AS DOUBLE))
              - greatest((min_dry_matter_pct - CAST(0.3 AS DOUBLE)) - dry_solids_pct, CAST(0.0 AS DOUBLE)) AS dev
      FROM gold_line_hourly_quality)
GROUP BY date, plant_name, plant_line, product_name
"""


@register("d1_deviation", oracle=D1_SQL,
          digits={"avg_deviation_pp": RATIO, "max_over_pp": RATIO, "max_under_pp": RATIO})
def d1(spark, sf_dir):
    """Signed deviation beyond tolerance, per day and line/product."""
    return signals.daily_deviation(from_test_tables(spark, sf_dir).hourly())


EPISODES_SQL = """
SELECT plant_name, plant_line, product_name, kind, MIN(datetime) AS episode_start, MAX(datetime) AS episode_end,
       COUNT(*) AS n_readings
FROM (SELECT *, SUM(new) OVER (PARTITION BY plant_name, plant_line, product_name, kind ORDER BY datetime
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep
      FROM (SELECT *, CASE WHEN LAG(datetime) OVER w IS NULL OR datetime >= LAG(datetime) OVER w + INTERVAL 120 MINUTE
                      THEN 1 ELSE 0 END AS new
            FROM (SELECT plant_name, plant_line, product_name, datetime,
                         CASE WHEN under_quality_flag THEN 'under' WHEN over_quality_flag THEN 'over' END AS kind
                  FROM gold_line_hourly_quality) f
            WHERE kind IS NOT NULL
            WINDOW w AS (PARTITION BY plant_name, plant_line, product_name, kind ORDER BY datetime)))
GROUP BY plant_name, plant_line, product_name, kind, ep
"""


@register("d2_breach_episodes", oracle=EPISODES_SQL)
def d2(spark, sf_dir):
    """Persistent breach episodes (flagged readings less than 2 h apart)."""
    return signals.breach_episodes(from_test_tables(spark, sf_dir).hourly())


D2_MIX_SQL = f"""
SELECT plant_name, period, id_supplier, tons, avg_dry_matter_pct,
       tons / SUM(tons) OVER (PARTITION BY plant_name, period) AS tons_share
FROM (SELECT plant_name, CASE WHEN arrival_date < DATE '{EW.tranche_start}' THEN 'before' ELSE 'after' END AS period,
             CASE WHEN regexp_matches(load_number, {LOAD_ID}) THEN regexp_extract(load_number, {LOAD_ID}, 4) END AS id_supplier,
             SUM(tons) AS tons, AVG(dry_matter_pct) AS avg_dry_matter_pct
      FROM silver_potato_load_quality GROUP BY ALL)
"""


@register("d2_supplier_mix", oracle=D2_MIX_SQL,
          digits={"tons": MONEY, "avg_dry_matter_pct": RATIO, "tons_share": RATIO})
def d2_mix(spark, sf_dir):
    """Supplier share of each plant's tons before/after the tranche date."""
    return signals.supplier_mix(from_test_tables(spark, sf_dir).loads(), EW.tranche_start)


D3_SQL = f"""
SELECT plant_name, product_name, SUM(raw_potato_spend_usd) AS spend_usd,
       SUM(over_quality_waste_usd) AS over_quality_waste_usd,
       SUM(downgrade_rework_exposure_usd) AS downgrade_rework_exposure_usd, COUNT(*) AS n_days
FROM gold_cost_exposure WHERE date BETWEEN DATE '{EW.start}' AND DATE '{EW.end}'
GROUP BY plant_name, product_name
"""


@register("d3_window_costs", oracle=D3_SQL,
          digits={"spend_usd": MONEY, "over_quality_waste_usd": MONEY, "downgrade_rework_exposure_usd": MONEY})
def d3(spark, sf_dir):
    """D3: cost exposure inside the event window per plant and product."""
    return signals.window_costs(from_test_tables(spark, sf_dir).exposure(), EW.start, EW.end)


D4_PARTS_SQL = """
SELECT date, plant_name, plant_line,
  CAST(1.0 AS DOUBLE) - CASE WHEN run_min > 0 THEN downtime_min / run_min END AS availability,
  CASE WHEN run_min > 0 THEN qty_packed_kg / run_min END AS performance_kg_per_min,
  CAST(1.0 AS DOUBLE) - CASE WHEN readings > 0 THEN CAST(flagged AS DOUBLE) / readings END AS quality
FROM (SELECT date, plant_name, plant_line, SUM(downtime_min) AS downtime_min, SUM(duration_min) AS run_min,
             SUM(qty_packed) AS qty_packed_kg FROM silver_oee_events GROUP BY ALL) o
FULL JOIN (SELECT date, plant_name, plant_line, COUNT(*) AS readings,
                  count_if(under_quality_flag OR over_quality_flag) AS flagged
           FROM gold_line_hourly_quality GROUP BY ALL) q
USING (date, plant_name, plant_line)
"""


@register("d4_oee_parts", oracle=D4_PARTS_SQL,
          digits={"availability": RATIO, "performance_kg_per_min": RATIO, "quality": RATIO})
def d4(spark, sf_dir):
    """Daily availability, performance proxy and quality per line."""
    p = from_test_tables(spark, sf_dir)
    return signals.oee_parts(p.hourly(), p.oee())


D4_CORR_SQL = """
SELECT plant_name, downtime_cat_2, COUNT(*) AS n_days,
  CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END
    AS corr_downtime_flagged
FROM (SELECT q.plant_name, c.downtime_cat_2, COALESCE(d.downtime_min, 0.0) AS x, q.flagged_share AS y
      FROM (SELECT date, plant_name, count_if(under_quality_flag OR over_quality_flag) / COUNT(*) AS flagged_share
            FROM gold_line_hourly_quality GROUP BY ALL) q
      JOIN (SELECT DISTINCT plant_name, downtime_cat_2 FROM silver_oee_events WHERE downtime_cat_1 <> 'run') c
        ON q.plant_name = c.plant_name
      LEFT JOIN (SELECT date, plant_name, downtime_cat_2, SUM(downtime_min) AS downtime_min
                 FROM silver_oee_events WHERE downtime_cat_1 <> 'run' GROUP BY ALL) d
        ON d.date = q.date AND d.plant_name = q.plant_name AND d.downtime_cat_2 = c.downtime_cat_2)
GROUP BY plant_name, downtime_cat_2
"""


@register("d4_code_drift_corr", oracle=D4_CORR_SQL, digits={"corr_downtime_flagged": RATIO})
def d4_corr(spark, sf_dir):
    """Per plant and downtime code, correlation of daily downtime with the flagged share."""
    p = from_test_tables(spark, sf_dir)
    return signals.code_drift_correlation(p.hourly(), p.oee())


D5_SQL = """
SELECT plant_name, CAST(rank AS INTEGER) AS rank, recommendation_id, type, plant_line, expected_savings_usd
FROM (SELECT *, row_number() OVER (PARTITION BY plant_name ORDER BY expected_savings_usd DESC, recommendation_id) AS rank
      FROM gold_scenario_recommendations)
WHERE rank <= 3
"""


@register("d5_top_actions", oracle=D5_SQL, digits={"expected_savings_usd": MONEY})
def d5(spark, sf_dir):
    """Top-3 actions per plant by expected savings (the limit is the feature)."""
    return scenario.top_actions(from_test_tables(spark, sf_dir).scenarios(), 3)


D6_SQL = """
WITH g AS (
  SELECT arrival_date AS date, region, plant_name,
    SUM(CASE WHEN dry_matter_pct > 23.0 THEN kg END) AS high_kg,
    SUM(CASE WHEN dry_matter_pct > 23.0 THEN kg * dry_matter_pct END) AS high_dm_kg,
    SUM(CASE WHEN dry_matter_pct <= 21.0 THEN kg END) AS low_kg,
    SUM(kg) AS kg, SUM(kg * dry_matter_pct) AS dm_kg
  FROM (SELECT *, CAST(round(tons * 1000) AS BIGINT) AS kg FROM silver_potato_load_quality WHERE region IS NOT NULL)
  GROUP BY ALL),
d AS (SELECT date, region, plant_name AS donor_plant, high_dm_kg / high_kg AS donor_high_dm,
        SUM(high_kg) OVER w - high_kg AS s_lo, SUM(high_kg) OVER w AS s_hi FROM g WHERE high_kg > 0
      WINDOW w AS (PARTITION BY date, region ORDER BY plant_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r AS (SELECT date, region, plant_name AS receiver_plant, kg AS r_kg, dm_kg AS r_dm_kg,
        SUM(low_kg) OVER w - low_kg AS d_lo, SUM(low_kg) OVER w AS d_hi FROM g WHERE low_kg > 0
      WINDOW w AS (PARTITION BY date, region ORDER BY plant_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
p AS (SELECT *, least(s_hi, d_hi) - greatest(s_lo, d_lo) AS moved_kg
      FROM d JOIN r USING (date, region) WHERE s_lo < d_hi AND d_lo < s_hi)
SELECT date, region, donor_plant, receiver_plant, moved_kg / 1000.0 AS moved_tons, donor_high_dm,
  r_dm_kg / r_kg AS receiver_dm_before,
  (r_dm_kg + SUM(moved_kg * donor_high_dm) OVER rw) / (r_kg + SUM(moved_kg) OVER rw) AS receiver_dm_after
FROM p WINDOW rw AS (PARTITION BY date, region, receiver_plant)
"""


@register("d6_reallocation", oracle=D6_SQL,
          digits={"moved_tons": RATIO, "donor_high_dm": RATIO, "receiver_dm_before": RATIO,
                  "receiver_dm_after": RATIO})
def d6(spark, sf_dir):
    """Greedy in-region moves of high-dry-matter tons and the blend after."""
    return signals.reallocation(from_test_tables(spark, sf_dir).loads())


D7_SQL = """
SELECT plant_name, plant_line, equipment_id, equipment_type, commission_date, lost_tph, lost_value_usd,
  CAST(rank() OVER (PARTITION BY plant_name, plant_line ORDER BY lost_value_usd DESC, equipment_id, commission_date)
       AS INTEGER) AS rank,
  CASE WHEN lost_value_usd > 0 THEN CAST(100000.0 AS DOUBLE) / lost_value_usd END AS payback_years
FROM (SELECT *, lost_tph * CAST(10000.0 AS DOUBLE) AS lost_value_usd
      FROM (SELECT *, greatest(COALESCE(equipment_rated_throughput_tph - effective_rated_throughput_tph, CAST(0.0 AS DOUBLE)),
                               CAST(0.0 AS DOUBLE)) AS lost_tph FROM silver_line_equipment))
"""


@register("d7_upgrade_ranking", oracle=D7_SQL,
          digits={"lost_tph": RATIO, "lost_value_usd": MONEY, "payback_years": RATIO})
def d7(spark, sf_dir):
    """Machines of each line ranked by the value of lost throughput."""
    return scenario.upgrade_ranking(from_test_tables(spark, sf_dir).equipment())


# ---- X3-X10 -----------------------------------------------------------------

def _conversations(spark, sf_dir):
    return read_table(spark, sf_dir, "conversations")


X3_SQL = """
SELECT conv_id, turn, role, string_agg(content, '' ORDER BY seq) AS content, COUNT(*) AS n_chunks
FROM (SELECT conv_id, turn, role, seq, CASE WHEN seq > 0 THEN ' ' || word ELSE word END AS content
      FROM (SELECT conv_id, turn, role, unnest(string_split(text, ' ')) AS word,
                   CAST(generate_subscripts(string_split(text, ' '), 1) - 1 AS INTEGER) AS seq
            FROM conversations))
GROUP BY conv_id, turn, role
"""


@register("x3_message_fold", oracle=X3_SQL)
def x3(spark, sf_dir):
    """Streamed word chunks folded back into messages, in arrival order."""
    return transcripts.fold_message_chunks(transcripts.word_chunks(_conversations(spark, sf_dir)))


X3_TOOLS_SQL = """
SELECT conv_id, turn, call_id, MIN(seq) AS first_seq, 'function' AS type,
  COALESCE(arg_max(name, CASE WHEN name <> '' THEN seq END), arg_min(name, seq)) AS name,
  string_agg(arguments, '' ORDER BY seq) AS arguments, COUNT(*) AS n_chunks
FROM (SELECT conv_id, turn, 'call-' || CAST(conv_id % 7 AS VARCHAR) AS call_id, seq,
             CASE WHEN seq = 0 THEN 'lookup' WHEN seq = n - 1 THEN 'final' ELSE '' END AS name,
             CASE WHEN seq = n - 1 THEN line ELSE line || chr(10) END AS arguments
      FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
                   CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS seq,
                   len(string_split(text, chr(10))) AS n
            FROM conversations WHERE role = 'assistant'))
GROUP BY conv_id, turn, call_id
"""


@register("x3_tool_call_fold", oracle=X3_TOOLS_SQL)
def x3_tools(spark, sf_dir):
    """Tool-call chunks accumulated per message and call id (arguments
    appended, later non-empty name wins)."""
    return transcripts.fold_tool_call_chunks(transcripts.line_tool_chunks(_conversations(spark, sf_dir)))


X4_SQL = """
SELECT conv_id, turn, string_agg(content, '' ORDER BY seq) AS content,
  arg_max(request_id, CASE WHEN request_id IS NOT NULL THEN seq END) AS request_id, COUNT(*) AS n_deltas
FROM (SELECT conv_id, turn, seq, CASE WHEN seq > 0 THEN ' ' || word ELSE word END AS content,
             CASE WHEN seq % 50 = 0 THEN 'req-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)
                                         || '-' || CAST(seq // 50 AS VARCHAR) END AS request_id
      FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word,
                   CAST(generate_subscripts(string_split(text, ' '), 1) - 1 AS INTEGER) AS seq
            FROM conversations WHERE role = 'assistant'))
GROUP BY conv_id, turn
"""


def _deltas(spark, sf_dir):
    """Completion deltas of every assistant response: its words in order; every
    50th delta carries a request id (the stream reports ids now and then)."""
    c = _conversations(spark, sf_dir).filter(F.col("role") == "assistant")
    d = transcripts.word_chunks(c, keys=("conv_id", "turn"))
    rid = F.concat_ws("-", F.lit("req"), F.col("conv_id").cast("string"), F.col("turn").cast("string"),
                      F.floor(F.col("seq") / 50).cast("string"))
    return d.withColumn("request_id", F.when(F.col("seq") % 50 == 0, rid))


@register("x4_completion_fold", oracle=X4_SQL)
def x4(spark, sf_dir):
    """Completion deltas concatenated per response, with the last request id seen."""
    return transcripts.fold_completion_deltas(_deltas(spark, sf_dir), keys=("conv_id", "turn"), seq="seq",
                                              content="content")


X5_STREAM_SQL = """
SELECT conv_id, turn, part_idx, 'assistant' AS role, part AS content, CAST(NULL AS VARCHAR) AS tool_call_id,
       CAST(NULL AS VARCHAR) AS tool_name, CAST(NULL AS VARCHAR) AS tool_arguments
FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS part,
             CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS part_idx
      FROM conversations WHERE role = 'assistant')
WHERE COALESCE(part, '') <> ''
UNION ALL
SELECT conv_id, turn, 0, 'assistant', '', 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), 'search',
       COALESCE(text, '') FROM conversations WHERE role = 'user'
UNION ALL
SELECT conv_id, turn, 0, 'tool', COALESCE(text, ''), 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR),
       NULL, NULL FROM conversations WHERE role IS NULL OR role NOT IN ('assistant', 'user')
"""


@register("x5_items_streamed", oracle=X5_STREAM_SQL)
def x5(spark, sf_dir):
    """Response items (JSON) flattened to role rows, one per text part."""
    return transcripts.flatten_items_streamed(transcripts.response_items(_conversations(spark, sf_dir)))


X5_JOINED_SQL = """
WITH r AS (
  SELECT conv_id, turn, CASE WHEN role IS NULL OR role NOT IN ('assistant', 'user') THEN 'tool' ELSE 'assistant' END AS role,
    CASE WHEN role = 'assistant' THEN array_to_string(string_split(text, chr(10)), '')
         WHEN role = 'user' THEN '' ELSE COALESCE(text, '') END AS content,
    CASE WHEN role = 'assistant' THEN NULL ELSE 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) END AS tool_call_id,
    CASE WHEN role = 'assistant' THEN 'message' WHEN role = 'user' THEN 'function_call' ELSE 'function_call_output' END AS item_type
  FROM conversations),
kept AS (SELECT * FROM r WHERE NOT (item_type = 'message' AND content = ''))
SELECT * FROM kept
UNION ALL
SELECT DISTINCT conv_id, CAST(NULL AS BIGINT), 'assistant', 'No response found', CAST(NULL AS VARCHAR), 'message'
FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM kept)
"""


@register("x5_items_joined", oracle=X5_JOINED_SQL)
def x5_joined(spark, sf_dir):
    """Non-streamed variant; empty requests get one 'No response found' row."""
    return transcripts.flatten_items_joined(transcripts.response_items(_conversations(spark, sf_dir)))


X6_SQL = """
WITH h AS (
  SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines, text, conv_id || ':' || turn AS place,
    CASE WHEN (conv_id + turn) % 3 = 0 THEN 'm' || conv_id || '.' || turn ELSE 'msg-' || conv_id || '-' || turn END AS message_id
  FROM conversations),
items AS (
  SELECT conv_id, turn, (k - 1)::INTEGER AS item_seq, {'type': 'function_call', 'role': NULL::VARCHAR, 'id': place || ':' || k,
      'call_id': place || ':' || k, 'name': 'tool', 'arguments': line, 'content': NULL::VARCHAR, 'output': NULL::VARCHAR} AS i,
    json_object('type', 'function_call', 'id', place || ':' || k, 'call_id', place || ':' || k, 'name', 'tool', 'arguments', line) AS item
  FROM (SELECT *, unnest(lines[2:]) AS line, generate_subscripts(lines[2:], 1) AS k FROM h WHERE role = 'assistant')
  UNION ALL
  SELECT conv_id, turn, (len(lines) - 1)::INTEGER, {'type': 'message', 'role': 'assistant', 'id': message_id, 'call_id': NULL, 'name': NULL,
      'arguments': NULL, 'content': NULL, 'output': NULL},
    json_object('type', 'message', 'id', message_id, 'content', json_array(json_object('type', 'output_text', 'text', lines[1])),
                'role', 'assistant')
  FROM h WHERE role = 'assistant' AND (len(lines) = 1 OR lines[1] <> '')
  UNION ALL
  SELECT conv_id, turn, 0, {'type': NULL, 'role': 'user', 'id': NULL, 'call_id': NULL, 'name': NULL, 'arguments': NULL,
      'content': text, 'output': NULL}, json_object('role', 'user', 'content', text)
  FROM h WHERE role = 'user'
  UNION ALL
  SELECT conv_id, turn, 0, {'type': 'function_call_output', 'role': NULL, 'id': NULL, 'call_id': 'c' || conv_id || '-' || turn, 'name': NULL,
      'arguments': NULL, 'content': NULL, 'output': text},
    json_object('type', 'function_call_output', 'call_id', 'c' || conv_id || '-' || turn, 'output', text)
  FROM h WHERE role = 'system')
SELECT conv_id, turn, item_seq, unnest(i), item::VARCHAR AS item FROM items
"""


@register("x6_history_items", oracle=X6_SQL)
def x6(spark, sf_dir):
    """Chat history rows turned into request items (calls, then text)."""
    items = transcripts.history_items(transcripts.history_from_conversations(_conversations(spark, sf_dir)))
    return items.withColumn("item", transcripts.item_json()).drop("parts")


X7_SQL = """
SELECT conv_id, turn, role,
  array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: i % 2 = 1), '') AS text_content
FROM conversations
"""


@register("x7_text_parts", oracle=X7_SQL)
def x7(spark, sf_dir):
    """Only the 'text' parts of structured content, joined."""
    c = _conversations(spark, sf_dir)
    return c.select("conv_id", "turn", "role",
                    transcripts.text_parts_joined(transcripts.alternating_parts(F.col("text"))).alias("text_content"))


X8_SQL = """
SELECT rating_string, COUNT(*) AS n_rows, CAST(count_if(rating_string IS NULL) AS BIGINT) AS n_empty_assessments
FROM (SELECT CASE WHEN rating IS NULL THEN NULL WHEN rating = 1 THEN 'positive' ELSE 'negative' END AS rating_string
      FROM (SELECT CASE WHEN toxic = 1 THEN NULL ELSE quality END AS rating FROM labels))
GROUP BY rating_string
"""


@register("x8_feedback_counts", oracle=X8_SQL)
def x8(spark, sf_dir):
    """Feedback rows from labels (toxic -> no rating), counted by rating."""
    labels = read_table(spark, sf_dir, "labels")
    ratings = labels.select(F.concat(F.lit("req-"), F.col("doc_id").cast("string")).alias("request_id"),
                            F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.col("quality")).alias("rating"))
    fb = transcripts.feedback_rows(ratings)
    return fb.groupBy("rating_string").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.count_if(F.col("text_assessments") == "[]").alias("n_empty_assessments"))


def _sanitize_sql(x: str) -> str:
    s = f"replace({x}, ' ', '_')"
    s = f"regexp_replace({s}, '[^a-zA-Z0-9_-]', '_', 'g')"
    s = f"regexp_replace({s}, '[_-]{{2,}}', '_', 'g')"
    s = f"regexp_replace({s}, '^[_-]+|[_-]+$', '', 'g')"
    return f"CASE WHEN {s} = '' THEN 'knowledge_assistant' ELSE {s} END"


X9_SQL = f"""
SELECT normalized_name, COUNT(*) AS n_rows, COUNT(DISTINCT raw_name) AS n_raw_names,
       COUNT(DISTINCT raw_name) > 1 AS collides
FROM (SELECT raw_name, {_sanitize_sql('raw_name')} AS normalized_name
      FROM (SELECT url AS raw_name FROM pages UNION ALL SELECT source FROM documents))
GROUP BY normalized_name
"""


@register("x9_name_rules", oracle=X9_SQL)
def x9(spark, sf_dir):
    """Page urls and document sources normalised to resource names, with collisions."""
    names = (read_table(spark, sf_dir, "pages").select(F.col("url").alias("name"))
             .unionByName(read_table(spark, sf_dir, "documents").select(F.col("source").alias("name"))))
    return transcripts.name_report(names)


X10_SQL = """
SELECT page_id, url AS path,
  translate(regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$', 0), ' .', '__') AS source_name
FROM pages
"""


@register("x10_source_names", oracle=X10_SQL)
def x10(spark, sf_dir):
    """Source name from the last path component of each page url."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return transcripts.source_names(pages)
