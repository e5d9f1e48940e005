"""Registered streaming queries.

Each run streams the events table through the job with an AvailableNow
trigger into a fresh folder under the shared checkpoint root, then returns
the sink's contents as a DataFrame.  The oracles are the batch results: a
stream over the same rows must give the same table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plantlens.plans.layers import from_test_tables
from plantlens.plans.queries_core import HOURLY_DIGITS
from plantlens.plans.queries_extra import EPISODES_SQL
from plantlens.plans.registry import RATIO, register
from plantlens.sources import standins
from plantlens.sources.readers import read_table
from plantlens.streaming import jobs


def _hourly_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    raw = standins.line_quality_events_from(jobs.table_stream(spark, sf_dir, "events", schema))
    return jobs.hourly_flags_stream(raw, from_test_tables(spark, sf_dir).specs(), small=True)


@register("t1_stream_hourly_flags", oracle="SELECT * FROM gold_line_hourly_quality", digits=HOURLY_DIGITS)
def t1(spark, sf_dir):
    """Hourly flags computed by a stream (append mode) equal the batch table."""
    base = jobs.stream_folder(spark, "t1")
    jobs.run_append(_hourly_stream(spark, sf_dir), f"{base}/out", f"{base}/chk")
    return spark.read.parquet(f"{base}/out")


@register("t2_stream_weekly", oracle="SELECT * FROM gold_quality_weekly",
          digits={"avg_dry_solids_pct": RATIO, "avg_defect_points": RATIO})
def t2(spark, sf_dir):
    """Watermarked Monday-aligned weekly windows (update mode) equal G12."""
    base = jobs.stream_folder(spark, "t2")
    jobs.run_update_log(jobs.weekly_quality_stream(_hourly_stream(spark, sf_dir)), f"{base}/out", f"{base}/chk")
    return jobs.latest_rows(spark, f"{base}/out", ["week_start", "plant_name"])


T3_SQL = f"""
SELECT * FROM ({EPISODES_SQL})
WHERE episode_end + INTERVAL 2 HOUR <= (SELECT MAX(datetime) FROM gold_line_hourly_quality
                                        WHERE under_quality_flag OR over_quality_flag) - INTERVAL 1 DAY
"""


@register("t3_stream_episodes", oracle=T3_SQL)
def t3(spark, sf_dir):
    """Session-window breach episodes; append mode emits the episodes the
    watermark (latest flagged reading - 1 day) has closed."""
    base = jobs.stream_folder(spark, "t3")
    jobs.run_append(jobs.episode_stream(_hourly_stream(spark, sf_dir)), f"{base}/out", f"{base}/chk")
    return spark.read.parquet(f"{base}/out")


T3_OPEN_SQL = f"""
SELECT * REPLACE (kind AS kind), CASE WHEN episode_end + INTERVAL 2 HOUR <= (
    SELECT date_trunc('millisecond', MAX(datetime)) FROM gold_line_hourly_quality
    WHERE under_quality_flag OR over_quality_flag) - INTERVAL 1 DAY THEN 'closed' ELSE 'open' END AS status
FROM ({EPISODES_SQL})
"""


@register("t3_open_episodes", oracle=T3_OPEN_SQL)
def t3_open(spark, sf_dir):
    """All breach episodes from keyed state with timers: those the watermark
    has closed and those that still last."""
    base = jobs.stream_folder(spark, "t3-open")
    jobs.run_update_log(jobs.open_episode_stream(_hourly_stream(spark, sf_dir)), f"{base}/out", f"{base}/chk")
    return jobs.episodes_now(spark, f"{base}/out")


# Readings of every seventh event arrive three days late; arrivals come in weeks.
LATE_EVERY, LATE_DAYS, WAVE_DAYS, WAVES = 7, 3, 7, 5
T4_SQL = f"""
SELECT wave AS batch_id, COUNT(*) FILTER (WHERE NOT late) AS n_kept, COUNT(*) FILTER (WHERE late) AS n_late
FROM (SELECT w.wave, ifnull(w.ts < max(m.latest) - INTERVAL 1 DAY, FALSE) AS late
      FROM (SELECT event_id, ts, {{wave}} AS wave FROM events) w
      LEFT JOIN (SELECT {{wave}} AS before, MAX(ts) AS latest FROM events GROUP BY 1) m ON m.before < w.wave
      GROUP BY w.event_id, w.wave, w.ts) GROUP BY 1
""".format(wave=f"""least({WAVES - 1}, datediff('day', (SELECT min(ts) FROM events)::DATE,
  (ts + to_days(CASE WHEN event_id % {LATE_EVERY} = 0 THEN {LATE_DAYS} ELSE 0 END))::DATE) // {WAVE_DAYS})""")


@register("t4_late_rows", oracle=T4_SQL)
def t4(spark, sf_dir):
    """T4: events that arrive in waves; rows behind the watermark go to a side
    table and are counted, kept + late = all rows."""
    base = jobs.stream_folder(spark, "t4")
    events = read_table(spark, sf_dir, "events")
    first = events.agg(F.min("ts")).first()[0]
    late_by = F.when(F.col("event_id") % LATE_EVERY == 0, F.lit(LATE_DAYS)).otherwise(0)
    day = F.datediff(F.date_add(F.col("ts").cast("date"), late_by), F.lit(first).cast("date"))
    wave = F.least(F.lit(WAVES - 1), F.floor(day / WAVE_DAYS))
    for i in range(WAVES):
        events.filter(wave == i).write.parquet(f"{base}/in/wave={i}")
        arrived = jobs.event_stream(spark, f"{base}/in/wave=*", events.schema)
        jobs.run_split_late(arrived, f"{base}/out", f"{base}/chk", "ts")
    return jobs.late_counts(spark, f"{base}/out")
