"""Structured Streaming versions of the hourly flags and weekly roll-ups.

The streams reuse the batch builders unchanged (silver projections, the
static spec join, the flag expressions), so a stream and a batch run over
the same rows agree.  Every run uses ``Trigger.AvailableNow`` so it ends,
and keeps its progress in a checkpoint folder under the cluster's shared
``spark.checkpoint.dir``; a restarted or retried run resumes from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from plantlens.functions import columns as C
from plantlens.plans import gold, silver
from plantlens.session import checkpoint_dir

WEEK_OFFSET = "4 days"   # epoch (1970-01-01) is a Thursday; +4 days makes Monday weeks
EPISODE_GAP = "2 hours"


def event_stream(spark: SparkSession, directory: str, schema, glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of the parquet files in ``directory`` whose names match ``glob``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema) -> DataFrame:
    """File stream of ``{sf_dir}/{name}.parquet``, a folder of part files or a
    single file.  Looked up through Spark's own file system, so any store works."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(path).isDirectory():
        return event_stream(spark, f"{sf_dir}/{name}.parquet", schema)
    return event_stream(spark, sf_dir, schema, glob=f"{name}.parquet")


def hourly_flags_stream(raw_events: DataFrame, specs: DataFrame, small: bool = False) -> DataFrame:
    """Hourly readings flagged against the (static) spec table, which is
    broadcast if stated ``small``.  Stateless, so append mode emits every row once."""
    return gold.line_hourly_quality(silver.line_quality_events(raw_events), specs, small=small)


def weekly_quality_stream(hourly: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Weekly tumbling aggregates, Monday-aligned, with a watermark that
    bounds the state and drops rows arriving later than it."""
    avgs = [F.avg(f"fry_color_{i}_share") for i in range(5)]
    return (hourly.withWatermark("datetime", watermark)
            .groupBy(F.window("datetime", "7 days", "7 days", WEEK_OFFSET).alias("w"), "plant_name")
            .agg(F.avg("dry_solids_pct").alias("avg_dry_solids_pct"),
                 F.avg("total_defect_points").alias("avg_defect_points"),
                 C.dominant_class(avgs).alias("fry_color_class_mode"),
                 F.count_if("under_quality_flag").alias("hours_under_quality"),
                 F.count_if("over_quality_flag").alias("hours_over_quality"))
            .select(F.col("w.start").alias("week_start"), "plant_name", "avg_dry_solids_pct", "avg_defect_points",
                    "fry_color_class_mode", "hours_under_quality", "hours_over_quality"))


def episode_stream(hourly: DataFrame, gap: str = EPISODE_GAP, watermark: str = "1 day",
                   keys=("plant_name", "plant_line", "product_name")) -> DataFrame:
    """Breach episodes as session windows over flagged readings.  Append
    mode: an episode is emitted once the watermark passes its end."""
    kind = (F.when(F.col("under_quality_flag"), F.lit("under"))
            .when(F.col("over_quality_flag"), F.lit("over")))
    flagged = hourly.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    return (flagged.withWatermark("datetime", watermark)
            .groupBy(F.session_window("datetime", gap).alias("s"), *keys, "kind")
            .agg(F.min("datetime").alias("episode_start"), F.max("datetime").alias("episode_end"),
                 F.count(F.lit(1)).alias("n_readings"))
            .drop("s"))


OPEN_EPISODE = ("episode_start timestamp, episode_end timestamp, n_readings long, status string, version long")
OPEN_STATE = "starts array<long>, ends array<long>, counts array<long>, version long"


def merge_sessions(sessions: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(start, end, readings) runs in which each begins less than ``gap`` after
    the one before it ends, merged."""
    out: list[tuple[int, int, int]] = []
    for start, end, n in sorted(sessions):
        if out and start < out[-1][1] + gap:
            first, last, m = out[-1]
            out[-1] = (first, max(last, end), m + n)
        else:
            out.append((start, end, n))
    return out


def open_episode_stream(hourly: DataFrame, gap_minutes: int = 120, watermark: str = "1 day",
                        keys=("plant_name", "plant_line", "product_name")) -> DataFrame:
    """T3 with the episodes that still last.  Each key's state holds its episodes
    that a later reading may still extend; an event-time timer closes them once
    the watermark is ``gap_minutes`` past their end.

    Update mode: whenever a key gets readings or a timer fires, its newly closed
    episodes and all its open ones are emitted under the key's next ``version``;
    :func:`episodes_now` reads the log.  The state of a key is as large as its
    open episodes, bounded by the watermark's delay over the gap."""
    gap = gap_minutes * 60_000_000
    kind = (F.when(F.col("under_quality_flag"), F.lit("under"))
            .when(F.col("over_quality_flag"), F.lit("over")))
    names = [*keys, "kind"]
    flagged = (hourly.withColumn("kind", kind).filter(F.col("kind").isNotNull())
               .select(*names, F.col("datetime").cast("timestamp").alias("datetime"))
               .withWatermark("datetime", watermark).withColumn("at", F.unix_micros("datetime")))
    fields = ", ".join(f"{n} string" for n in names)

    def advance(key, frames, state):
        import pandas as pd

        starts, ends, counts, version = state.get if state.exists else ([], [], [], 0)
        sessions = list(zip(starts, ends, counts))
        for frame in frames:
            sessions += [(t, t, 1) for t in frame["at"].tolist()]
        seen = state.getCurrentWatermarkMs()
        sessions = merge_sessions(sessions, gap)
        closed = [s for s in sessions if s[1] + gap <= seen * 1000]
        lasting = [s for s in sessions if s[1] + gap > seen * 1000]
        if lasting:
            state.update(([s[0] for s in lasting], [s[1] for s in lasting], [s[2] for s in lasting], version + 1))
            state.setTimeoutTimestamp(max(min(s[1] for s in lasting) + gap - 1000, (seen + 1) * 1000) // 1000)
        else:
            state.remove()
        rows = [(*key, s[0], s[1], s[2], status, version + 1)
                for status, some in (("closed", closed), ("open", lasting)) for s in some]
        out = pd.DataFrame(rows, columns=[*names, "episode_start", "episode_end", "n_readings", "status", "version"])
        for c in ("episode_start", "episode_end"):
            out[c] = pd.to_datetime(out[c], unit="us")
        if rows:
            yield out

    return flagged.groupBy(*names).applyInPandasWithState(
        advance, f"{fields}, {OPEN_EPISODE}", OPEN_STATE, "update", GroupStateTimeout.EventTimeTimeout)


def episodes_now(spark: SparkSession, out: str, keys=("plant_name", "plant_line", "product_name")) -> DataFrame:
    """The log of :func:`open_episode_stream`: every closed episode, and the open
    ones of each key's latest version."""
    names = [*keys, "kind"]
    log = spark.read.parquet(out).drop("batch_id")
    latest = log.groupBy(*[F.col(n).alias(f"{n}_of") for n in names]).agg(F.max("version").alias("latest"))
    both = log.join(latest, [log[n].eqNullSafe(latest[f"{n}_of"]) for n in names])
    return both.filter((F.col("status") == "closed") | (F.col("version") == F.col("latest"))).select(
        *names, "episode_start", "episode_end", "n_readings", "status")


def run_split_late(stream: DataFrame, out: str, chk: str, event_col: str = "datetime", delay: str = "1 day") -> None:
    """T4: a stream's rows, those behind the watermark apart and counted.

    The watermark of a micro-batch is the latest event time of the batches
    before it less ``delay``.  Each batch is written once, in two folders
    (``late=false`` and ``late=true``) of its own ``batch_id``, and then its mark
    (latest event time, rows of either kind).  A retried batch overwrites its
    own folders and reads only the marks before it, so it decides alike.  Rows
    without an event time are not late."""
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        limit = None
        if batch_id:
            marks = spark.read.schema(MARK).parquet(*[f"{out}/marks/batch_id={i}" for i in range(batch_id)])
            limit = marks.agg(F.max("latest") - F.expr(f"INTERVAL {delay}")).first()[0]
        late = F.lit(False) if limit is None else F.coalesce(F.col(event_col) < F.lit(limit), F.lit(False))
        rows = f"{out}/rows/batch_id={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(rows)
        done = spark.read.schema(batch.withColumn("late", late).schema).parquet(rows)
        done.agg(F.max(event_col).cast("timestamp").alias("latest"), F.count_if(~F.col("late")).alias("n_kept"),
                 F.count_if("late").alias("n_late")).coalesce(1).write.mode("overwrite").parquet(f"{out}/marks/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", chk).trigger(availableNow=True).start())
    q.awaitTermination()


MARK = "latest timestamp, n_kept long, n_late long"


def split_rows(spark: SparkSession, out: str, late: bool) -> DataFrame:
    """The rows that :func:`run_split_late` kept, or those it set apart."""
    return spark.read.parquet(f"{out}/rows").filter(F.col("late") == late).drop("late", "batch_id")


def late_counts(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, n_kept, n_late) of every micro-batch."""
    return spark.read.parquet(f"{out}/marks").select(F.col("batch_id").cast("long").alias("batch_id"), "n_kept", "n_late")


def dedup_within_watermark(stream: DataFrame, keys: list[str], event_col: str = "datetime",
                           watermark: str = "1 day") -> DataFrame:
    """T4: drop repeated events (same key) that arrive within the watermark."""
    return stream.withWatermark(event_col, watermark).dropDuplicatesWithinWatermark(keys)


def stream_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's output and checkpoint, under the shared
    checkpoint root named by the cluster."""
    return f"{checkpoint_dir(spark).rstrip('/')}/plantlens-streams/{name}-{uuid.uuid4().hex}"


def run_append(df: DataFrame, out: str, chk: str) -> None:
    """Run a stream to a parquet sink until the available input is consumed."""
    q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", chk)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()


def run_update_log(df: DataFrame, out: str, chk: str) -> None:
    """Run an aggregating stream in update mode; every micro-batch writes its
    updated rows to its own ``batch_id=N`` partition of a parquet log
    (idempotent: a retried batch overwrites its own partition)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = (df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", chk)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def latest_rows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Current state of an update log: the row of the newest batch per key."""
    log = spark.read.parquet(out)
    value_cols = [c for c in log.columns if c not in (*keys, "batch_id")]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), "batch_id").alias("v"))
    return latest.select(*keys, "v.*")


def compact_update_log(spark: SparkSession, out: str, keys: list[str], dest: str) -> str:
    """Write the current state of an update log (one row per key, from the
    newest batch) to ``dest``: readers of a long-running stream scan this
    snapshot instead of every batch partition.  A distributed aggregate and
    a write; nothing passes through the driver."""
    latest_rows(spark, out, keys).write.mode("overwrite").parquet(dest)
    return dest

