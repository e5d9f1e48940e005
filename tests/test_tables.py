"""Saved tables: atomic replacement, file counts from the data, partition
anchors; folders of mixed part files; the factorised alignment; late rows and
open episodes."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.operators.windows import trailing_sums
from plantlens.plans import gold, queries_ops
from plantlens.sources import sinks, staging
from plantlens.sources.readers import read_mixed_dir
from plantlens.streaming import jobs


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_failed_write_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    name = sinks.save_table(spark, spark.range(5), "t_atomic", "plantlens_atomic", path, "five")
    broken = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    before = staging.current_version(spark, path)
    with pytest.raises(Exception, match="lost"):
        sinks.save_table(spark, broken, "t_atomic", "plantlens_atomic", path)
    assert staging.current_version(spark, path) == before
    assert spark.table(name).count() == staging.read_current(spark, path).count() == 5
    # the next good write replaces it, whatever the failed one left behind
    sinks.save_table(spark, spark.range(7), "t_atomic", "plantlens_atomic", path)
    assert spark.table(name).count() == staging.read_current(spark, path).count() == 7


def test_replacing_keeps_the_version_before_for_its_readers(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    name = sinks.save_table(spark, spark.range(3), "t_versions", "plantlens_atomic", path)
    open_reader = spark.read.parquet(staging.current_version(spark, path))
    sinks.save_table(spark, spark.range(4), "t_versions", "plantlens_atomic", path)
    assert open_reader.count() == 3 and spark.table(name).count() == 4
    sinks.save_table(spark, spark.range(6), "t_versions", "plantlens_atomic", path)
    assert len(glob.glob(f"{path}/version-*")) == 2 and spark.table(name).count() == 6


def test_replacing_with_other_columns_and_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    a = spark.createDataFrame([(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2)), (3, None)], "v int, day date")
    name = sinks.save_table(spark, a, "t_shapes", "plantlens_atomic", path, "by day", partition_by="day")
    assert plain(spark.table(name).select("v", "day")) == plain(a)
    b = a.filter("v = 2").withColumn("note", F.lit("x")).select("note", "day", "v")
    sinks.save_table(spark, b, "t_shapes", "plantlens_atomic", path, partition_by="day")
    assert plain(spark.table(name).select("v", "day", "note")) == [(2, dt.date(2025, 1, 2), "x")]
    assert spark.table(name).columns == ["note", "v", "day"]
    sinks.save_table(spark, b.union(b), "t_shapes", "plantlens_atomic", path, partition_by="day")
    assert spark.table(name).count() == 2
    sinks.save_table(spark, a, "t_shapes", "plantlens_atomic", path)                    # no longer partitioned
    assert plain(spark.table(name)) == plain(a)


def test_no_table_was_saved(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        staging.read_current(spark, f"{tmp_dir}/nothing")


def test_a_hot_day_gets_files_by_its_size(spark, tmp_dir):
    """Files follow the bytes of a day, not a fixed number a day."""
    hot = spark.range(400_000, numPartitions=16).select(
        F.lit("2025-01-01").cast("date").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    cold = spark.range(300, numPartitions=2).select(
        F.date_add(F.lit("2025-01-02").cast("date"), (F.col("id") % 3).cast("int")).alias("day"), F.lit("c").alias("x"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        df = hot.union(cold)
        plan = df.hint("rebalance", F.col("day"))._jdf.queryExecution().executedPlan().toString()
        assert "REBALANCE_PARTITIONS_BY_COL" in plan
        sinks.save_table(spark, df, "t_hot", "plantlens_atomic", f"{tmp_dir}/t", partition_by="day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {os.path.basename(d): len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{tmp_dir}/t/version-*/day=*")}
    assert files["day=2025-01-01"] >= 5 and max(n for d, n in files.items() if d != "day=2025-01-01") <= 2
    assert spark.table("plantlens_atomic.t_hot").count() == 400_300


def test_latest_day_from_partition_names(spark, tmp_dir):
    rows = [(dt.date(2025, 1, 1) + dt.timedelta(i % 40), float(i)) for i in range(400)] + [(None, 5.0)]
    df = spark.createDataFrame(rows, "day date, v double")
    name = sinks.save_table(spark, df, "t_days", "plantlens_atomic", f"{tmp_dir}/t", partition_by="day")
    folder = staging.current_version(spark, f"{tmp_dir}/t")
    last = staging.latest_partition(spark, folder, "day")
    assert last == "2025-02-09" and staging.latest_partition(spark, folder, "other") is None
    table = spark.table(name)
    anchored = trailing_sums(table, "day", 7, {"v": F.col("v")}, anchor=F.lit(last).cast("date"))
    plan = anchored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and plan.count("Scan parquet") == 1 and "Subquery" not in plan
    once = trailing_sums(table, "day", 7, {"v": F.col("v")})
    assert once._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    want = sum(v for d, v in rows if d and d >= dt.date(2025, 2, 2))
    assert anchored.first()[0] == once.first()[0] == want
    assert trailing_sums(table.limit(0), "day", 7, {"v": F.col("v")}).first()[0] is None


def test_kpis_read_each_source_once(spark, small_dir):
    from plantlens.plans.layers import from_test_tables

    for how in ("kpi_spend", "kpi_downgrade"):
        plan = getattr(from_test_tables(spark, small_dir), how)()._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.splitlines() if "Scan parquet" in x]
        assert sum("lineitem" in x for x in scans) == 1, plan


MIXED = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("at", T.TimestampType())])


def test_part_files_of_mixed_types(spark, tmp_dir):
    t = dt.datetime(2025, 8, 1, 10, 0, 0, 123000)
    iso = spark.createDataFrame([(1, 5, "2025-08-01T10:00:00.123Z"), (2, None, "NaT")], "id int, n bigint, at string")
    native = spark.createDataFrame([(t, 3, 7), (None, 4, None)], "at timestamp, id bigint, n int")
    iso.write.parquet(f"{tmp_dir}/raw/a")
    native.write.parquet(f"{tmp_dir}/raw/b")
    iso.limit(1).write.parquet(f"{tmp_dir}/raw/c")
    got = read_mixed_dir(spark, f"{tmp_dir}/raw", MIXED)
    assert got.schema.fieldNames() == ["id", "n", "at"]
    assert plain(got) == sorted([(1, 5, t), (2, None, None), (3, 7, t), (4, None, None), (1, 5, t)], key=repr)
    scans = got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans == 2                                           # one a schema, not one a file
    os.makedirs(f"{tmp_dir}/none")
    assert read_mixed_dir(spark, f"{tmp_dir}/none", MIXED).count() == 0
    iso.drop("at").write.parquet(f"{tmp_dir}/raw/d")
    with pytest.raises(ValueError, match="at"):
        read_mixed_dir(spark, f"{tmp_dir}/raw", MIXED)
    assert read_mixed_dir(spark, f"{tmp_dir}/raw", MIXED, lenient=True).count() == 7


def _alignment_inputs(spark):
    day = dt.date(2025, 1, 1)
    hourly = [(day, "P", "L1", i % 24, "A", 20.0 + i % 7, False, i % 2 == 0) for i in range(60)]
    hourly += [(day, "P", "L2", 1, "A", 20.0, True, False), (None, "P", "L1", 1, "A", 20.0, True, False), (day, None, "L1", 2, None, None, False, False)]
    events = [(day, "P", "L1", "run", None, float(i % 11), 1.0) for i in range(50)] + [(day, "P", "L1", "fix", "cutter", None, 2.0)]
    events += [(day, "P", "L9", "run", None, 1.0, 1.0), (None, "P", "L1", "run", None, 3.0, 1.0)]
    return (spark.createDataFrame(hourly, "date date, plant_name string, plant_line string, hour int, product_name string, "
                                          "dry_solids_pct double, under_quality_flag boolean, over_quality_flag boolean"),
            spark.createDataFrame(events, "date date, plant_name string, plant_line string, downtime_cat_1 string, downtime_cat_2 string, "
                                          "duration_min double, downtime_min double"))


@pytest.mark.parametrize("chunk", [1000, 4])
def test_factorised_alignment_expands_to_the_literal_join(spark, chunk):
    hourly, oee = _alignment_inputs(spark)
    want = hourly.join(oee, gold.ALIGN_KEYS, "left").select(*gold.ALIGN_KEYS, *gold.ALIGN_READING, *gold.ALIGN_EVENT)
    factors = gold.alignment_factors(hourly, oee, chunk)
    assert plain(gold.expand_alignment(factors)) == plain(want)
    entries = factors.agg(F.sum(F.size("readings") + F.coalesce(F.size("events"), F.lit(0)))).first()[0]
    assert entries < want.count() / 5 if chunk > 100 else entries < want.count()
    assert factors.agg(F.max(F.size("readings"))).first()[0] <= max(chunk * 4, 10)


@pytest.mark.parametrize("columns", [["downtime_cat_1", "duration_min", "downtime_min"], ["product_name", "dry_solids_pct"],
                                     ["hour", "downtime_cat_2"], []])
@pytest.mark.parametrize("chunk", [1000, 4])
def test_counted_alignment_is_the_literal_join_with_equal_rows_counted(spark, columns, chunk):
    hourly, oee = _alignment_inputs(spark)
    want = hourly.join(oee, gold.ALIGN_KEYS, "left").groupBy(*gold.ALIGN_KEYS, *columns).agg(F.count(F.lit(1)).alias("copies"))
    got = gold.expand_alignment(gold.alignment_factors(hourly, oee, chunk), counted=columns)
    assert plain(got.groupBy(*gold.ALIGN_KEYS, *columns).agg(F.sum("copies").alias("copies"))) == plain(want)
    with pytest.raises(ValueError, match="nothing"):
        gold.expand_alignment(got, counted=["nothing"])


def test_counted_alignment_makes_no_row_for_each_pair(spark):
    """A hot day and line: rows follow the events, whatever the number of readings."""
    day = dt.date(2025, 1, 1)
    hourly, oee = _alignment_inputs(spark)
    readings = spark.range(3000).select(F.lit(day).alias("date"), F.lit("P").alias("plant_name"), F.lit("L1").alias("plant_line"),
                                        (F.col("id") % 24).cast("int").alias("hour"), F.lit("A").alias("product_name"),
                                        F.col("id").cast("double").alias("dry_solids_pct"), F.lit(True).alias("under_quality_flag"),
                                        F.lit(False).alias("over_quality_flag"))
    events = spark.range(700).select(F.lit(day).alias("date"), F.lit("P").alias("plant_name"), F.lit("L1").alias("plant_line"),
                                     F.lit("run").alias("downtime_cat_1"), F.lit(None).cast("string").alias("downtime_cat_2"),
                                     F.col("id").cast("double").alias("duration_min"), F.lit(1.0).alias("downtime_min"))
    got = gold.expand_alignment(gold.alignment_factors(readings, events), counted=["duration_min"])
    n = got.agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("pairs")).first()
    assert n.pairs == 3000 * 700 and n.rows <= 700 * 10


def test_event_alignment_query_repeats_no_row_by_its_copies(spark, small_dir):
    plan = queries_ops.g17_events(spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "sequence(" not in plan


def _hourly(spark, folder, name, stamps):
    rows = [("P", "L", "A", s, True, False) for s in stamps]
    spark.createDataFrame(rows, "plant_name string, plant_line string, product_name string, datetime timestamp, "
                                "under_quality_flag boolean, over_quality_flag boolean").coalesce(1).write.parquet(f"{folder}/{name}")


def test_open_episodes_over_several_batches(spark, tmp_dir):
    """An episode is open, grows, is joined with a reading between, and closes;
    a retried reader sees each once."""
    t0 = dt.datetime(2025, 8, 1)
    hour = dt.timedelta(hours=1)
    src, out, chk = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/chk"
    schema = ("plant_name string, plant_line string, product_name string, datetime timestamp, under_quality_flag boolean, "
              "over_quality_flag boolean")

    def run():
        s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        jobs.run_update_log(jobs.open_episode_stream(s, 120, "6 hours"), out, chk)
        return sorted((r.episode_start, r.episode_end, r.n_readings, r.status) for r in jobs.episodes_now(spark, out).collect())

    _hourly(spark, src, "b1", [t0, t0 + hour, t0 + 4 * hour])
    assert run() == [(t0, t0 + hour, 2, "open"), (t0 + 4 * hour, t0 + 4 * hour, 1, "open")]
    _hourly(spark, src, "b2", [t0 + 2 * hour, t0 + 3 * hour])                     # joins the two
    assert run() == [(t0, t0 + 4 * hour, 5, "open")]
    _hourly(spark, src, "b3", [t0 + 20 * hour])
    assert run() == [(t0, t0 + 4 * hour, 5, "closed"), (t0 + 20 * hour, t0 + 20 * hour, 1, "open")]
    _hourly(spark, src, "b4", [t0 + 1 * hour, t0 + 40 * hour])                    # the first is late
    assert run() == [(t0, t0 + 4 * hour, 5, "closed"), (t0 + 20 * hour, t0 + 20 * hour, 1, "closed"),
                     (t0 + 40 * hour, t0 + 40 * hour, 1, "open")]


def test_late_rows_are_set_apart_and_counted(spark, tmp_dir):
    t0 = dt.datetime(2025, 8, 10)
    day = dt.timedelta(days=1)
    waves = [[t0, t0 + 3 * day, None], [t0 + day, t0 + 2 * day, t0 + 4 * day, None], [t0 + 3 * day, t0 + 3 * day - dt.timedelta(seconds=1)]]
    out, chk = f"{tmp_dir}/out", f"{tmp_dir}/chk"
    for i, wave in enumerate(waves):
        spark.createDataFrame([(i, s) for s in wave], "wave int, datetime timestamp").write.parquet(f"{tmp_dir}/in/w={i}")
        stream = jobs.event_stream(spark, f"{tmp_dir}/in/w=*", "wave int, datetime timestamp")
        jobs.run_split_late(stream, out, chk)
    assert plain(jobs.late_counts(spark, out)) == [(0, 3, 0), (1, 3, 1), (2, 1, 1)]
    late = plain(jobs.split_rows(spark, out, True))
    assert late == [(1, t0 + day), (2, t0 + 3 * day - dt.timedelta(seconds=1))]
    assert jobs.split_rows(spark, out, False).count() + len(late) == sum(map(len, waves))
