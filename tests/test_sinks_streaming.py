"""Sink round trips and streaming semantics (T4 late rows and duplicates)."""

from __future__ import annotations

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from plantlens.sources import sinks
from plantlens.sources.readers import read_parquet_dir
from plantlens.sources.schemas import OEE_EVENTS
from plantlens.streaming import jobs


def test_write_parts_file_count(spark, tmp_dir):
    df = spark.range(1000, numPartitions=3)
    sinks.write_parts(df, f"{tmp_dir}/p", num_files=6)
    assert len(glob.glob(f"{tmp_dir}/p/*.parquet")) == 6
    sinks.write_parts(df, f"{tmp_dir}/q", rows_per_file=100)
    assert len(glob.glob(f"{tmp_dir}/q/*.parquet")) == 12          # 334 rows a task, 100 a file
    assert spark.read.parquet(f"{tmp_dir}/p").count() == spark.read.parquet(f"{tmp_dir}/q").count() == 1000


def test_raw_sink_iso_round_trip(spark, tmp_dir):
    rows = [(dt.datetime(2025, 8, 1, 10, 0, 0, 123456), 1, "NA-P1", "L1", "Run", None, "A",
             dt.datetime(2025, 8, 1, 9, 0), "2025-08-01 11:00:00", 60, 0, 1.0, 1.0),
            (None, 1, "NA-P1", "L1", "Run", None, "A", None, None, 60, 0, 1.0, None)]
    df = spark.createDataFrame(rows, OEE_EVENTS)
    out = sinks.save_raw(df, "oee_events", tmp_dir, num_files=3)
    assert os.path.basename(out) == "raw_oee_events"
    assert sinks.raw_name("raw_x") == "raw_x"
    raw = spark.read.parquet(out)
    assert dict(raw.dtypes)["datetime"] == "string"
    back = read_parquet_dir(spark, out, OEE_EVENTS).orderBy(F.col("datetime").asc_nulls_last()).collect()
    assert back[0]["datetime"] == dt.datetime(2025, 8, 1, 10, 0, 0, 123000)   # floored to ms
    assert back[1]["datetime"] is None                                         # 'NaT' -> NULL


def test_native_mode_keeps_timestamps(spark, tmp_dir):
    df = spark.createDataFrame([(dt.datetime(2025, 8, 1, 10, 0, 0, 123456),)], "ts timestamp")
    out = sinks.save_raw(df, "t", tmp_dir, num_files=1, timestamps="native")
    r = spark.read.parquet(out).collect()[0]
    assert r["ts"] == dt.datetime(2025, 8, 1, 10, 0, 0, 123000)


def test_save_table_with_comment(spark, tmp_dir):
    name = sinks.save_table(spark, spark.range(5), "t_comment", "plantlens_test", f"{tmp_dir}/t", "five rows")
    assert spark.table(name).count() == 5
    desc = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Comment'").collect()
    assert desc and desc[0]["data_type"] == "five rows"      # the 'comment' property is the table comment


def _write_batch(spark, folder, name, rows):
    spark.createDataFrame(rows, "k string, datetime timestamp, v double").coalesce(1) \
        .write.mode("overwrite").parquet(f"{folder}/{name}")


def test_stream_late_rows_and_duplicates(spark, tmp_dir):
    """T4: a row older than the watermark is dropped on a later batch; an exact
    repeat inside the watermark is dropped once."""
    src, out, chk = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/chk"
    os.makedirs(src)
    t0 = dt.datetime(2025, 8, 10, 0, 0)
    _write_batch(spark, src, "b1", [("a", t0, 1.0), ("a", t0 + dt.timedelta(days=3), 1.0)])
    schema = "k string, datetime timestamp, v double"

    def run():
        s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        d = jobs.dedup_within_watermark(s, ["k", "datetime"])
        agg = d.groupBy(F.window("datetime", "1 day").alias("w"), "k").agg(F.count(F.lit(1)).alias("n")) \
            .select(F.col("w.start").alias("day"), "k", "n")
        jobs.run_update_log(agg, out, chk)

    run()
    # watermark is now max(t0+3d) - 1 day = t0+2d: a row at t0 is late, t0+3d is a duplicate
    _write_batch(spark, src, "b2", [("a", t0, 1.0), ("a", t0 + dt.timedelta(days=3), 1.0),
                                    ("a", t0 + dt.timedelta(days=3, hours=1), 1.0)])
    run()
    got = {(r["day"], r["k"]): r["n"] for r in jobs.latest_rows(spark, out, ["day", "k"]).collect()}
    assert got[(t0, "a")] == 1                                  # late row not added
    assert got[(t0 + dt.timedelta(days=3), "a")] == 2           # duplicate dropped, new row counted


def test_materialize_layers_equals_lazy(spark, small_dir, tmp_dir):
    """Gold rebuilt on the written (partitioned) silver tables equals the lazy plan."""
    from plantlens.plans.layers import from_test_tables, materialize
    from plantlens.plans.registry import finish

    names = materialize(from_test_tables(spark, small_dir), f"{tmp_dir}/lake", database="plantlens_mat")
    assert len(names) == 22
    lazy = from_test_tables(spark, small_dir)
    digits = {"tons_processed": 6, "avg_dry_matter_pct": 6, "raw_potato_spend_usd": 2,
              "over_quality_waste_usd": 2, "downgrade_rework_exposure_usd": 2}
    cols = lazy.exposure().columns
    a = sorted(tuple(r) for r in finish(spark.table(names["gold_cost_exposure"]).select(*cols), digits).collect())
    b = sorted(tuple(r) for r in finish(lazy.exposure(), digits).collect())
    assert a == b
    desc = spark.sql(f"DESCRIBE TABLE EXTENDED {names['gold_quality_weekly']}").filter("col_name = 'Comment'").collect()
    assert desc and desc[0]["data_type"].startswith("Weekly plant quality")


def test_standins_match_declared_raw_schemas(spark, small_dir):
    from plantlens.sources.schemas import RAW_SCHEMAS
    from plantlens.sources.standins import raw_tables

    for name, df in raw_tables(spark, small_dir).items():
        want = [(f.name, f.dataType.simpleString()) for f in RAW_SCHEMAS[name].fields]
        got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        assert got == want, name


def test_raw_sink_round_trip_gives_same_gold(spark, small_dir, tmp_dir):
    """Raw stand-ins -> raw sink (ISO text, part files) -> declared-schema read
    -> gold equals gold built directly on the stand-ins."""
    from plantlens.plans.layers import from_raw_folder, from_test_tables
    from plantlens.plans.registry import finish
    from plantlens.sources.standins import raw_tables

    for name, df in raw_tables(spark, small_dir).items():
        sinks.save_raw(df, name, f"{tmp_dir}/raw", num_files=3)
    a_layers, b_layers = from_raw_folder(spark, f"{tmp_dir}/raw"), from_test_tables(spark, small_dir)
    checks = [
        ({"avg_dry_solids_pct": 6, "avg_defect_points": 6}, lambda L: L.weekly()),
        ({"tons_processed": 6, "avg_dry_matter_pct": 6, "raw_potato_spend_usd": 2, "over_quality_waste_usd": 2,
          "downgrade_rework_exposure_usd": 2}, lambda L: L.exposure()),
        ({"total_downtime_min": 6, "run_duration_min": 6, "qty_packed_kg": 2, "num_totes_on": 6,
          "oee_performance": 6}, lambda L: L.oee_daily()),
    ]
    for digits, table in checks:
        a = sorted(tuple(r) for r in finish(table(a_layers), digits).collect())
        b = sorted(tuple(r) for r in finish(table(b_layers), digits).collect())
        assert a == b
    assert a_layers.oee().filter("end_time_ts IS NOT NULL").count() == b_layers.oee().filter(
        "end_time_ts IS NOT NULL").count()


def test_written_layers(spark, small_dir, tmp_dir):
    """Gold comes from written tables; files a partition are bounded; the
    daily line aggregate is partial, dealt out, final; KPIs prune partitions."""
    from plantlens.plans import gold
    from plantlens.plans.layers import Layers, from_test_tables, materialize
    from plantlens.sources.staging import current_version

    layers = from_test_tables(spark, small_dir)
    names = materialize(layers, f"{tmp_dir}/lake", database="plantlens_wl")
    for table in ("silver_oee_events", "gold_line_hourly_quality", "gold_cost_exposure"):
        days = glob.glob(f"{tmp_dir}/lake/{table}/version-*/*=*")
        assert len(days) > 5
        for day in days:
            assert len(glob.glob(f"{day}/*.parquet")) <= 4
    plan = gold.oee_kpis(spark.table(names["silver_oee_events"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1 and "Bucketed: true" not in plan
    written = Layers(spark, {}, layers.as_of)
    for name, full in names.items():
        written.use_written(name, spark.table(full), current_version(spark, f"{tmp_dir}/lake/{name}"))
    for how in ("kpi_spend", "kpi_tons", "kpi_downgrade", "kpi_performance"):
        kpi = getattr(written, how)()
        text = kpi._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date" in text, text
        a, b = kpi.first()[0], getattr(layers, how)().first()[0]
        assert abs(a - b) <= 1e-9 * abs(b)


def test_building_plans_runs_no_job(spark, small_dir):
    """Building any table opens parquet footers only: no shuffle, no cached data."""
    from plantlens.plans.layers import from_test_tables

    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    spark.sparkContext.setJobGroup("plans", "")
    tables = from_test_tables(spark, small_dir).tables()
    ids = spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tables) == 22 and len(ids) <= 4           # one footer read for each of lineitem, orders, part, events
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept


def test_trailing_windows_leave_rows_out(spark, small_dir):
    from pyspark.sql import functions as F

    from plantlens.operators.windows import trailing_window
    from plantlens.plans.layers import from_test_tables

    daily = from_test_tables(spark, small_dir).oee_daily()
    counts = [trailing_window(daily, "date", n).agg(F.sum("event_count")).first()[0] for n in (7, 29, 30)]
    assert counts[0] < counts[1] < counts[2] < daily.agg(F.sum("event_count")).first()[0]


def test_streams_over_a_folder_of_parts(spark, small_dir, tmp_dir):
    """T1-T3 read the same rows from a folder of part files as from one file."""
    from plantlens.plans.registry import load_all

    for name in ("part", "lineitem", "orders"):
        os.symlink(f"{small_dir}/{name}.parquet", f"{tmp_dir}/{name}.parquet")
    spark.read.parquet(f"{small_dir}/events.parquet").repartition(4).write.parquet(f"{tmp_dir}/events.parquet")
    queries = load_all()
    for key in ("t1_stream_hourly_flags", "t2_stream_weekly", "t3_stream_episodes"):
        a, b = (queries[key].build(spark, d) for d in (tmp_dir, small_dir))
        assert a.count() == b.count() > 0
    flat = ["datetime", "plant_name", "plant_line", "product_name", "under_quality_flag"]
    a, b = (queries["t1_stream_hourly_flags"].build(spark, d).select(flat) for d in (tmp_dir, small_dir))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_checkpoint_folder_must_be_shared():
    import pytest

    from plantlens.session import checkpoint_dir, is_local

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    assert is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local(None)
    with pytest.raises(ValueError):
        checkpoint_dir(Session())


def test_cli_materialises_all_tables(spark, small_dir, tmp_dir, capsys):
    from plantlens.__main__ import main

    main(["--test-tables", small_dir, "--out", f"{tmp_dir}/lake", "--database", "plantlens_cli"])
    printed = [line.split("\t") for line in capsys.readouterr().out.strip().splitlines()]
    assert len(printed) == 22
    for table, name in printed:
        assert os.path.isdir(f"{tmp_dir}/lake/{table}")
        assert spark.table(name).columns


def test_conform_is_strict_unless_told(spark, tmp_dir):
    """A missing column raises when the folder is opened, an unfit value
    when it is read; ``lenient`` reads both as NULL."""
    import pytest
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, 5_000_000_000), (2, 7)], "plant_id bigint, effective_actual_weight bigint")
    df.write.mode("overwrite").parquet(f"{tmp_dir}/raw_loads")
    fields = [T.StructField("plant_id", T.IntegerType()), T.StructField("effective_actual_weight", T.IntegerType())]
    wide = T.StructType([*fields, T.StructField("VarietyLabel", T.StringType())])
    with pytest.raises(ValueError, match="VarietyLabel"):
        read_parquet_dir(spark, f"{tmp_dir}/raw_loads", wide)
    with pytest.raises(Exception, match="does not fit"):
        read_parquet_dir(spark, f"{tmp_dir}/raw_loads", T.StructType(fields)).collect()
    rows = sorted(read_parquet_dir(spark, f"{tmp_dir}/raw_loads", wide, lenient=True).collect())
    assert [tuple(r) for r in rows] == [(1, None, None), (2, 7, None)]


def test_compact_update_log(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    for batch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 5), ("a", 3)]]):
        spark.createDataFrame(rows, "k string, n int").write.mode("overwrite").parquet(f"{log}/batch_id={batch}")
    snap = jobs.compact_update_log(spark, log, ["k"], f"{tmp_dir}/snap")
    assert sorted(tuple(r) for r in spark.read.parquet(snap).collect()) == [("a", 3), ("b", 1), ("c", 5)]


def test_three_part_table_name(spark, tmp_dir):
    """Catalog.database.table names (the built-in catalog is spark_catalog)."""
    name = sinks.save_table(spark, spark.range(3), "t3", "plantlens_s10", f"{tmp_dir}/t3", catalog="spark_catalog")
    assert name == "`spark_catalog`.`plantlens_s10`.`t3`"
    assert spark.table("spark_catalog.plantlens_s10.t3").count() == 3
