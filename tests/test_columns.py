"""Operator tests on small inline fixtures (FIXTURES.md, group C)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from plantlens.functions import columns as C
from plantlens.functions.timestamps import iso_utc_ms, parse_iso_timestamp, try_timestamp


def _one(df, col):
    return [r[col] for r in df.collect()]


def test_dm_band_edges(spark):
    vals = [(20.9,), (21.0,), (21.01,), (22.0,), (22.99,), (23.0,), (None,)]
    df = spark.createDataFrame(vals, "dm double").select("dm", C.dm_band("dm").alias("b"))
    got = {r["dm"]: r["b"] for r in df.collect()}
    assert got == {20.9: "<=21%", 21.0: "<=21%", 21.01: "21-22%", 22.0: "21-22%", 22.99: "22-23%",
                   23.0: ">=23%", None: None}


def test_tolerance_flags_edges(spark):
    # min 21.5, max 22.1, tolerance 0.3 -> under below 21.2, over above 22.4
    rows = [(21.19, 21.5, 22.1), (21.2, 21.5, 22.1), (21.8, 21.5, 22.1), (22.4, 21.5, 22.1),
            (22.41, 21.5, 22.1), (25.0, None, None)]
    df = spark.createDataFrame(rows, "v double, lo double, hi double").select(
        "v", C.below("v", "lo").alias("u"), C.above("v", "hi").alias("o"))
    got = {r["v"]: (r["u"], r["o"]) for r in df.collect()}
    assert got[21.19] == (True, False)
    assert got[21.8] == (False, False)
    assert got[22.41] == (False, True)
    assert got[25.0] == (False, False)          # NULL spec -> FALSE, not NULL


def test_region_prefix_and_unknown(spark):
    df = spark.createDataFrame([("NA-ID-P01",), ("EU-NL-P03",), ("APAC-1",), (None,)], "p string")
    got = _one(df.select(C.region_of("p").alias("r")), "r")
    assert got == ["NA", "EU", None, None]


def test_safe_ratio_never_raises(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (1.0, None)], "n double, d double")
    assert _one(df.select(C.safe_ratio("n", "d").alias("r")), "r") == [None, 2.5, None]


def test_dominant_class_ties_and_nulls(spark):
    df = spark.createDataFrame([(0.2, 0.2, 0.1, 0.1, 0.4), (0.3, 0.3, 0.2, 0.1, 0.1),
                                (None, None, None, None, None), (0.0, 0.0, 0.0, 0.0, 0.0)],
                               "a double, b double, c double, d double, e double")
    got = _one(df.select(C.dominant_class([F.col(c) for c in "abcde"]).alias("k")), "k")
    assert got == [4, 0, 4, 0]                  # tie -> lowest class, all NULL -> 4


def test_load_arrival_date(spark):
    ids = [("NA-ID-P01-20250812-3-S7",), ("EU-NL-P03-20250901-12-S2",), ("NA-P1-bad-3",), ("EU-P4-20251399-1-S1",)]
    df = spark.createDataFrame(ids, "id string").select("id", C.load_arrival_date("id").alias("d"),
                                                        F.abs(F.hash("id").cast("bigint")).alias("h"))
    got = {r["id"]: (r["d"], r["h"]) for r in df.collect()}
    assert got["NA-ID-P01-20250812-3-S7"][0] == dt.date(2025, 8, 12)
    assert got["EU-NL-P03-20250901-12-S2"][0] == dt.date(2025, 9, 1)
    d, h = got["NA-P1-bad-3"]
    assert d == dt.date(2025, 7, 10) + dt.timedelta(days=h % 114)
    assert got["EU-P4-20251399-1-S1"][0] is None        # not a calendar day: NULL, not a failed job


def test_try_timestamp_formats(spark):
    rows = [("2025-08-12 10:20:30",), ("2025-08-12 10:20",), ("08/12/2025 10:20:30",), ("",), ("garbage",)]
    df = spark.createDataFrame(rows, "t string")
    plain = _one(df.select(try_timestamp(F.col("t")).alias("x")), "x")
    assert plain[0] == dt.datetime(2025, 8, 12, 10, 20, 30)
    assert plain[1] == dt.datetime(2025, 8, 12, 10, 20)
    assert plain[2:] == [None, None, None]
    ext = _one(df.select(try_timestamp(F.col("t"), ["MM/dd/yyyy HH:mm:ss"]).alias("x")), "x")
    assert ext[2] == dt.datetime(2025, 8, 12, 10, 20, 30)


def test_iso_encoding_round_trip(spark):
    rows = [(dt.datetime(2025, 6, 22, 13, 45, 12, 123456),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp").select("ts", iso_utc_ms(F.col("ts")).alias("iso"))
    got = df.collect()
    assert got[0]["iso"] == "2025-06-22T13:45:12.123Z"
    assert got[1]["iso"] == "NaT"
    back = _one(df.select(parse_iso_timestamp(F.col("iso")).alias("b")), "b")
    assert back == [dt.datetime(2025, 6, 22, 13, 45, 12, 123000), None]


def test_initcap_lowers_rest(spark):
    df = spark.createDataFrame([(" PrivateLabel ",), ("retail",), (None,)], "c string")
    assert _one(df.select(C.initcap_trim("c").alias("x")), "x") == ["Privatelabel", "Retail", None]


def test_sanitize_name_rules(spark):
    rows = [("My Space  Name",), ("a.b/c",), ("__x--y__",), ("@@@",), ("ok-name",)]
    df = spark.createDataFrame(rows, "n string")
    got = _one(df.select(C.sanitize_name("n").alias("x")), "x")
    assert got == ["My_Space_Name", "a_b_c", "x_y", "knowledge_assistant", "ok-name"]


def test_path_leaf_name(spark):
    rows = [("/data/shared/docs/my docs/",), ("/a/b/file.v1",), ("plain",)]
    df = spark.createDataFrame(rows, "p string")
    assert _one(df.select(C.path_leaf_name("p").alias("x")), "x") == ["my_docs", "file_v1", "plain"]


def test_stable_round_buckets(spark):
    df = spark.createDataFrame([(1.00005,), (2.5,), (-0.125,), (0.126,)], "x double")
    got = _one(df.select(C.stable_round("x", 2).alias("r")), "r")
    assert got == [1.0, 2.5, -0.13, 0.12]       # exact values stay exact; edges sit at .xx618
