"""The check projection buckets doubles the same way in Spark and DuckDB."""

from __future__ import annotations

import random

import duckdb
from pyspark.sql import functions as F

from plantlens.functions.columns import ROUND_OFFSET, stable_round


def test_stable_round_identical_in_both_engines(spark):
    rnd = random.Random(3)
    vals = ([rnd.uniform(-1e9, 1e9) for _ in range(3000)] + [rnd.uniform(-50, 50) for _ in range(3000)]
            + [round(rnd.uniform(0, 100), k) for k in range(1, 9) for _ in range(300)]
            + [k / 2 ** e for k in range(-50, 50) for e in range(1, 8)])
    rows = [(i, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "i int, x double")
    for digits in (2, 6):
        got = {r.i: r.y for r in df.select("i", stable_round(F.col("x"), digits).alias("y")).collect()}
        con = duckdb.connect()
        con.execute("CREATE TABLE t(i INTEGER, x DOUBLE)")
        con.executemany("INSERT INTO t VALUES (?, ?)", rows)
        scale = 10 ** digits
        want = dict(con.execute(f"SELECT i, floor(x * {scale}.0 + {ROUND_OFFSET!r}) / {scale}.0 FROM t").fetchall())
        assert got == want
