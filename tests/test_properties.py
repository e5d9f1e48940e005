"""Property tests (hypothesis) for the name rule (X9) and the dry-matter bands."""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plantlens.functions import columns as C

BANDS = ["<=21%", "21-22%", "22-23%", ">=23%"]


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30), min_size=200, max_size=200))
def test_sanitized_names_are_well_formed(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    once = [r.x for r in df.select(C.sanitize_name("n").alias("x")).collect()]
    again = [r.x for r in spark.createDataFrame([(n,) for n in once], "n string")
             .select(C.sanitize_name("n").alias("x")).collect()]
    for out in once:
        assert out and re.fullmatch(r"[A-Za-z0-9_-]+", out)
        assert not re.search(r"[_-]{2,}", out)
        assert out[0] not in "_-" and out[-1] not in "_-"
    assert again == once                                   # idempotent


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(min_value=15, max_value=30, allow_nan=False), min_size=300, max_size=300))
def test_bands_are_monotonic(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "dm double")
    rows = sorted((r.dm, r.b) for r in df.select("dm", C.dm_band("dm").alias("b")).collect())
    idx = [BANDS.index(b) for _, b in rows]
    assert idx == sorted(idx)                              # higher dry matter never falls in a lower band
    for dm, b in rows:
        assert (b == ">=23%") == (dm >= 23.0) and (b == "<=21%") == (dm <= 21.0)
