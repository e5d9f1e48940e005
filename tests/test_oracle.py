"""Every registered query against its DuckDB oracle on sf0.001, plus the
"""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from plantlens.plans.registry import load_all
from scripts.check_oracle import TABLES, canon

ALL = E.queries()
QUERIES = {k: ALL[k] for k in load_all()}
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, small_dir, key):
    df = QUERIES[key](spark, small_dir)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[key])
    sc, sr = canon(df.columns, rows)
    dc, dr = canon(rel.columns, rel.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "hours_under_quality" in df.columns


def test_colour_shares_sum_to_one(spark, small_dir):
    from plantlens.plans.layers import from_test_tables

    e = from_test_tables(spark, small_dir).events()
    tot = sum(F.col(f"fry_color_{i}_share") for i in range(5))
    counts = sum(F.col(f"usda_color_{i}") for i in range(5))
    bad = e.filter((counts > 0) & (F.abs(tot - 1.0) > 1e-9)).count()
    zero = e.filter((counts == 0) & (tot != 0)).count()
    assert bad == 0 and zero == 0


def test_price_intervals_disjoint(spark, small_dir):
    from plantlens.operators.joins import interval_days, price_intervals
    from plantlens.plans.layers import from_test_tables

    days = interval_days(price_intervals(from_test_tables(spark, small_dir).costs(), "2025-12-31"))
    dup = days.groupBy("region", "variety", "dm_band", "date").count().filter("count > 1").count()
    assert dup == 0


def test_result_independent_of_partitioning(spark, small_dir):
    key = "g14_cost_exposure"
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(tuple(r) for r in QUERIES[key](spark, small_dir).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = sorted(tuple(r) for r in QUERIES[key](spark, small_dir).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_exposure_pre_aggregation_gives_the_same_table(spark, small_dir):
    from plantlens.plans import gold
    from plantlens.plans.layers import from_test_tables
    from plantlens.plans.registry import finish

    p = from_test_tables(spark, small_dir)
    digits = {"tons_processed": 6, "avg_dry_matter_pct": 6, "raw_potato_spend_usd": 2,
              "over_quality_waste_usd": 2, "downgrade_rework_exposure_usd": 2}
    a = finish(gold.cost_exposure(p.loads(), p.costs(), p.specs()), digits)
    b = finish(gold.cost_exposure(p.loads(), p.costs(), p.specs(), pre_aggregate=True), digits)
    assert sorted(a.collect()) == sorted(b.collect())


def test_layers_plan_options_give_the_same_tables(spark, small_dir):
    """No broadcast hints + salting + pre-aggregation: other plans, same rows."""
    from plantlens.plans.layers import Layers, from_test_tables
    from plantlens.plans.registry import finish

    base = from_test_tables(spark, small_dir)
    alt = Layers(spark, base.raw, base.as_of, salt_buckets=4, pre_aggregate=True)
    digits = {"tons_processed": 6, "avg_dry_matter_pct": 6, "raw_potato_spend_usd": 2,
              "over_quality_waste_usd": 2, "downgrade_rework_exposure_usd": 2}
    assert sorted(finish(base.exposure(), digits).collect()) == sorted(finish(alt.exposure(), digits).collect())
    cols = ["date", "hour", "plant_name", "plant_line", "downtime_cat_1", "downtime_cat_2", "oee_event_count"]
    assert sorted(base.alignment().select(*cols).collect()) == sorted(alt.alignment().select(*cols).collect())


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith("t")))
def test_no_cross_or_nested_loop_joins(spark, small_dir, key):
    """Plan lint: no registered query pairs rows without an equi-key."""
    plan = QUERIES[key](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith("t")))
def test_column_types_match_the_oracle(spark, con, small_dir, key):
    """The check projection and the oracle agree on every column's type."""
    schema = QUERIES[key](spark, small_dir).schema
    rel = con.sql(f"SELECT * FROM ({ORACLES[key]}) LIMIT 0")
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in schema.fields:
        s = f.dataType.simpleString()
        assert duck.get(f.name) == SPARK_TO_DUCK.get(s, s.upper()), (f.name, s, duck.get(f.name))
