"""Registered queries: oracles on the small tables, the pipeline, the guard."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

import corpus_pipeline
from plantlens.llm.common import pinned
from plantlens.llm.registry import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracles(spark, small_dir, key):
    df = QUERIES[key](spark, small_dir)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    cur = con.execute(ORACLES[key])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == want


def test_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, small_dir):
    """Each stage on what the stage before kept, against the operators' own
    (brute-force tested) decisions; the result against the stages."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = pinned(stage(spark, seen, small_dir))          # nothing stays cached in the shared session
        assert out.columns == columns and 0 < out.count()
        if name != "mixing":
            assert out.count() <= seen.count() and out.exceptAll(seen).count() == 0, name
        else:
            assert out.join(seen.select("doc_id"), "doc_id", "left_anti").count() == 0
        seen = out
    direct = corpus_pipeline.STAGES[-1][1](spark, seen, small_dir)
    run = corpus_pipeline.run(spark, small_dir)
    cols = ["doc_id", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, run.select(cols).collect())) == sorted(map(tuple, direct.select(cols).collect()))
    assert run.count() == seen.count()


def test_entry_point_without_this_subpackage(tmp_path):
    """The entry module imports and lists its other queries when the folder and
    the pipeline are gone."""
    for name in os.listdir(ROOT):
        if name not in ("corpus_pipeline.py", "plantlens", ".git"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "plantlens")
    for name in os.listdir(f"{ROOT}/plantlens"):
        if name != "llm":
            os.symlink(f"{ROOT}/plantlens/{name}", tmp_path / "plantlens" / name)
    os.unlink(tmp_path / "__spark_entry__.py")
    with open(f"{ROOT}/__spark_entry__.py") as src, open(tmp_path / "__spark_entry__.py", "w") as out:
        out.write(src.read())
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env=os.environ | {"PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"})
    assert done.returncode == 0, done.stderr
    n, has = done.stdout.split()
    assert int(n) > 50 and has == "False"
