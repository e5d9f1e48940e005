"""The pipeline against a version without Spark or the operators' code.

Every stage is recomputed from its own input: SimHash groups by comparing all
fingerprints, contamination by the items' shingle sets, the mix by the SQL
oracle in DuckDB, token files by the tokenizers library.  Toxicity is a trained
model; its stage is held against the scores of the operator's query.
"""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash

import corpus_pipeline
from plantlens.llm import mixing, toxicity
from plantlens.llm.common import pinned


def fingerprint(text):
    words = regex.findall(rb"[^\x20\x09-\x0d]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    bits = np.unpackbits(np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int("".join("1" if 2 * n > len(grams) else "0" for n in bits.sum(0)), 2)


def groups(fps):
    """The smallest fingerprint that each reaches over steps of at most 4 bits."""
    left, root = set(fps), {}
    for start in sorted(left):
        if start in root:
            continue
        reach = [start]
        root[start] = start
        while reach:
            here = reach.pop()
            for other in [f for f in left if f not in root and (f ^ here).bit_count() <= 4]:
                root[other] = start
                reach.append(other)
    return root


def grams_of(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)}


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    """(name, input rows, output rows) of the first four stages, and the result."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out, seen = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = pinned(stage(spark, seen, small_dir))
        out.append((name, [tuple(r) for r in seen.collect()], [tuple(r) for r in after.collect()]))
        seen = after
    return out, [r.asDict() for r in corpus_pipeline.STAGES[-1][1](spark, seen, small_dir).collect()]


def test_toxicity_stage(spark, small_dir, stages):
    name, before, after = stages[0][0]
    docs, labels = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels"))
    mild = {r.doc_id for r in toxicity.scores(docs, labels).filter("predicted = 0").collect()}
    assert name == "toxicity" and sorted(after) == sorted(r for r in before if r[0] in mild)


def test_simhash_stage(stages):
    name, before, after = stages[0][1]
    fps = {r[0]: fingerprint(r[1]) for r in before}
    root = groups(set(fps.values()))
    least = {}
    for doc_id, f in fps.items():
        least[root[f]] = min(least.get(root[f], doc_id), doc_id)
    assert name == "simhash_dedup"
    assert sorted(after) == sorted(r for r in before if least[root[fps[r[0]]]] == r[0])
    assert len(after) < len(before)


def test_decontamination_stage(spark, small_dir, stages):
    name, before, after = stages[0][2]
    items = [grams_of(r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert all(items)                                    # none is below five words here

    def clean(text):
        held = grams_of(text)
        return not any(len(x & held) >= 0.8 * len(x) - 1e-9 for x in items)

    assert name == "decontamination" and sorted(after) == sorted(r for r in before if clean(r[1]))
    assert len(after) < len(before)


def test_mixing_stage(stages):
    name, before, after = stages[0][3]
    con = duckdb.connect()
    columns = list(zip(*before))
    con.register("documents", pa.table({"doc_id": columns[0], "text": pa.array(columns[1], pa.string()), "source": pa.array(columns[3], pa.string())}))
    copies = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, copies FROM ({mixing.ORACLE})").fetchall()}
    rows = {r[0]: r for r in before}
    assert name == "mixing" and Counter(after) == Counter({rows[d]: n for d, n in copies.items() if n})


def test_token_stage_and_the_run(spark, small_dir, stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, start = [], 0
    for r in sorted(stages[0][3][2], key=lambda r: r[0]):
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        rows.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in stages[1])
    assert got == sorted(rows)
    again = corpus_pipeline.run(spark, small_dir).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in again) == sorted(rows)
