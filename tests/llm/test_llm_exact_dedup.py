"""Exact dedup: brute force over batches, retries, repeated rows, the plan."""

from __future__ import annotations

import hashlib

import pytest
from llm_fixtures import awkward_rows, documents
from pyspark.sql import functions as F

from plantlens.llm.common import shared_folder
from plantlens.llm.exact_dedup import DigestIndex, exact_groups

BLANKS = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def bare(text):
    return (text or "").translate(BLANKS)


def rows_with_copies():
    rows = awkward_rows()
    base = rows[0][1]
    rows += [(3000 + i, base.replace(" ", " " * (i % 3 + 1)), "en", "s0", None) for i in range(7)]
    rows += [(4000, "a b", "en", "s0", 3), (4001, "ab", "en", "s0", 2), (4002, " a b ", None, None, 5), (4003, "a  b ", None, None, 5),
             (None, "a b  ", "de", "s1", 5)]
    return rows


def brute(rows, batch, entries):
    """(doc_id, keep_id, size, kept, sha) of a batch, given earlier entries."""
    groups = {}
    for r in rows:
        groups.setdefault(bare(r[1]), []).append(r)
    out = []
    for key, same in groups.items():
        best = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        own = entries.setdefault(key, (best[0], best[1], batch))
        for r in same:
            kept = own[2] == batch and r[0] == own[0] and (r[1] or "") == (own[1] or "")
            out.append((r[0], own[0], len(same), kept, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = rows_with_copies()
    assert plain(exact_groups(documents(spark, rows))) == brute(rows, "documents", {})


def test_batches_append_and_retry(spark):
    rows = rows_with_copies()
    parts = [rows[0::3], rows[1::3] + rows[:4], rows[2::3]]
    folder, entries, answers = shared_folder(spark, "test-index"), {}, []
    for i, part in enumerate(parts):
        index = DigestIndex(spark, folder, 5)                # opened anew each time
        answers.append(plain(index.ingest(documents(spark, part), f"b{i}")))
        assert answers[-1] == brute(part, f"b{i}", entries)
        assert index.entries().count() == index.entries().select("digest").distinct().count() == len(entries)
    index = DigestIndex(spark, folder, 99)                   # the folder's own number of buckets counts
    assert index.buckets == 5
    assert plain(index.ingest(documents(spark, parts[1]), "b1")) == answers[1]      # a retry changes nothing
    assert index.entries().count() == len(entries)
    again = plain(index.ingest(documents(spark, parts[1]), "other"))
    assert not any(r[3] for r in again)
    copy = index.copy_to(shared_folder(spark, "test-index"), 3)
    assert plain(copy.entries()) == plain(index.entries())
    assert plain(copy.ingest(documents(spark, parts[2]), "b2")) == answers[2]


def test_dedup_keeps_all_columns_and_one_of_each(spark):
    rows = rows_with_copies()
    rows += [rows[5]] * 4 + [(None, None, None, None, None)] * 3
    docs = documents(spark, rows).withColumn("keep_id", F.lit("x")).withColumn("digest", F.create_map(F.lit(1), F.lit(2))).withColumn(
        "row", F.lit(1)).withColumn("size", F.lit(2)).withColumn("batch", F.lit(3)).withColumn("doc_id_of_group", F.lit(4))
    out = DigestIndex(spark, shared_folder(spark, "test-index"), 4).dedup(docs, "b")
    assert out.columns == docs.columns
    found = [(r.doc_id, r.text) for r in out.collect()]
    assert len(found) == len({bare(t) for _, t in found}) == len({bare(r[1]) for r in rows})
    best = {}
    for r in rows:
        best[bare(r[1])] = min(best.get(bare(r[1]), (1, True, 0)), (-len(r[1] or ""), r[0] is None, r[0] or 0))
    assert {bare(t): (-len(t or ""), d is None, d or 0) for d, t in found} == best


def test_heavy_groups(spark, monkeypatch):
    """The broadcast branch and the shuffled one give the same rows."""
    from plantlens.llm import common

    rows = rows_with_copies() + [(9000 + i, "copy of all", None, None, None) for i in range(300)]
    docs = documents(spark, rows)
    want = brute(rows, "documents", {})
    assert plain(exact_groups(docs)) == want
    monkeypatch.setattr(common, "LIGHT_ROWS", 2)
    monkeypatch.setattr(common, "HEAVY_GROUPS", 200)
    assert plain(exact_groups(docs)) == want


def test_anti_join_reads_the_index_by_buckets(spark):
    index = DigestIndex(spark, shared_folder(spark, "test-index"), 6)
    docs = documents(spark)
    index.ingest(docs, "a")
    from plantlens.llm.exact_dedup import digests, groups

    plan = index.unknown(groups(digests(docs)))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "BatchEvalPython" not in plan
    scan = next(x for x in plan.splitlines() if index.name in x)
    assert "Bucketed: true" in scan or "SelectedBucketsCount: 6" in scan


@pytest.mark.parametrize("text", [None, "", " \t\r\n"])
def test_empty_texts_are_equal(spark, text):
    rows = [(1, text, None, None, None), (2, "", None, None, None), (3, "x", None, None, None)]
    found = {r[0]: r[1:4] for r in plain(exact_groups(documents(spark, rows)))}
    assert found[2][:2] == (1, 2) and found[1][2] and not found[2][2] and found[3] == (3, 1, True)
