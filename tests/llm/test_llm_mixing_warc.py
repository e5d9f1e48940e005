"""Mixing and web archives against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from llm_fixtures import awkward_rows, documents
from pyspark.sql import functions as F

from plantlens.llm import mixing, warc


def brute_targets(sizes):
    """sizes: by source; the cap-and-reshare loop, as the contract words it."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    left = float(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in full]
        w = sum(weight[s] for s in open_)
        for s in open_:
            target[s] = left * weight[s] / w
        over = [s for s in open_ if target[s] > 3 * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            full.add(s)


def test_mix_follows_targets(spark):
    rows = awkward_rows()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    by = {}
    for r, n in zip(rows, size):
        by[r[3]] = by.get(r[3], 0) + n
    expected = brute_targets(by)
    got = mixing.mixed_sizes(documents(spark)).collect()
    assert sorted(x.size for x in got) == sorted(size)
    source = {(r[0], n): r[3] for r, n in zip(rows, size)}
    taken = {}
    for x in got:
        s = source[x.doc_id, x.size]
        assert x.source_size == by[s] and abs(x.target - expected[s]) < 1e-6 * max(1, expected[s])
        assert x.taken <= 3 * x.size and x.taken == x.copies * x.size
        taken[s] = taken.get(s, 0) + x.taken
    for s, t in expected.items():
        assert abs(taken.get(s, 0) - t) <= 15 or s in ("s3", None), (s, t, taken.get(s))
    again = mixing.mixed_sizes(documents(spark).repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_mixed_rows_are_the_taken_copies(spark):
    docs = documents(spark)
    copies = {}
    for x in mixing.mixed_sizes(docs, 4).collect():
        copies[x.doc_id] = copies.get(x.doc_id, 0) + x.copies
    out = mixing.mixed_documents(docs, 4)
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in copies.items() if v}


def test_rows_without_an_id_or_of_one_id_are_decided_each(spark):
    """Half of a source's rows have no id or one id, some are equal rows."""
    rows = []
    for k in range(400):
        rows.append((k + 10, f"a{k} b c d e", "en", "p", 0))
        rows.append((None if k % 4 else 1, f"x{k % 300} b c d e", "en", "p", 0))
        rows += [(10_000 + 3 * k + j, f"q{k} {j} r", "en", "q", 0) for j in range(2)]
    docs = documents(spark, rows)
    got = mixing.mixed_sizes(docs, 4).collect()
    assert len(got) == len(rows)
    p = [x for x in got if x.source_size == 4000]
    assert 0.2 < p[0].target / 4000 < 0.9
    assert abs(sum(x.taken for x in p) - p[0].target) <= 5
    assert 0 < sum(x.copies for x in p if x.doc_id is None) < 300
    copies = {}
    for x in got:
        copies[x.doc_id] = copies.get(x.doc_id, 0) + x.copies
    out = mixing.mixed_documents(docs, 4)
    mixed = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert mixed == {k: v for k, v in copies.items() if v}


def test_quotas_are_split_exactly(spark):
    quotas = {"a": 1000, "b": 37, "c": 0, "d": 1}
    df = spark.createDataFrame([(k, False, v) for k, v in quotas.items()], "name string, no_name boolean, quota long")
    rows = mixing.split_quotas(df, 7).collect()
    total = sum(quotas.values())
    for k, v in quotas.items():
        own = sorted((r.shard, r.first, r["count"]) for r in rows if r.name == k)
        assert sum(c for _, _, c in own) == v
        assert [f for _, f, _ in own] == [sum(c for _, _, c in own[:i]) for i in range(len(own))]
    shard = [sum(r["count"] for r in rows if r.shard == i) for i in range(7)]
    assert sum(shard) == total and max(shard) - min(shard) <= 3


def test_hypergeometric_draw_has_the_right_distribution(spark):
    total, marked, drawn = 60, 25, 20
    u = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    x = mixing._hypergeometric(F.lit(total).cast("long"), F.lit(marked).cast("long"), F.lit(drawn).cast("long"), F.col("u"))
    got = np.array([r[0] for r in u.select(x).collect()])
    from math import comb

    p = np.array([comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn) for k in range(drawn + 1)])
    assert np.abs(np.bincount(got, minlength=drawn + 1)[: drawn + 1] / 4000 - p).max() < 1e-3


def pages(spark):
    same, small = "<p>" + "same " * 60 + "</p>", "tiny"
    rows = [(i, f"http://x/{i}", f"<html>{i} " + "body " * (i % 50) + "</html>") for i in range(300)]
    rows += [(500 + i, f"http://y/{i}", same) for i in range(40)] + [(600 + i, None, small) for i in range(5)]
    rows += [(700, "u\r\nX: y", None), (701, "", ""), (None, "n", same), (702, "é", "é" * 49), (703, "é", "é" * 50), (704, "é", "é" * 50),
             (705, "v", "a\r\n\r\nb" * 30)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), rows


def test_archive_round_trip(spark):
    df, rows = pages(spark)
    raw = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for p, b in raw:
        if p is not None and len(b) >= 100:
            first[b] = min(first.get(b, p), p)
    expected = []
    for p, b in raw:
        r = first.get(b)
        revisit = r is not None and p != r
        expected.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", r if revisit else None))
    got = [tuple(r) for r in warc.archive(df).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_archive_format(spark, tmp_path):
    import zstandard

    df, _ = pages(spark)
    manifest = warc.write_archives(df, str(tmp_path)).collect()
    assert sum(r.n_records for r in manifest) == df.count()
    raw = open(max(manifest, key=lambda r: r.n_records).path, "rb").read()
    magic, size = warc.HEADER.unpack(raw[:8])
    assert magic == warc.SKIPPABLE_MAGIC
    body = raw[8 + size:]
    assert body[:4] == warc.FRAME_MAGIC
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8: 8 + size]))
    assert d.decompressobj().decompress(body).startswith(b"WARC/1.1\r\n")


def test_damaged_payload_is_found():
    import pytest

    ok = warc.record(1, "u", b"abc", 3, hashlib.sha256(b"abc").hexdigest(), None)
    assert warc.parse(ok)[:2] == (1, 3)
    with pytest.raises(ValueError):
        warc.parse(ok.replace(b"abc", b"abd"))
