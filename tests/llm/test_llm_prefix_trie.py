"""Prefix trie against a plain recursion over all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from plantlens.llm.prefix_trie import conversation_paths, rebuilt_trie, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows, block, modulus):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, own in convs.items():
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % modulus
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(rows, block=100, modulus=6):
    seqs = sequences(rows, block, modulus)
    members = {}
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(node, [])]
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + own)
    out = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(seqs[c]) == len(node))))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids.get(node, [])),
                    *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made_rows(seed=3, convs=160):
    rng = random.Random(seed)
    words = ["hi", "what is it", "naïve 😀 text", "", "ok", "more of it"]
    rows = []
    for c in rng.sample(range(520), convs):
        for t in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(words[: 2 + t])))
    same = [(t, "user", f"same {t}") for t in range(40)]
    for c in range(1000, 1030):                                   # long copies, some cut short
        rows += [(c, *x) for x in same[: 40 if c % 3 else 25]]
    rows += [(100_000, None, None, "first"), (100_000, -5, "user", None), (100_000, 7, None, None), (100_001, 1, "a", "b"),
             (100_001, 1, "a", "b"), (None, 1, "x", "y"), (None, None, None, None), (-150, 0, "user", "neg"), (-100, 0, "user", "base"),
             (-100, 1, "user", "base 2"), (-7, 3, "u", "v")]
    return rows


@pytest.mark.parametrize("group,hot", [(256, 100_000), (4, 100_000), (1, 100_000), (1, 10)])
def test_equals_plain_recursion(spark, group, hot):
    rows = made_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert plain(trie(conversation_paths(docs, 100, 6), group, hot)) == brute(rows)


def test_conversations_as_they_are(spark):
    rows = made_rows(9, 60)
    assert plain(trie(conversation_paths(spark.createDataFrame(rows, SCHEMA)), 8)) == brute(rows, 1, 1)


def test_chunks_of_a_shared_end(spark, monkeypatch):
    """The ids of one sequence, packed in many chunks and dealt over tasks."""
    from plantlens.llm import prefix_trie

    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    rows = [(c * 100, 0, "user", "same") for c in range(400)] + [(c * 100, 1, "user", "more") for c in range(0, 400, 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert plain(rebuilt_trie(docs)) == brute(rows)


def test_small_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/conversations.parquet")
    assert plain(rebuilt_trie(docs)) == brute([tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()])


def test_empty_and_extra_columns(spark):
    from pyspark.sql import functions as F

    empty = rebuilt_trie(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    rows = made_rows(4, 20)
    wide = spark.createDataFrame(rows, SCHEMA)
    for name in ("base", "digest", "chars", "path", "n", "last", "hot", "key", "node"):
        wide = wide.withColumn(name, F.lit("z"))
    wide = wide.withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    assert plain(rebuilt_trie(wide)) == brute(rows)


def test_turnless_conversations(spark):
    """A conversation whose head conversation is missing may have no turns."""
    rows = [(c, 0, "user", "x") for c in range(101, 140)]
    found = plain(rebuilt_trie(spark.createDataFrame(rows, SCHEMA)))
    assert found == brute(rows) and any(r[1] == 0 and r[-1] != hashlib.sha256(b"").hexdigest() for r in found)
