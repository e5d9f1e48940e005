"""Cross-tokenizer alignment against whole-text encoding and all token pairs."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import awkward_rows, documents, plain, with_extra

from plantlens.llm import alignment
from plantlens.llm.alignment import Aligner, aligned, alignments, gallop, vocabularies


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = vocabularies()
    t = Tokenizer.from_file(a)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=b)


def spelt_a(tokenizer, ids):
    """Bytes of byte-level tokens: printable characters stand for themselves."""
    plain_bytes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain_bytes]
    back = {chr(b): b for b in plain_bytes}
    back.update({chr(256 + k): b for k, b in enumerate(others)})
    return [bytes(back[c] for c in tokenizer.id_to_token(i)) for i in ids]


def spelt_b(model, ids):
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in ids]


def tokens(tokenizers, text):
    """((id, start, stop) of A, of B), or two empty lists."""
    t, m = tokenizers
    if not text:
        return [], []
    a, b = t.encode(" " + text, add_special_tokens=False).ids, m.encode(text)
    out = []
    for ids, parts in ((a, spelt_a(t, a)), (b, spelt_b(m, b))):
        if b"".join(parts) != (" " + text).encode():
            return [], []
        ends = np.cumsum([len(p) for p in parts]).tolist()
        out.append([(i, e - len(p), e) for i, p, e in zip(ids, parts, ends)])
    return out[0], out[1]


def one(tokenizers, text):
    a, b = tokens(tokenizers, text)
    links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else swept(a, b)
    common = sorted({x[2] for x in a} & {y[2] for y in b})
    groups, start = [], 0
    for c in common:
        groups.append(([x[0] for x in a if start < x[2] <= c], [y[0] for y in b if start < y[2] <= c]))
        start = c
    return a, b, links, groups


def swept(a, b):
    """Links of a long text, token by token."""
    owner_a = [x[0] for x in a for _ in range(x[2] - x[1])]
    place_a = [i for i, x in enumerate(a) for _ in range(x[2] - x[1])]
    found = {(place_a[k], j) for j, y in enumerate(b) for k in range(y[1], y[2])}
    assert len(owner_a) == len(place_a)
    return [(a[i][0], b[j][0]) for i, j in found]


def brute(tokenizers, rows):
    each = [(r[0], *one(tokenizers, r[1])) for r in rows]
    docs_of = Counter(p for _, _, _, links, _ in each for p in set(links))
    most = {}
    for (x, _), n in docs_of.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for doc_id, a, b, links, groups in each:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(docs_of[p] == most[p[0]] for p in links),
                    sum(docs_of[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


ODD = ["x", " ", "  ", "   a", "a ", "a  b", "a\n b", "a\n  b", "a \n b", " \n", "\t", "　x y　 z", "a\xa0b \xa0c", "x\x1c y \x1cz",
       "<|endoftext|> a<|endoftext|>", "<s>x</s> <unk> <0x41>", "naïve café", "é", "日本語のテキスト と 한국어", "a ▁b", "▁", "😀 👨‍👩‍👧 ok",
       "don't 's 'll we'll", "12 345 6789", "\x00 \x01", "a\r\nb\r\n", "\u0085 x\u0085y", "word" * 300, "a " * 200, " " * 40 + "x" + " " * 17]


def test_fuzzed_texts(spark, tokenizers):
    rng = random.Random(11)
    bits = ["a", "the", "don't", " ", " ", " ", "  ", "\n", "\t", "é", "日本", "😀", "\xa0", "　", "!", "...", "7", "42", "ß", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(400)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert plain(aligned(documents(spark, rows))) == brute(tokenizers, rows)


def test_fixture_rows_and_both_ways_of_scoring(spark, tokenizers):
    rows = awkward_rows(n=25)
    want = brute(tokenizers, rows)
    assert plain(aligned(documents(spark, rows))) == want
    assert plain(aligned(documents(spark, rows), broadcast_pairs=0)) == want
    assert plain(aligned(with_extra(documents(spark, rows)))) == want


def test_small_steps_give_the_same(spark, tokenizers, monkeypatch):
    """Tiny chunks, segments and memories: every flush is passed."""
    rows = awkward_rows(seed=8, n=12)
    for name, value in (("CHUNK", 500), ("SEGMENT", 50), ("REMEMBERED", 100), ("HELD_PAIRS", 300)):
        monkeypatch.setattr(alignment, name, value)
    al = Aligner(*vocabularies())
    texts = pa.array([r[1] for r in rows])
    slots, ends = al.units(texts)
    text, code, times = al.histograms(slots, ends)
    monkeypatch.setattr(alignment, "SEGMENT", 1 << 20)
    whole = al.histograms(slots, ends)
    assert all((x == y).all() for x, y in zip((text, code, times), whole))
    assert plain(aligned(documents(spark, rows))) == brute(tokenizers, rows)


def test_slices_of_an_array(tokenizers):
    """Texts that lie inside a larger Arrow buffer."""
    al = Aligner(*vocabularies())
    texts = pa.array([r[1] for r in awkward_rows(seed=4, n=40)] + ["", None, "a  b"] * 5)
    for s in range(0, len(texts), 7):
        part = texts.slice(s, 7)
        slots, ends = al.units(part)
        again, same = al.units(pa.array(part.to_pylist(), pa.string()))
        assert (slots == again).all() and (ends == same).all()
        raw = [b"".join(al.bytes_a[i] for i in al.ids_a.take(slots[a:b])) for a, b in zip([0, *ends], ends)]
        assert raw == [(" " + t).encode() if t else b"" for t in part.to_pylist()]


def test_gallop_is_a_lower_bound():
    rng = np.random.default_rng(2)
    for _ in range(200):
        ends = np.unique(rng.integers(1, 400, rng.integers(1, 200)))
        first = rng.integers(0, len(ends), 30)
        x = rng.integers(0, ends[-1] + 1, 30)
        found = gallop(x, first, np.full(30, len(ends)), ends)
        assert (found == np.maximum(np.searchsorted(ends, x), first)).all()


def test_groups_spell_the_text(spark, tokenizers):
    rows = awkward_rows(n=8)
    t, m = tokenizers
    for doc_id, text, groups in alignments(documents(spark, rows)).join(
            documents(spark, rows).select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").select("doc_id", "text", "groups").collect():
        raw = (" " + (text or "")).encode()
        if not text:
            assert groups == []
            continue
        assert groups[0].start == 0 and groups[-1].stop == len(raw)
        for g, after in zip(groups, groups[1:]):
            assert g.stop == after.start
        for g in groups:
            assert b"".join(spelt_a(t, g.a)) == b"".join(spelt_b(m, g.b)) == raw[g.start: g.stop]


def test_empty_table(spark):
    from llm_fixtures import DOC_SCHEMA

    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert aligned(empty).count() == 0 and aligned(empty, broadcast_pairs=-1).count() == 0
