"""Quartile bucket digests: fuzzy fingerprints of whole texts.

All byte triplets (three shapes in a sliding window of four bytes) of the UTF-8
text are hashed into ``BUCKETS`` counters.  Each counter becomes two bits: the
quartile of the text's own counters that it falls in.  The header holds the
text's length on a logarithmic scale and the ratios of the quartiles.  Two
digests differ by a bounded score: counter steps (opposite ends count double),
length steps and ratio steps, each capped; likeness is one minus the score over
its bound, where the bound is the score expected of unrelated texts.

A null text is the empty text, whose counters are all zero.  Equal texts have
equal digests; any text, however short, has one.

``neighbours`` also digests every text edited by its neighbour in falling id
order.  Ids are cut into ranges; the first document of the next lower range is
dealt to a range as well (the cuts are ids of documents, so these rows are known
before any shuffle), and a task streams its sorted range.  Rows with a null id
come last in that order; rows of equal id are ordered by their text.  In a table
of one row the row is its own next.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import batch, byte_chunks, id_cuts, range_of, ship_package, split_count

BUCKETS = 256
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))               # byte places of a triplet in the window
LENGTH_BASE = 1.1
MIX = 0x9E3779B1
# Mean of the steps 0, 1, 2 and 6 (for 3) between two random quartiles.
UNRELATED = BUCKETS * 1.625
LENGTH_STEP, LENGTH_CAP = 4, 120
RATIO_STEP, RATIO_CAP = 4, 60
CHUNK = 1 << 20


def digests(texts: list[bytes]) -> np.ndarray:
    """One row per text: BUCKETS quartile codes, the length code, two ratios."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    for s, e in byte_chunks(sizes, CHUNK):
        raw = np.frombuffer(b"".join(texts[s:e]), np.uint8).astype(np.uint32)
        owner = np.repeat(np.arange(e - s, dtype=np.int64), sizes[s:e])
        for number, shape in enumerate(SHAPES):
            width = shape[-1]
            n = len(raw) - width
            if n < 1:
                continue
            h = raw[shape[0]: shape[0] + n] | raw[shape[1]: shape[1] + n] << 8 | raw[shape[2]: shape[2] + n] << 16
            h = (h ^ np.uint32(number << 24)) * np.uint32(MIX)
            h = (h ^ h >> 15) * np.uint32(0x85EBCA77)
            bucket = (h >> 24).astype(np.int64)
            inside = owner[:n] == owner[width: width + n]        # no triplet across two texts
            flat = (owner[:n] * BUCKETS + bucket)[inside]
            counts[s:e] += np.bincount(flat, minlength=(e - s) * BUCKETS).reshape(-1, BUCKETS)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    out = np.empty((len(texts), BUCKETS + 3), np.int64)
    out[:, :BUCKETS] = (counts > q1).astype(np.int64) + (counts > q2) + (counts > q3)
    out[:, BUCKETS] = np.minimum(np.floor(np.log(np.maximum(sizes, 1)) / np.log(LENGTH_BASE) + 1e-9), 255) * (sizes > 0)
    top = np.maximum(q3, 1)
    out[:, BUCKETS + 1] = (q1 * 15 // top)[:, 0]
    out[:, BUCKETS + 2] = (q2 * 15 // top)[:, 0]
    return out


def as_hex(rows: np.ndarray) -> list[str]:
    """Header bytes, then four quartile codes to a byte."""
    codes = rows[:, :BUCKETS].reshape(len(rows), -1, 4)
    body = (codes * np.array([1, 4, 16, 64])).sum(2).astype(np.uint8)
    head = np.stack([rows[:, BUCKETS], rows[:, BUCKETS + 1] << 4 | rows[:, BUCKETS + 2]], 1).astype(np.uint8)
    return [bytes(r).hex() for r in np.concatenate([head, body], 1)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 (as unlike as chance, or more) to 1 (equal) of paired digests."""
    step = np.abs(a - b)
    body = step[:, :BUCKETS]
    score = (body + 3 * (body == 3)).sum(1)
    score = score + np.minimum(np.maximum(step[:, BUCKETS] - 1, 0) * LENGTH_STEP, LENGTH_CAP)
    score = score + np.minimum(step[:, BUCKETS + 1:].sum(1) * RATIO_STEP, RATIO_CAP)
    return np.maximum(0.0, 1 - score / UNRELATED)


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by the start of ``after``."""
    k = len(text) // 2
    return text[: len(text) - k] + after[:k]


COLUMNS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _rows(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
    """Result rows of all but the last text, each next to its follower."""
    changed = [edited(t, after) for t, after in zip(texts, texts[1:])]
    raw = [t.encode() for t in texts]
    raw_changed = [t.encode() for t in changed]
    own, new = digests(raw), digests(raw_changed)
    return batch(COLUMNS, ids[: len(changed)], [len(t) for t in texts[:-1]],
                 [hashlib.sha256(t).hexdigest() for t in raw_changed], as_hex(own[:-1]), as_hex(new),
                 likeness(own[:-1], new), likeness(own[:-1], own[1:]))


def neighbours(docs: DataFrame) -> DataFrame:
    """Digest of every text and of the text edited by its neighbour."""
    ship_package(docs.sparkSession)
    cuts = id_cuts(docs, "doc_id", split_count(docs.sparkSession))
    doc_id = F.col("doc_id").cast("long")
    ends = docs.agg(F.max(doc_id).alias("top"), F.count(F.when(doc_id.isNull(), 1)).alias("nulls")).first()
    range_no = range_of(doc_id, cuts)
    part = F.when(doc_id.isNull(), 0).otherwise(range_no + 1)
    lowest = 0 if ends.nulls else 1
    # a cut is the highest id of its range, so the next range's last document follows on to it;
    # the row that opens the whole order closes it
    copies = [F.struct(part.alias("part"), F.lit(False).alias("halo"))]
    if cuts:
        copies.append(F.when(F.get(F.lit(cuts), range_no) == doc_id, F.struct((part + 1).alias("part"), F.lit(True).alias("halo"))))
    if ends.top is not None:
        copies.append(F.when(doc_id == ends.top, F.struct(F.lit(lowest).alias("part"), F.lit(True).alias("halo"))))
    if ends.nulls:
        lead = docs.agg(F.min(doc_id).alias("m")).first().m
        copies.append(F.when(doc_id.isNull() & F.lit(lead is not None), F.struct(F.lit(1).alias("part"), F.lit(True).alias("halo"))))
        if lead is None:                                 # only rows without an id
            copies.append(F.struct(F.lit(0).alias("part"), F.lit(True).alias("halo")))
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.select("doc_id", "text", F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull())).alias("to"))
    dealt = dealt.select("to.part", "to.halo", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []                       # of a run of own rows of one range, not yet put out
        texts: list[str] = []
        size, now, closed = 0, None, False
        for b in batches:
            parts, halos = b.column(0).to_pylist(), b.column(1).to_pylist()
            numbers = b.column(2).to_pylist()
            for i, text in enumerate(b.column(3)):
                if parts[i] != now:
                    ids, texts, size, now, closed = [], [], 0, parts[i], False
                if closed:                               # further halo rows of the range
                    continue
                texts.append(text.as_py())
                size += len(texts[-1])
                if halos[i]:
                    if len(texts) > 1:
                        yield _rows(ids, texts)
                    ids, texts, size, closed = [], [], 0, True
                    continue
                ids.append(numbers[i])
                if size > CHUNK and len(texts) > 1:
                    yield _rows(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])

    return (dealt.repartitionById(len(cuts) + 2, F.col("part"))
            .sortWithinPartitions("part", "halo", F.col("doc_id").desc_nulls_last(), "text")
            .mapInArrow(run, SCHEMA))
