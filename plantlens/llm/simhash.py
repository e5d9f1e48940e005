"""SimHash near-duplicates through fuzzy Golay keys.

A text's fingerprint has a bit set where over half of its shingle hashes have
it set.  Two fingerprints link when they differ in at most ``MAX_BITS`` bits.

Candidates come from the perfect binary Golay code [23, 12, 7].  The 64 bits
are cut into three segments of 22, 21 and 21 bits, each padded to a 23-bit
word.  The *near indices* of a word are the 12-bit data parts of all code
words within distance 4: one for words within 2 of a code word, six for the
rest (5.3 on average).  Two words that differ in at most 2 bits always share
one, because the code word nearest to the word half way between them lies
within 4 of both.

With at most four differing bits in all, the segments' errors leave two cases:

* a segment has no error.  The other two share at most four, so one has at
  most two: key = the untouched segment + a near index of the other.
* every segment has one.  Then two have exactly one and the third at most
  two: key = an untouched half of either + a near index of the third.

That is 18 key families of 33 or 34 bits and about 96 keys for a fingerprint,
with no pair within the bound missed.  Keys are dealt out by a shuffle and
sorted; fingerprints of one key are compared in numpy by a breadth-first walk
that hangs each reached fingerprint on the walk's start, so a key shared by m
fingerprints yields at most m - 1 verified links and a dense group of near
copies costs about m comparisons a level instead of m squared rows.  Equal
fingerprints are one row before any of this.  The links go to the distributed
union-find of ``components.py``.

Null texts count as empty.  A text without words has fingerprint zero and is
linked like any other.  Rows with a null id keep a fingerprint; their
component is the smallest non-null id reachable (null if there is none).
Repeated rows are kept; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import batch, pinned, ship_package, row_columns, whole_row
from plantlens.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4

# Generator polynomial of the binary Golay code, and XXH64's seed.
GOLAY_POLY = 0xC75
SEED = 42

SEGMENTS = ((42, 22), (21, 21), (0, 21))                 # (lowest bit, width)
HALF = 11                                                # low half; the high half has the rest


# ---------------------------------------------------------------- fingerprints
def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 of every n-word shingle of a text already in lower case."""
    import xxhash

    words = text.split()                                 # bytes.split: exactly the contract's blanks
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return np.array([digest(line, SEED)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - n] + 1).tolist()]
    ends = [*gaps[n - 1:].tolist(), len(line)]
    return np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends)], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit word with the bits that over half of the hashes have."""
    n = len(hashes)
    if n == 0:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 64):                     # 255 rows never overflow a byte lane
        part = hashes[at: at + 255 * 64].astype(">u8")
        lanes = np.unpackbits(part.view(np.uint8)).view(np.uint64).reshape(-1, 8)
        lanes = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += np.ascontiguousarray(lanes).view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">u8")[0])


FINGERPRINT = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint of each row's whole text as a signed
    long, and the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([majority_bits(shingle_hashes((t.as_py() or "").encode().lower(), shingle_words))
                            for t in b.column(2)], np.uint64)
            yield batch(FINGERPRINT, b.column(0), b.column(1), fps.view(np.int64))

    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
            .mapInArrow(run, "doc_id long, text_key long, fp long"))


# ------------------------------------------------------------------ Golay keys
@cache
def _syndrome_bytes() -> np.ndarray:
    """Remainders modulo the generator of each value of each of three bytes."""
    def remainder(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY_POLY << (bit - 11)
        return x

    return np.array([[remainder(v << shift & 0x7FFFFF) for v in range(256)] for shift in (0, 8, 16)], np.int64)


def _syndrome(words: np.ndarray) -> np.ndarray:
    t = _syndrome_bytes()
    return t[0][words & 255] ^ t[1][words >> 8 & 255] ^ t[2][words >> 16 & 127]


@cache
def _near_errors() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome the error patterns of weight at most 4 that reach a code
    word (one or six of them), padded to six, and how many there are."""
    patterns = np.array([sum(1 << i for i in c) for w in range(5) for c in combinations(range(23), w)], np.int64)
    weights = np.bitwise_count(patterns)
    syn = _syndrome(patterns)
    least = np.full(2048, 9)
    np.minimum.at(least, syn, weights)
    keep = (weights == least[syn]) | (least[syn] == 3)
    errors, counts = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for p, s in zip(patterns[keep].tolist(), syn[keep].tolist()):
        errors[s, counts[s]] = p
        counts[s] += 1
    return errors, counts


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) pairs: the data parts of the code words near each word."""
    errors, counts = _near_errors()
    syn = _syndrome(words)
    n = counts[syn]
    rows = np.repeat(np.arange(len(words)), n)
    slot = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, (words[rows] ^ errors[syn[rows], slot]) >> 11


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of every fingerprint (uint64)."""
    seg = [((fps >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    halves = [(s & ((1 << HALF) - 1), s >> HALF) for s in seg]
    rows_out, keys_out, family = [], [], 0
    for third in range(3):
        rows, index = near_indices(seg[third])
        others = [i for i in range(3) if i != third]
        for exact in [seg[i] for i in others]:
            keys_out.append(family << 58 | exact[rows] << 12 | index)
            rows_out.append(rows)
            family += 1
        for a in halves[others[0]]:
            for b in halves[others[1]]:
                keys_out.append(family << 58 | a[rows] << 23 | b[rows] << 12 | index)
                rows_out.append(rows)
                family += 1
    return np.concatenate(rows_out), np.concatenate(keys_out)


KEYS = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4096):
            part = fps[at: at + 4096]
            rows, keys = fuzzy_keys(part.view(np.uint64))
            yield batch(KEYS, keys, part[rows])


def walk(fps: np.ndarray, max_bits: int) -> list[tuple[int, np.ndarray]]:
    """Breadth-first over fingerprints within ``max_bits``: (start, reached)."""
    found, todo = [], fps
    while len(todo) > 1:
        start, queue, todo = todo[0], [todo[0]], todo[1:]
        while queue and len(todo):
            near = np.bitwise_count(todo ^ queue.pop()) <= max_bits
            if near.any():
                hit, todo = todo[near], todo[~near]
                found.append((start, hit))
                queue.extend(hit)
    return found


def _links_of_runs(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Verified links (n, 2) of complete runs of equal, sorted keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    two = starts[sizes == 2]
    near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits
    pairs = [np.stack([fps[two], fps[two + 1]], 1)[near]]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        for start, hit in walk(fps[s: s + n], max_bits):
            pairs.append(np.stack([np.full(len(hit), start), hit], 1))
    return np.unique(np.concatenate(pairs), axis=0)


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified links (a, b) that connect all of ``classes.fp`` (distinct longs)
    that differ in at most ``max_bits`` bits: a spanning set, not every pair."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys guarantee up to {MAX_BITS} differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []                      # rows of the key that the last batch ended in
        for b in batches:
            rows = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1)
            if held and held[-1][-1, 0] == rows[-1, 0]:
                held.append(rows)
                continue
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            done = np.concatenate([*held, rows[:cut]])
            held = [rows[cut:]]
            if len(done):
                out = _links_of_runs(done[:, 0], done[:, 1].copy().view(np.uint64), max_bits).view(np.int64)
                yield batch(LINKS, out[:, 0].copy(), out[:, 1].copy())
        if held:
            done = np.concatenate(held)
            out = _links_of_runs(done[:, 0], done[:, 1].copy().view(np.uint64), max_bits).view(np.int64)
            yield batch(LINKS, out[:, 0].copy(), out[:, 1].copy())

    keys = classes.select("fp").mapInArrow(_key_rows, "key long, fp long")
    return keys.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) for every row of ``docs``:
    the component is named by its smallest fingerprint, its id is its smallest
    document id."""
    ship_package(docs.sparkSession)
    fps = pinned(fingerprints(docs, id_col, text_col, shingle_words))
    classes = pinned(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = connected_components(links(classes, max_bits))
    rooted = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = pinned(rooted.join(least, "component").select("fp", "component", "component_id"))
    return fps.join(named, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def op3(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, fingerprint (hex), component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the row with the smallest id (of
    several rows with that id, the smallest in the order of the columns, maps as
    their sorted entries).
    Rows are told apart by id and text, so rows of one id can stay for several
    components.  Rows without an id stay."""
    found = near_duplicates(docs)
    keep = found.filter("doc_id = component_id").select(
        F.col("doc_id").alias("keep_id"), F.col("text_key").alias("keep_key"), "component").distinct()
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(docs["text"].cast("string")).alias("key"),
                       whole_row(docs).alias("row"))
    kept = rows.join(keep, (rows["id"] == keep["keep_id"]) & (rows["key"] == keep["keep_key"])).groupBy("keep_id", "component").agg(
        F.min("row").alias("row"))
    return kept.select(row_columns(docs)).union(docs.filter(docs["doc_id"].isNull()))
