"""Toxicity: averaged subword embeddings into a linear softmax.

A document is read as its passages, all runs of ``PASSAGE_WORDS`` consecutive
words (a shorter text is one passage; a word said over and over counts once).
A passage is the bag of the hashed character n-grams (3 to 5 letters, word ends
marked) of its words; the bag's embeddings are averaged and go into a two-class
softmax.  Embeddings and softmax are trained jointly in numpy, with n-grams
dropped at random, so that a misspelling that still shares some n-grams with a
word seen in training stays close to it.  A document's raw score is that of its
highest passage: a few words decide, whatever the length of the rest and
wherever they stand.

Only documents carry labels, so training alternates: first every passage of a
toxic document counts as toxic; then only its highest passages do (the others
are left out), while all passages of clean documents count as clean.  Training
takes every ``TRAIN_STEP``-th passage and the last of each document.  A logistic
curve fitted on the training documents' highest passages turns the raw score
into a probability.

The model is fitted on a bounded sample from rows outside the held-out fold:
about ``MAX_TRAIN_ROWS`` labelled rows of either class, those whose id's hash lies
below the share that makes so many, with texts of up to ``MAX_TRAIN_CHARS``
characters.  Every document is then scored over its whole text, by Spark tasks.
Labels, language, source and id are never inputs of a score.

A null or empty text, or one without letters or digits, is an empty bag: it
gets the score of the softmax bias alone, which the curve puts on the clean
side.  A labelled id without a document, null labels, and ids labelled both
ways are not learned from; a repeated label row counts once.  If one class has
no training row, every score is 0 (or 1 if only toxic rows exist).  An empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import batch, bucket_of, byte_chunks, hash_sample, ship_package

FOLDS, HELD_OUT = 5, 0
MAX_TRAIN_ROWS = 1500        # labelled rows of either class that the model is fitted on
MAX_TRAIN_CHARS = 200_000    # a longer text is not learned from
PASSAGE_WORDS = 8
TRAIN_STEP = 4
ORDERS = (3, 4, 5)
LEAST_GRAMS = 12 * PASSAGE_WORDS         # a shorter bag is averaged as if neutral n-grams filled it up
BUCKETS = 1 << 18
DIM = 16
CHUNK = 1 << 20              # bytes of text per numpy pass


# -------------------------------------------------------------------- features
@cache
def _alnum() -> np.ndarray:
    """Letters and digits (and marks on them) of the basic plane, by rule."""
    import unicodedata

    return np.array([unicodedata.category(chr(c))[0] in "LNM" for c in range(0x10000)])


def symbols(text: str) -> np.ndarray:
    """Lower-case code points; all but letters, digits and single signs inside
    a word become spaces."""
    s = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = np.where(s < 0x10000, _alnum()[np.minimum(s, 0xFFFF)], True)
    inner = np.zeros(len(s), bool)
    if len(s) > 2:
        blank = (s == 32) | ((s >= 9) & (s <= 13)) | (s == 0)
        inner[1:-1] = known[:-2] & known[2:] & ~blank[1:-1]
    return np.where(known | inner, s, 32).astype(np.uint64)


@dataclass
class Bags:
    """N-gram buckets in the order of their words."""

    buckets: np.ndarray          # int64
    ends: np.ndarray             # where each word's buckets end
    word_doc: np.ndarray         # the document of each word

    def passages(self, step: int) -> tuple[np.ndarray, ...]:
        """(first bucket, end, document) of every ``step``-th passage of each
        document and its last one."""
        n_docs = int(self.word_doc[-1]) + 1 if len(self.word_doc) else 0
        size = np.bincount(self.word_doc, minlength=n_docs)
        first = np.cumsum(size) - size
        last = np.maximum(size - PASSAGE_WORDS, 0)                     # start of the last passage
        count = np.where(size > 0, -(-last // step) + 1, 0)
        doc = np.repeat(np.arange(n_docs), count)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = first[doc] + np.minimum(nth * step, last[doc])
        stop = np.minimum(start + PASSAGE_WORDS, first[doc] + size[doc])
        edge = np.r_[0, self.ends]
        return edge[start], edge[stop], doc


def bags(texts: list[str]) -> Bags:
    # a zero ends each document, and no gram may hold one
    s = np.concatenate([np.r_[np.uint64(32), symbols(t), np.uint64(32), np.uint64(0)] for t in texts])
    space = (s == 32) | (s == 0)
    begins = np.r_[False, space[:-1] & ~space[1:]]                     # first letter of each word
    word = np.cumsum(begins) - 1                                       # of each letter
    doc = np.cumsum(s == 0) - (s == 0)
    starts = np.flatnonzero(begins)
    word_doc = doc[starts]
    kept = _unlike_the_last(s, space, starts, word, word_doc)
    place = np.where(kept, np.cumsum(kept) - 1, -1)                    # of each word among the kept
    # position just behind the word that a letter stands in
    gaps = np.flatnonzero(space)
    behind = gaps[np.searchsorted(gaps, np.arange(len(s)))] if len(gaps) else np.empty(0, np.int64)
    out_b, out_w = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    with np.errstate(over="ignore"):
        for n in ORDERS:
            if len(s) < n:
                continue
            h = np.full(len(s) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ s[k: len(s) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            i = np.arange(len(h))
            # inner letters of the gram lie in one word; only its ends may be spaces
            ok = ~space[i + 1] & (behind[i + 1] >= i + n - 1) & (s[i] != 0) & (s[i + n - 1] != 0)
            at = i[ok]
            at = at[place[word[at + 1]] >= 0]
            out_b.append((h[at] >> np.uint64(7)).astype(np.int64) & (BUCKETS - 1))
            out_w.append(place[word[at + 1]])
    b, w = np.concatenate(out_b), np.concatenate(out_w)
    order = np.argsort(w, kind="stable")
    return Bags(b[order], np.cumsum(np.bincount(w, minlength=int(kept.sum()))), word_doc[kept])


def _unlike_the_last(s, space, starts, word, word_doc) -> np.ndarray:
    """Which words differ from the one before them in their text: a word said
    over and over counts once."""
    if not len(starts):
        return np.empty(0, bool)
    at = np.flatnonzero(~space)
    with np.errstate(over="ignore"):
        place = (at - starts[word[at]]).astype(np.uint64)
        h = (s[at] + (place << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        total = np.add.reduceat(h, np.searchsorted(at, starts))
    same = (total[1:] == total[:-1]) & (word_doc[1:] == word_doc[:-1])
    return np.r_[True, ~same]


# ----------------------------------------------------------------------- model
@dataclass
class Model:
    weights: np.ndarray | None   # float32 per bucket: the softmax difference of its embedding
    bias: float
    slope: float                 # logistic curve over the highest passage
    offset: float
    constant: float = 0.0        # the score where one class is missing

    def raw(self, texts: list[str]) -> np.ndarray:
        """The highest passage's softmax difference of each text."""
        found = bags(texts)
        begin, end, doc = found.passages(1)
        return _highest(_means(self.weights[found.buckets], begin, end) + self.bias, doc, len(texts), self.bias)

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(texts) + self.offset, -40, 40)))


def _means(weights: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mean weight of each passage's buckets; passages may overlap."""
    total = np.r_[0.0, np.cumsum(weights, dtype=np.float64)]
    return (total[end] - total[begin]) / np.maximum(end - begin, LEAST_GRAMS)


def _highest(logit: np.ndarray, doc: np.ndarray, n: int, empty: float) -> np.ndarray:
    """The highest passage of each of n documents; ``empty`` without any."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, doc, logit)
    return np.where(np.isneginf(top), empty, top)


def _joint_training(rng, table, softmax, buckets, begins, ends, labels, weight, rounds, rate, drop):
    """Plain gradient steps on embeddings ``table`` and ``softmax`` (2 x DIM
    and a bias each), ``labels`` and ``weight`` by passage."""
    w, bias = softmax
    used = np.flatnonzero(weight > 0)
    for turn in range(rounds):
        step = rate * (1 - turn / rounds)
        order = rng.permutation(used)
        for at in range(0, len(order), 512):
            rows = order[at: at + 512]
            n = ends[rows] - begins[rows]
            owner = np.repeat(np.arange(len(rows)), n)
            grams = buckets[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins[rows], n)]
            kept = rng.random(len(grams)) >= drop
            owner, grams = owner[kept], grams[kept]
            size = np.maximum(np.bincount(owner, minlength=len(rows)), LEAST_GRAMS * (1 - drop))
            ids, local = np.unique(grams, return_inverse=True)
            vec = table[ids]
            diff = vec @ (w[1] - w[0])
            z = np.bincount(owner, weights=diff[local], minlength=len(rows)) / size + bias[1] - bias[0]
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[rows]) * weight[rows]
            share = np.bincount(local, weights=(error / size)[owner], minlength=len(ids))
            slope = share @ vec
            table[ids] -= step * share[:, None] * (w[1] - w[0])[None, :]
            scale = step / len(rows)
            w[1] -= scale * slope
            w[0] += scale * slope
            bias[1] -= scale * error.sum()
            bias[0] += scale * error.sum()


def fit(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Model:
    """Train on documents; see the module text for the two alternating steps."""
    if len(texts) == 0 or toxic.all() or not toxic.any():
        return Model(None, 0.0, 0.0, 0.0, float(len(texts) > 0 and bool(toxic.all())))
    rng = np.random.default_rng(seed)
    parts, words, base, size = [], [], 0, 0
    for s, e in byte_chunks(np.array([len(t) for t in texts]), CHUNK):
        found = bags(texts[s:e])
        parts.append(found.buckets.astype(np.int32))
        words.append((found.ends + size, found.word_doc + base))
        base, size = base + e - s, size + len(found.buckets)
    every = Bags(np.concatenate(parts), *(np.concatenate(x) for x in zip(*words)))
    del parts, words
    buckets = every.buckets
    begins, ends, doc = every.passages(TRAIN_STEP)
    label = toxic[doc].astype(float)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    w, bias = rng.normal(0, 0.5, (2, DIM)), np.zeros(2)

    def logits(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        weights, out = table @ (w[1] - w[0]), np.empty(len(begin))
        for s in range(0, len(begin), 1 << 14):          # a few megabytes at a time
            some = slice(s, s + (1 << 14))
            first = begin[s]
            out[some] = _means(weights[buckets[first: end[some].max()]], begin[some] - first, end[some] - first)
        return out + bias[1] - bias[0]

    weight = np.ones(len(doc))
    weight[label == 1] = (label == 0).sum() / max((label == 1).sum(), 1)
    weight /= weight.mean()
    _joint_training(rng, table, (w, bias), buckets, begins, ends, label, weight, 3, 0.5, 0.3)
    for _ in range(3):
        z = logits(begins, ends)
        top = _highest(z, doc, len(texts), -np.inf)
        chosen = (label == 0) | (z >= top[doc] - 0.25 * np.abs(top[doc] - np.median(z)))
        weight = np.where(chosen, 1.0, 0.0)
        # clean passages far outnumber the chosen toxic ones
        weight[chosen & (label == 1)] = max((label == 0).sum() / max((chosen & (label == 1)).sum(), 1) / 4, 1)
        weight /= weight[chosen].mean()
        _joint_training(rng, table, (w, bias), buckets, begins, ends, label, weight, 3, 0.5, 0.3)
    seen = np.zeros(BUCKETS, bool)
    seen[buckets] = True
    table[~seen] = 0                                     # an n-gram never seen says nothing
    del begins, ends, doc, weight, label
    begins, ends, doc = every.passages(1)                # as documents are scored
    top = _highest(logits(begins, ends), doc, len(texts), bias[1] - bias[0])
    slope, offset = _curve(top, toxic)
    return Model((table @ (w[1] - w[0])).astype(np.float32), float(bias[1] - bias[0]), slope, offset)


def _curve(top: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve over the highest passages.  Its middle is the cut with
    the fewest training errors, half way between the two scores it parts."""
    order = np.argsort(top)
    x, y = top[order], toxic[order].astype(int)
    wrong = np.r_[0, np.cumsum(y)] + (len(y) - y.sum()) - np.r_[0, np.cumsum(1 - y)]
    best = np.flatnonzero(wrong == wrong.min())
    cut = int(best[len(best) // 2])
    low = x[cut - 1] if cut else x[0] - 1
    high = x[cut] if cut < len(x) else x[-1] + 1
    middle = (low + high) / 2
    spread = max(float(np.median(x[y == 1]) - np.median(x[y == 0])), 1e-6)
    return 8 / spread, float(-8 / spread * middle)


# ----------------------------------------------------------------------- Spark
def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of the bounded training sample."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
           .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most")
           .filter(bucket_of("doc_id", FOLDS) != HELD_OUT))
    ids = hash_sample(ids, "doc_id", "toxic", max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.coalesce(F.length("text"), F.lit(0)) <= MAX_TRAIN_CHARS)
    # about 2 * max_rows ids: a known bound, so the texts are not shuffled
    return texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id", "text"]).select("doc_id", "text", "toxic")


FITTED = "weights binary, bias double, slope double, offset double, constant double"


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the bounded sample.  One Spark task does so, which is retried like
    any other; only the fitted weights (a float a bucket) reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"] or "", r["toxic"]) for b in batches for r in b.to_pylist())
        m = fit([t for _, t, _ in rows], np.array([x == 1 for _, _, x in rows], bool))
        schema = pa.schema([("weights", pa.binary()), *((c, pa.float64()) for c in ("bias", "slope", "offset", "constant"))])
        yield batch(schema, [None if m.weights is None else m.weights.tobytes()], [m.bias], [m.slope], [m.offset], [m.constant])

    row = training_rows(docs, labels, max_rows).repartition(1).mapInArrow(run, FITTED).first()
    if row is None:
        return Model(None, 0.0, 0.0, 0.0, 0.0)
    weights = None if row.weights is None else np.frombuffer(row.weights, np.float32)
    return Model(weights, row.bias, row.slope, row.offset, row.constant)


SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _scored(model, rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    texts = [t or "" for t in rows.column("text").to_pylist()]
    parts = [model.score(texts[s:e]) for s, e in byte_chunks(np.array([len(t) for t in texts]), CHUNK)]
    return np.concatenate(parts) if parts else np.empty(0)


def scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))       # a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(SCORES, b.column("doc_id"), _scored(model.value, b))

    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .mapInArrow(run, "doc_id long, score double"))
    return scored.select("doc_id", F.coalesce(bucket_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, all columns kept; scored
    row by row in one pass, with no join back."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))       # a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scored(model.value, b) < 0.5))

    return docs.mapInArrow(run, docs.schema)
