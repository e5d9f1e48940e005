"""Language identification: interpolated Kneser-Ney character models.

One character model of order ``ORDER`` per language, with absolute discounting
interpolated down to a uniform base; the lower orders use continuation counts.
Text is lower-cased and every run of non-letters becomes one space, so the
models see letters and word ends.  All languages share one table an order:
sorted 64-bit n-gram hashes, and beside each the log probability that every
language gives it, already interpolated.  A language's cross-entropy of a text is
the mean over its characters; the lowest wins.

Calibration uses training rows the models have not seen, whole and as excerpts
of 1 to 32 words.  They give each language the mean and spread of its texts'
cross-entropy by length, and one cut, in spreads above the mean, that
``REJECT_SHARE`` of the whole texts exceed.  A text above its language's cut is
``rejected`` as unlike anything learned (the choice still stands: the flag is an
extra column).  ``score`` is the probability of the choice under a softmax of the
cross-entropies in which the cut takes part as "none of them", so a text at the
cut has at most 0.5 and junk next to 0.  The softmax's temperature, and the power
of the length that sharpens it, have the highest likelihood on those rows.

The models are fitted on a bounded sample of each language's training rows: about
``MAX_TRAIN_ROWS`` to count and half as many to calibrate, drawn by the hash of
their id, with texts of up to ``MAX_TRAIN_CHARS`` characters.  N-grams are counted
by Spark tasks, one task builds the tables, and tasks measure the calibration
rows: the driver gets the fitted tables and a few numbers a row, no text and no
count.  Every document is scored over its whole text.  Language, source and id
are never inputs of a prediction.

A null text, or one without a letter, is ``und`` with score 0, and so is every
text if nothing can be learned.  Equal cross-entropies go to the language first
in code-point order.  Repeated training rows count once each.  An empty table
gives an empty table.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import Scratch, batch, bucket_of, byte_chunks, hash_sample, ship_package

FOLDS, HELD_OUT = 4, 2
MAX_TRAIN_ROWS = 1000        # documents of each language that its model is fitted on, and half as many to calibrate
MAX_TRAIN_CHARS = 200_000    # a longer text is not learned from
EXCERPTS = (1, 2, 4, 8, 16, 32)          # words
ORDER = 4
UNKNOWN = "und"
REJECT_SHARE = 0.005         # of unseen training rows may lie above their language's limit
CHUNK = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
NONE = np.uint64(0)


# -------------------------------------------------------------------- symbols
def _kind(c: int) -> int:
    """2 for a letter, 1 for a mark, 0 for others; the marks that only choose
    how a sign is drawn (emoji, keycaps) are others."""
    import unicodedata

    if 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF or c == 0x20E3:
        return 0
    return {"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0)


@cache
def _kinds() -> np.ndarray:
    return np.array([_kind(c) for c in range(0x10000)], np.int8)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' symbols in a row, and which text each belongs to.  A text
    is a space, its letters with single spaces between words, a space; one
    without letters has no symbol."""
    joined = "\n".join(t.replace("\n", " ").lower() for t in texts)
    s = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    end = s == 10
    owner = np.cumsum(end)
    kind = _kinds()[np.minimum(s, 0xFFFF)]
    above = np.flatnonzero(s > 0xFFFF)
    if len(above):                                       # few: looked up by distinct value
        found, which = np.unique(s[above], return_inverse=True)
        kind[above] = np.array([_kind(c) for c in found.tolist()], np.int8)[which]
    has = np.bincount(owner[kind == 2], minlength=len(texts)) > 0
    letter = (kind > 0) & ~end & has[owner]
    # a space stays where a word begins; each text also ends in one
    begins = letter & ~np.r_[False, letter[:-1]]
    begins[1:] |= letter[1:] & (owner[1:] != owner[:-1])
    at = np.flatnonzero(letter)
    n = 1 + begins[at]
    places = np.cumsum(n) - 1
    total = int(n.sum())
    out = np.full(total, 32, np.uint64)
    out[places] = s[at]
    who = np.repeat(owner[at], n)
    # closing spaces
    last = np.flatnonzero(np.r_[who[1:] != who[:-1], True]) + 1 if total else np.empty(0, np.int64)
    out = np.insert(out, last, 32)
    who = np.insert(who, last, np.flatnonzero(has)) if total else who
    return out, who


def gram_hashes(s: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n symbols that end at each position from n - 1 on; never 0."""
    h = np.full(len(s) - n + 1, np.uint64(n))
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ s[k: len(s) - n + 1 + k]) * MULTIPLIER
            h ^= h >> np.uint64(32)
    return np.maximum(h, np.uint64(1))


# ----------------------------------------------------------------------- model
@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]          # per order 1..ORDER: sorted hashes
    logs: list[np.ndarray]           # per order: log probability by gram and language
    contexts: list[np.ndarray]       # per order 2..ORDER: sorted hashes of the n - 1 symbols before
    backs: list[np.ndarray]          # per order: log weight of the lower order after a context
    base: np.ndarray                 # per language: log probability of a symbol never seen
    temperature: float = 1.0
    power: float = 0.0
    usual: np.ndarray | None = None  # per language: mean (2) and variance (2) of the cross-entropy, by 1 and 1 / length
    cut: float = np.inf

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Mean cross-entropy by text and language; infinite without letters."""
        return self.measure(texts)[0]

    def measure(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(mean cross-entropies, symbols) of each text."""
        s, who = symbols(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        if len(s) > 1:
            first = np.r_[True, who[1:] != who[:-1]]                   # opening spaces are given, not predicted
            start = np.flatnonzero(first)
            depth = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)]))
            logs = self._logs(s, np.minimum(depth + 1, len(self.grams)))
            at = np.flatnonzero(~first)
            for k in range(len(self.languages)):
                sums[:, k] = np.bincount(who[at], weights=logs[at, k], minlength=len(texts))
            counts = np.bincount(who[at], minlength=len(texts))
        out = -sums / np.maximum(counts, 1)[:, None]
        out[counts == 0] = np.inf
        return out, counts

    def limits(self, n: np.ndarray) -> np.ndarray:
        """The cross-entropy above which a text of n symbols is unlike each language."""
        if self.usual is None:
            return np.full((len(n), len(self.languages)), np.inf)
        short = 1 / np.maximum(n, 1)[:, None]
        mean, spread = self.usual[:, 0] + self.usual[:, 1] * short, np.sqrt(self.usual[:, 2] + self.usual[:, 3] * short)
        return mean + self.cut * spread

    def shares(self, h: np.ndarray, n: np.ndarray, temperature: float, power: float) -> np.ndarray:
        """Probability of each language, next to "none of them" at the cut."""
        low = h.min(1)
        none = self.limits(n)[np.arange(len(h)), h.argmin(1)]
        sharp = (np.maximum(n, 1) ** power / temperature)[:, None]
        z = np.clip(np.c_[low[:, None] - h, low - none] * sharp, -700, 700)
        z = np.exp(z - z.max(1, keepdims=True))
        return z[:, :-1] / z.sum(1, keepdims=True)

    def _logs(self, s: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Log probability of each symbol given up to ORDER - 1 before it, using
        ``order`` symbols in all."""
        out = np.zeros((len(s), len(self.languages)), np.float32)
        left = np.arange(len(s))                                       # not settled yet
        for n in range(len(self.grams), 0, -1):
            here = left[order[left] >= n]
            if not len(here):
                continue
            grams = gram_hashes(s, n)[here - n + 1]
            at = np.minimum(np.searchsorted(self.grams[n - 1], grams), len(self.grams[n - 1]) - 1)
            seen = self.grams[n - 1][at] == grams
            out[here[seen]] += self.logs[n - 1][at[seen]]
            missed = here[~seen]
            if n > 1 and len(missed):
                c = gram_hashes(s, n - 1)[missed - n + 1]
                at = np.minimum(np.searchsorted(self.contexts[n - 2], c), len(self.contexts[n - 2]) - 1)
                known = self.contexts[n - 2][at] == c
                out[missed[known]] += self.backs[n - 2][at[known]]
            elif len(missed):
                out[missed] += self.base
            left = np.concatenate([left[order[left] < n], missed])
        return out

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number or -1, score, rejected) of each text."""
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n = self.measure(texts)
        none = np.isinf(h[:, 0])
        h = np.where(none[:, None], 0, h)
        best = h.argmin(1)
        each = np.arange(len(h))
        share = self.shares(h, n, self.temperature, self.power)[each, best]
        over = h[each, best] > self.limits(n)[each, best]
        return np.where(none, -1, best), np.where(none, 0.0, share), none | over


def build(counts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]], languages: list[str]) -> Model:
    """Models from n-gram counts.  ``counts[n]`` has, a row for each gram and
    language: gram hash, hash of its first n - 1 symbols, hash of its last
    n - 1 symbols, language number, count."""
    k = len(languages)
    grams, contexts, backs, raw = [], [], [], []
    top = max(counts)
    # continuation counts: how many symbols stand before the gram
    used = {}
    for n in range(top, 0, -1):
        gram, before, after, lang, count = counts[n]
        if n == top:
            used[n] = (gram, before, after, lang, count)
            continue
        # one unit for each different (n + 1)-gram that ends in it
        longer, lang_up = counts[n + 1][2], counts[n + 1][3]
        table = np.unique(gram)
        units = np.bincount(np.searchsorted(table, longer) * k + lang_up, minlength=len(table) * k)
        # grams that open a text have nothing before them: keep their count of one
        own = np.searchsorted(table, gram) * k + lang
        used[n] = (gram, before, after, lang, np.maximum(units[own], 1))
    symbols_seen = len(np.unique(counts[1][0]))
    base = -np.log(symbols_seen + 1)
    lower = None                     # probability function of the order below: (hashes, matrix)
    logs = []
    for n in range(1, top + 1):
        gram, before, after, lang, count = used[n]
        table, place = np.unique(gram, return_inverse=True)
        c = np.zeros((len(table), k))
        c[place, lang] = count
        ones, twos = (c == 1).sum(0), (c == 2).sum(0)
        discount = np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
        discount = np.clip(discount, 0.1, 0.9)
        first = np.zeros(len(table), np.uint64)
        first[place] = before
        ctx, ctx_of = np.unique(first, return_inverse=True)
        total = np.zeros((len(ctx), k))
        kinds = np.zeros((len(ctx), k))
        for j in range(k):
            total[:, j] = np.bincount(ctx_of, weights=c[:, j], minlength=len(ctx))
            kinds[:, j] = np.bincount(ctx_of, weights=c[:, j] > 0, minlength=len(ctx))
        share = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        if n == 1:
            under = np.full((len(table), k), np.exp(base))
        else:
            rest = np.zeros(len(table), np.uint64)
            rest[place] = after
            at = np.minimum(np.searchsorted(lower[0], rest), len(lower[0]) - 1)
            under = lower[1][at]
        p = np.maximum(c - discount, 0) / np.maximum(total[ctx_of], 1) + share[ctx_of] * under
        lower = (table, p)
        grams.append(table)
        logs.append(np.log(np.maximum(p, 1e-30)).astype(np.float32))
        if n == 1:
            unseen = (base + np.log(np.maximum(share[0], 1e-30))).astype(np.float32)
        else:
            contexts.append(ctx)
            backs.append(np.log(np.maximum(share, 1e-30)).astype(np.float32))
    return Model(languages, grams, logs, contexts, backs, unseen)


def count_grams(texts: list[str], order: int = ORDER):
    """Per order 1..order: (gram, before, after, count) of the texts."""
    s, who = symbols(texts)
    for n in range(1, order + 1):
        if len(s) < n:
            continue
        inside = who[: len(s) - n + 1] == who[n - 1:]
        opens = np.r_[True, who[1:] != who[:-1]]
        if n == 1:
            inside = ~opens
        h = gram_hashes(s, n)
        gram, at, count = np.unique(h[inside], return_index=True, return_counts=True)
        where = np.flatnonzero(inside)[at]
        before = gram_hashes(s, n - 1)[where] if n > 1 else np.zeros(len(gram), np.uint64)
        after = gram_hashes(s, n - 1)[where + 1] if n > 1 else np.zeros(len(gram), np.uint64)
        yield n, gram, before, after, count


# ----------------------------------------------------------------------- Spark
def _sample(docs: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, lang, text, tune) of the bounded training sample; every third
    row (by hash) is for calibration and not counted."""
    ids = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
           .filter("lang is not null and doc_id is not null").filter(bucket_of("doc_id", FOLDS) != HELD_OUT).distinct())
    ids = hash_sample(ids, "doc_id", "lang", max_rows * 3 // 2).withColumn("tune", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(3)) == 0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang")).filter("text is not null").filter(F.length("text") <= MAX_TRAIN_CHARS)
    # about 1.5 * max_rows ids a language
    return texts.join(F.broadcast(ids), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang", "text"])


COUNTS = "lang string, n int, gram long, before long, after long, count long"


MEASURED = "lang string, whole boolean, n double, h array<double>"


def excerpts(text: str) -> Iterator[tuple[bool, str]]:
    """The whole text, and one run of words of each length of EXCERPTS from
    a place that its own words choose."""
    yield True, text
    words = text.split()
    for n in EXCERPTS:
        if len(words) > n:
            at = zlib.crc32(f"{n} {text}".encode("utf-8", "replace")) % (len(words) - n + 1)
            yield False, " ".join(words[at: at + n])


def train(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    scratch = Scratch(docs.sparkSession, "langid")
    sample = scratch.keep(_sample(docs, max_rows))       # read once; bounded
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("gram", pa.int64()), ("before", pa.int64()),
                        ("after", pa.int64()), ("count", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, texts = np.array(b.column("lang").to_pylist(), object), np.array(b.column("text").to_pylist(), object)
            for one in sorted(set(lang)):
                for n, gram, before, after, count in count_grams(list(texts[lang == one])):
                    yield batch(schema, [one] * len(gram), [n] * len(gram), gram.view(np.int64), before.view(np.int64),
                                after.view(np.int64), count)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema)
        if rows.num_rows:
            yield batch(pa.schema([("model", pa.binary())]), [pickle.dumps(from_counts(rows))])

    counts = (sample.filter("not tune").select("lang", "text").mapInArrow(count, COUNTS).groupBy("lang", "n", "gram")
              .agg(F.sum("count").alias("count"), F.min("before").alias("before"), F.min("after").alias("after"))
              .select("lang", "n", "gram", "before", "after", "count"))
    row = counts.repartition(1).mapInArrow(fit, "model binary").first()
    if row is None:
        scratch.drop(sample)
        return Model([], [], [], [], [], np.empty(0))
    model = pickle.loads(row.model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    measured_schema = pa.schema([("lang", pa.string()), ("whole", pa.bool_()), ("n", pa.float64()), ("h", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                whole, texts = zip(*excerpts(text))
                h, n = shared.value.measure(list(texts))
                ok = n > 0
                yield batch(measured_schema, [lang] * int(ok.sum()), np.array(whole)[ok], n[ok], h[ok].tolist())

    found = sample.filter("tune").select("lang", "text").mapInArrow(measure, MEASURED).toArrow()     # numbers of a bounded sample
    scratch.drop(sample)
    rows = sorted((r for r in found.to_pylist() if r["lang"] in model.languages), key=lambda r: (r["lang"], r["n"], r["h"]))
    if not rows:
        return model
    return calibrate(model, np.array([r["h"] for r in rows]), np.array([r["n"] for r in rows]),
                     np.array([model.languages.index(r["lang"]) for r in rows]), np.array([r["whole"] for r in rows]))


def from_counts(rows: pa.Table) -> Model:
    """The tables of all languages from their n-gram counts."""
    languages = sorted(set(rows.column("lang").to_pylist()))
    number = np.searchsorted(languages, rows.column("lang").to_pylist())
    n = rows.column("n").to_numpy()
    cols = [rows.column(c).to_numpy().view(np.uint64) for c in ("gram", "before", "after")]
    count = rows.column("count").to_numpy()
    counts = {}
    for order in range(1, int(n.max()) + 1):
        at = np.flatnonzero(n == order)
        at = at[np.lexsort((number[at], cols[0][at]))]
        counts[order] = (cols[0][at], cols[1][at], cols[2][at], number[at], count[at])
    return build(counts, languages)


def calibrate(model: Model, h: np.ndarray, n: np.ndarray, y: np.ndarray, whole: np.ndarray) -> Model:
    """The usual cross-entropies, the cut, temperature and power from unseen
    rows: their cross-entropies, lengths, languages, and which are whole texts."""
    own, short = h[np.arange(len(h)), y], 1 / n
    model.usual = np.zeros((len(model.languages), 4))
    for k in range(len(model.languages)):
        at = y == k
        if not at.any():
            at = np.ones(len(y), bool)                   # a language without unseen rows: as the others
        x = np.c_[np.ones(int(at.sum())), short[at]]
        # long texts vary less, so they count more
        weight = np.sqrt(np.minimum(n[at], 1000))[:, None]
        mean = np.linalg.lstsq(x * weight, own[at] * weight[:, 0], rcond=None)[0]
        off = (own[at] - x @ mean) ** 2
        spread = np.linalg.lstsq(x * weight, off * weight[:, 0], rcond=None)[0]
        model.usual[k] = [*mean, max(spread[0], 1e-4), max(spread[1], 0.0)]
    mean = model.usual[y, 0] + model.usual[y, 1] * short
    spread = np.sqrt(model.usual[y, 2] + model.usual[y, 3] * short)
    model.cut = float(np.quantile(((own - mean) / spread)[whole if whole.any() else slice(None)], 1 - REJECT_SHARE))

    def loss(t: float, p: float) -> float:
        share = model.shares(h, n, t, p)[np.arange(len(h)), y]
        return float(-np.mean(np.log(np.maximum(share, 1e-9))))

    tried = [(float(t), p) for p in (0.0, 0.25, 0.5, 0.75, 1.0) for t in np.geomspace(0.002, 20, 60)]
    model.temperature, model.power = min(tried, key=lambda x: loss(*x))
    return model


def identify(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, max_rows))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for s, e in byte_chunks(np.array([len(t) for t in texts]), CHUNK):
                best, score, rejected = m.predict(texts[s:e])
                names = [UNKNOWN if i < 0 else m.languages[i] for i in best.tolist()]
                yield batch(schema, b.column(0).slice(s, e - s), names, score, rejected)

    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean"))
    return found.select("doc_id", F.coalesce(bucket_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")
