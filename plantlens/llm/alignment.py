"""Cross-tokenizer alignment: galloping intersection of token ends.

Two tokenizers cut the same bytes at different offsets.  Offsets where a token
of each ends cut a text into *groups*; within one, all tokens of A and of B
spell the same bytes.  The common ends are found by galloping: the shorter list
of ends drives an exponential and then a binary search into the longer one.
The indices of common ends slice the groups, and the ranks of a token's two
ends in the other list are the range of tokens it overlaps (its *links*).

A is a byte-level BPE over " " + text, B a sentencepiece BPE over text, which
adds the blank itself.  Both always break before a single blank that a visible
character follows (A's splitting rule has blanks at the start of words only, no
piece of B has a blank after another character), so texts are cut there into
*units*.  Different units are encoded and aligned once; a worker remembers some
of them.  A unit may be a whole text where there are no blanks.

1. ``encoded``: one pass over the texts gives each document's counts, the hash of
   its groups and its histogram of linked id pairs, written compressed.
2. ``pair_counts``: in how many documents is an id pair linked?  Tasks add up what
   they hold, then one aggregate over pairs; texts are not read again.
3. ``scored``: the documents' histograms meet the counts.  Up to
   ``BROADCAST_PAIRS`` pairs (16 bytes each) the counts go to every task; more are
   joined through a shuffle, with the pairs that very many documents hold split off.

Null and empty texts, and texts whose tokens do not spell " " + text (those with
a U+2581, which B writes for a blank), have no tokens: zeros and an empty hash.
Strings of special tokens in a text are plain text.  Long texts are worked off
in segments of units.  Every row has its own result, repeated ids or none; equal
rows count as two documents.  An empty table gives an empty table; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import Scratch, batch, byte_chunks, join_groups, one_thread, ship_package

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
CHUNK = 3 << 20                   # bytes of text handled at once; a longer text alone
SEGMENT = 1 << 20                 # links counted at once
REMEMBERED = 300_000              # units a worker keeps
REMEMBERED_BYTES = 48 << 20       # and their bytes
BROADCAST_PAIRS = 4_000_000
HELD_PAIRS = 2_000_000            # pairs a task adds up before it passes them on

BLANK_FIRST = r"^(\s|\p{Z}|[\x0b\x1c-\x1f\x{85}])"


# ------------------------------------------------------------------- galloping
def gallop(x: np.ndarray, first: np.ndarray, stop: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each x the first index in ``ends[first:stop]`` whose end is not below
    it.  The last end of each range is not below its x."""
    low, probe, live, width = first.copy(), first.copy(), np.arange(len(x)), 1
    while len(live):                                     # exponential: 1, 2, 4, ... beyond the start
        below = ends[probe[live]] < x[live]
        live = live[below]
        low[live] = probe[live] + 1
        probe[live] = np.minimum(first[live] + width, stop[live] - 1)
        width *= 2
    live = np.flatnonzero(low < probe)
    while len(live):                                     # binary, between the last two probes
        middle = (low[live] + probe[live]) >> 1
        below = ends[middle] < x[live]
        low[live[below]] = middle[below] + 1
        probe[live[~below]] = middle[~below]
        live = live[low[live] < probe[live]]
    return low


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each range, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - size), size)


def intersect(ends_a: np.ndarray, at_a: np.ndarray, ends_b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Alignment of many units in a row.  ``ends_*`` are byte offsets over all
    units, ``at_*`` where each unit's tokens begin (and a last one, the total).

    Returns the common ends as token indices (ia, ib) and the links as token
    indices (la, lb); both rise with the unit."""
    size_a, size_b = np.diff(at_a), np.diff(at_b)
    commons, links = [], []
    for a_drives in (True, False):
        unit = np.flatnonzero((size_a <= size_b) == a_drives)
        x_ends, x_at, x_size, y_ends, y_at = ((ends_a, at_a, size_a, ends_b, at_b) if a_drives else
                                              (ends_b, at_b, size_b, ends_a, at_a))
        i = spread(x_at[unit], x_size[unit])             # the shorter list's tokens
        start, stop = np.repeat(y_at[unit], x_size[unit]), np.repeat(y_at[unit + 1], x_size[unit])
        rank = gallop(x_ends[i], start, stop, y_ends)
        common = y_ends[rank] == x_ends[i]
        # a token's bytes begin where the one before it ends
        before = np.r_[0, rank[:-1] + common[:-1]]
        opens = np.zeros(len(i), bool)
        opens[np.cumsum(x_size[unit]) - x_size[unit]] = True
        low = np.where(opens, start, before)
        count = rank - low + 1
        mine, other = np.repeat(i, count), spread(low, count)
        commons.append((i[common], rank[common]) if a_drives else (rank[common], i[common]))
        links.append((mine, other) if a_drives else (other, mine))
    ia, ib = (np.concatenate(c) for c in zip(*commons))
    la, lb = (np.concatenate(c) for c in zip(*links))
    by, of = np.argsort(ia, kind="stable"), np.lexsort((lb, la))
    return ia[by], ib[by], la[of], lb[of]


# ------------------------------------------------------------------ tokenizers
def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones for themselves, the others for U+0100 and on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Store:
    """Lists of numbers, one after the other, that grow."""

    def __init__(self, kind):
        self.flat, self.at, self.n = np.zeros(1 << 12, kind), np.zeros(1 << 10, np.int64), 0

    def add(self, sizes: np.ndarray, values: np.ndarray) -> None:
        used = int(self.at[self.n])
        while len(self.at) < self.n + len(sizes) + 1:
            self.at = np.r_[self.at, np.zeros_like(self.at)]
        while len(self.flat) < used + len(values):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        self.at[self.n + 1: self.n + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.flat[used: used + len(values)] = values
        self.n += len(sizes)

    def sizes(self, slots: np.ndarray) -> np.ndarray:
        return self.at[slots + 1] - self.at[slots]

    def take(self, slots: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.at[slots], self.sizes(slots))]


class Aligner:
    """Two vocabularies and the units seen so far."""

    def __init__(self, path_a: str, path_b: str):
        one_thread()
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()
        n_b = self.b.get_piece_size()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(n_b)))]
        self.long_a, self.long_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.width = n_b                                 # an id pair's code is a * width + b
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.held = 0
        self.ids_a, self.ids_b, self.groups, self.pairs = Store(np.int32), Store(np.int32), Store(np.int32), Store(np.int64)
        self.odd: list[bool] = []                        # units that are not spelt by their tokens
        self.shown: list[bytes] = []                     # their groups, as the contract writes them

    def _ids(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        return a, self.b.encode(units, num_threads=1)

    def _learn(self, units: list[str]) -> None:
        for s in range(0, len(units), 8192):
            self._learn_some(units[s: s + 8192])

    def _learn_some(self, units: list[str]) -> None:
        raw = [b" " + u.encode() for u in units]
        a, b = self._ids(units)
        get_a, get_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        odd = [b"".join(map(get_a, x)) != r or b"".join(map(get_b, y)) != r for x, y, r in zip(a, b, raw)]
        for i in np.flatnonzero(odd).tolist():
            a[i], b[i] = [], []
        size_a, size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        flat_a, flat_b = (np.fromiter((t for x in y for t in x), np.int64, n) for y, n in ((a, int(size_a.sum())), (b, int(size_b.sum()))))
        at_a, at_b = np.r_[0, np.cumsum(size_a)], np.r_[0, np.cumsum(size_b)]
        ia, ib, la, lb = intersect(np.cumsum(self.long_a[flat_a]), at_a, np.cumsum(self.long_b[flat_b]), at_b)
        n_groups = np.diff(np.searchsorted(ia, at_a))
        n_links = np.diff(np.searchsorted(la, at_a))
        self.ids_a.add(size_a, flat_a)
        self.ids_b.add(size_b, flat_b)
        self.groups.add(2 * n_groups, np.c_[ia - np.repeat(at_a[:-1], n_groups), ib - np.repeat(at_b[:-1], n_groups)].ravel())
        self.pairs.add(n_links, flat_a[la] * self.width + flat_b[lb])
        self.odd += odd
        says_a, says_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        cut_a, cut_b = np.r_[0, ia + 1].tolist(), np.r_[0, ib + 1].tolist()
        parts = [",".join(says_a[p:q]) + "|" + ",".join(says_b[r:s]) for p, q, r, s in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        ends = np.cumsum(n_groups).tolist()
        self.shown += [";".join(parts[s:e]).encode() for s, e in zip([0, *ends], ends)]
        self.slot.update(zip(units, range(len(self.slot), len(self.slot) + len(units))))
        self.held += sum(map(len, raw))

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(slots of all units, where each text's end) of texts; none for null
        and empty ones."""
        if len(self.slot) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.clear()
        lists = pc.split_pattern(texts, " ")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        empty = pc.fill_null(pc.equal(texts, ""), False).to_numpy(zero_copy_only=False)
        index = index[~np.repeat(empty, sizes)]
        sizes[empty] = 0
        ends = np.cumsum(sizes)
        void = pc.equal(words, "").to_numpy(zero_copy_only=False)
        blank = void | pc.match_substring_regex(words, BLANK_FIRST).to_numpy(zero_copy_only=False)
        glued = blank[index]                             # no break before these words
        after = np.r_[False, void[index][:-1]] if len(index) else glued
        after[ends[sizes > 0] - sizes[sizes > 0]] = False
        glued |= after
        glued[ends[sizes > 0] - sizes[sizes > 0]] = False
        words = words.to_pylist()
        if glued.any():                                  # join them to the word before
            keep = np.flatnonzero(~glued)
            stop = np.r_[keep[1:], len(index)]
            number = {w: i for i, w in enumerate(words)}
            fresh = index[keep]
            for k in np.flatnonzero(stop - keep > 1).tolist():
                unit = " ".join([words[i] for i in index[keep[k]: stop[k]].tolist()])
                fresh[k] = number.setdefault(unit, len(number))
            ends = np.searchsorted(keep, ends)
            index, words = fresh, list(number)
        used = np.unique(index)                          # parts of glued units need not be known
        known = self.slot
        named = [words[i] for i in used.tolist()]
        self._learn([w for w in named if w not in known])
        slot_of = np.zeros(len(words), np.int64)
        slot_of[used] = np.fromiter(map(known.__getitem__, named), np.int64, len(named))
        return slot_of[index], ends

    def histograms(self, slots: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, pair code, times) of the linked id pairs of texts, sorted."""
        owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
        codes = int(len(self.bytes_a)) * self.width
        cuts = np.cumsum(self.pairs.sizes(slots))
        parts, start = [], 0
        while start < len(slots):
            done = cuts[start - 1] if start else 0
            stop = max(int(np.searchsorted(cuts, done + SEGMENT)), start + 1)
            some = slots[start:stop]
            key = np.repeat(owner[start:stop], self.pairs.sizes(some)) * codes + self.pairs.take(some)
            parts.append(np.unique(key, return_counts=True))
            start = stop
        key, times = added(parts)
        return key // codes, key % codes, times


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their summed counts."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    key, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(place, np.concatenate([n for _, n in parts]), len(key)).astype(np.int64)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One a worker process and pair of vocabularies, kept between tasks."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B)


# ----------------------------------------------------------------------- Spark
def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(doc ids, texts) of about CHUNK bytes."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        for s, e in byte_chunks(sizes, CHUNK):
            yield b.column("doc_id").slice(s, e - s), b.column("text").slice(s, e - s)


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, groups): the groups of every document in order, each with its
    byte offsets in " " + text and the ids of both tokenizers."""
    ship_package(docs.sparkSession)
    path_a, path_b = paths or vocabularies()
    group = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
    schema = pa.schema([("doc_id", pa.int64()), ("groups", pa.list_(group))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        for doc_id, texts in _chunks(batches):
            slots, ends = al.units(texts)
            for i, (s, e) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                groups, offset = [], 0
                for slot in ([] if any(al.odd[k] for k in slots[s:e].tolist()) else slots[s:e].tolist()):
                    one = np.array([slot])
                    a, b, cuts = al.ids_a.take(one), al.ids_b.take(one), al.groups.take(one).reshape(-1, 2)
                    p = q = 0
                    for last_a, last_b in cuts.tolist():
                        size = int(al.long_a[a[p: last_a + 1]].sum())
                        groups.append({"start": offset, "stop": offset + size, "a": a[p: last_a + 1], "b": b[q: last_b + 1]})
                        p, q, offset = last_a + 1, last_b + 1, offset + size
                yield batch(schema, doc_id.slice(i, 1), [groups])

    return _rows(docs).mapInArrow(run, "doc_id long, groups array<struct<start long, stop long, a array<int>, b array<int>>>")


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
ENCODED = "place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary"


def encoded(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row for each document: its counts, the hash of its groups, and its
    linked id pairs as sorted codes with the times each is linked there.
    ``place`` tells rows apart; write the table before using it."""
    ship_package(docs.sparkSession)
    path_a, path_b = paths or vocabularies()
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ENCODED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        place = TaskContext.get().partitionId() << 33
        for doc_id, texts in _chunks(batches):
            slots, ends = al.units(texts)
            odd = np.array(al.odd, bool)[slots]
            owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
            bad = np.bincount(owner[odd], minlength=len(ends)) > 0
            if bad.any():                                # such texts have no tokens at all
                good = ~bad[owner]
                ends, slots, owner = np.cumsum(np.bincount(owner[good], minlength=len(ends))), slots[good], owner[good]
            sums = [np.bincount(owner, s.sizes(slots) // d, len(ends)).astype(np.int64)
                    for s, d in ((al.ids_a, 1), (al.ids_b, 1), (al.groups, 2), (al.pairs, 1))]
            shown, listed = al.shown.__getitem__, slots.tolist()
            hashes = [hashlib.sha256(b";".join(map(shown, listed[s:e]))).hexdigest() if e > s else ""
                      for s, e in zip([0, *ends.tolist()], ends.tolist())]
            text, code, times = al.histograms(slots, ends)
            cuts = np.searchsorted(text, np.arange(len(ends) + 1)).tolist()
            code, times = code.astype("<i8"), times.astype("<i8")
            yield batch(schema, place + np.arange(len(ends)), doc_id, *sums, hashes,
                        [code[s:e].tobytes() for s, e in zip(cuts, cuts[1:])], [times[s:e].tobytes() for s, e in zip(cuts, cuts[1:])])
            place += len(ends)

    return _rows(docs).mapInArrow(run, ENCODED)


def pair_counts(table: DataFrame) -> DataFrame:
    """(code, size): in how many documents of an ``encoded`` table each id pair
    is linked."""
    schema = pa.schema([("code", pa.int64()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            codes = np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(c, "<i8") for c in b.column(0).to_pylist())])
            parts.append(np.unique(codes, return_counts=True))
            held += len(parts[-1][0])
            if held > HELD_PAIRS:
                parts = [added(parts)]
                held = len(parts[0][0])
                if held > HELD_PAIRS // 2:
                    yield from sent(parts.pop())
                    held = 0
        yield from sent(added(parts))

    def sent(part: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(part[0]), 1 << 16):
            yield batch(schema, part[0][s: s + (1 << 16)], part[1][s: s + (1 << 16)])

    return table.select("codes").mapInArrow(run, "code long, size long").groupBy("code").agg(F.sum("size").alias("size"))


def judged(counts: DataFrame, width: int) -> DataFrame:
    """``counts`` with ``best``: is a pair's count its A id's highest?  The highest
    counts are broadcast, one row an id of A's vocabulary."""
    a = F.expr(f"code div {width}")
    top = counts.groupBy(a.alias("a")).agg(F.max("size").alias("most"))
    return counts.join(F.broadcast(top), a == F.col("a")).select("code", "size", (F.col("size") == F.col("most")).alias("best"))


def _scored_in_tasks(table: DataFrame, counts: DataFrame) -> DataFrame:
    """Each task looks the pairs up in sorted arrays."""
    known = counts.orderBy("code").toArrow()
    kept = table.sparkSession.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("code", "size", "best")))
    del known
    ddl = ENCODED.replace("place long, ", "").replace(", codes binary, times binary", "") + ", n_best long, count_sum long"
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, size, best = kept.value
        for b in batches:
            lists = b.column("codes").to_pylist()
            mine = np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(c, "<i8") for c in lists)])
            times = np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(c, "<i8") for c in b.column("times").to_pylist())])
            owner = np.repeat(np.arange(len(lists)), [len(c) // 8 for c in lists])
            at = np.searchsorted(code, mine)
            sums = [np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)]
            np.add.at(sums[0], owner, times * best[at])
            np.add.at(sums[1], owner, times * size[at])
            yield batch(schema, *(b.column(c) for c in schema.names[:-2]), *sums)

    return table.mapInArrow(run, ddl)


def _scored_by_join(table: DataFrame, counts: DataFrame, scratch: Scratch) -> DataFrame:
    """The same through a shuffle of (document, pair) rows."""
    ddl = "place long, code long, times long"
    schema = pa.schema([(c.split()[0], pa.int64()) for c in ddl.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place, codes, times in zip(*(b.column(c).to_pylist() for c in ("place", "codes", "times"))):
                if codes:
                    code = np.frombuffer(codes, "<i8")
                    yield batch(schema, np.full(len(code), place), code, np.frombuffer(times, "<i8"))

    links = table.select("place", "codes", "times").mapInArrow(run, ddl)
    counts = scratch.keep(counts)
    total = counts.agg(F.sum("size")).first()[0] or 0
    sums = join_groups(links, counts, ["code"], total).groupBy("place").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("size")).alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return table.join(sums, "place", "left").select("doc_id", *COUNTS, "groups_sha256", *zero)


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of
    every document."""
    from sentencepiece import SentencePieceProcessor

    paths = paths or vocabularies()
    scratch = Scratch(docs.sparkSession, "alignment")
    table = scratch.keep(encoded(docs, paths))
    raw = scratch.keep(pair_counts(table))
    counts = judged(raw, SentencePieceProcessor(model_file=paths[1]).get_piece_size())
    out = _scored_in_tasks(table, counts) if raw.count() <= broadcast_pairs else _scored_by_join(table, counts, scratch)
    return out.select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
