"""Fuzzy line dedup: MinHash bands, exact Jaccard, distributed union-find.

A line's shingles are its runs of five characters; a shorter line is one
shingle.  Two lines are near when the Jaccard similarity of their shingle sets is
at least 0.8.  One line of each connected component stays: the one that comes
first, by document id and line number.  Lines of white space alone are
structure: they always stay and take no part.

1. ``write_blocks``: each task writes its rows as blocks of about ``BLOCK_BYTES`` of
   text into one file in the shared folder; texts are never shuffled.
2. Equal lines are one: blocks ask ranges of 128-bit line hashes which of their
   lines occur elsewhere, and the first block that has a line owns it.  Only
   owned lines go on, so copies make no keys and no pairs.
3. ``signature``: the smallest hash of a line's shingles under ``ROWS`` different
   mixings, each cut into ``BANDS`` equal parts (an empty part takes the next one's
   value).  Band j is the j-th value of every mixing, so it is never one shingle
   alone, however short the line.  Lines at similarity 0.8 share a band with
   probability 0.99, at 0.9 with 0.9999.
4. Blocks ask ranges of band keys which ones occur twice.  Only lines that share
   a key with a different line leave their block, with their text.
5. Ranges of band keys get the lines of each key, not as texts but as their number
   of shingles and their marks (``MARKS`` words; near lines differ in few bits), and
   say which pairs the marks leave open: no near pair fails that test (``alike``).
   A key's lines first meet one of them only (its head, chosen by one of ``ORDERS``
   hashes), and the verified links are clustered.  Then all lines of a key meet those
   of other clusters, however many they are: there is no cap, and pairs that the marks
   refute never become rows.  A key of over ``PIECE`` lines is dealt in tiles.
6. Every pair left is verified on the two lines' shingle sets.  Clusters come from a
   distributed union-find.

Steps 1 to 4 and the verification run numpy and Python sets inside tasks: as
DataFrame functions the signatures alone took 866 CPU seconds a GB of a budget
of 400 (see the README).

Null texts have no lines.  Rows are told apart by id and text: of several rows of
one id, or without one, each loses only its own lines; rows that agree in both
are one run of places and get equal results.  Rows without an id come last in
the order, equal ids by a hash of their text.  A text longer than a block is
one block.  An empty table gives an empty table; extra columns of any name and
type are ignored, and returned by ``dedup_lines``.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import Scratch, _located, batch, byte_chunks, join_groups, open_output, shared_folder, ship_package, split_count
from plantlens.llm.components import connected_components
from plantlens.llm.substring_dedup import HEAD, MOST_TASKS, _loose, _squeezed, judge, range_of_hash, ranked, spread

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 5, 12
OPEN_LINES = 32                  # keys of more lines have their pairs dealt in tiles
PIECE = 4096                     # lines of a key that meet as many others in a task
ORDERS = 4                       # hashes that choose heads
MARKS = 16                       # words of 64 bits that mark a line's shingles
SKETCH_SHARE = 0.6               # of a sketch's bytes that two near lines agree in (19,999 of 20,000)
BLOCK_BYTES = 12 << 20
RANGE_KEYS = 4_000_000
RANGE_ROWS = 50_000              # lines of a range of band keys, each with its marks
HELD_ROWS = 200_000              # of them that a task deals at once
PAIRS_AT_ONCE = 1 << 17
STEP = 1 << 17                   # characters hashed at once
NOTHING = np.uint64((1 << 64) - 1)
BLANKS = b" \t\r\x0b\x0c"


# ------------------------------------------------------------------- signatures
def shingles(line: str) -> set[str]:
    return {line[i: i + SHINGLE] for i in range(max(len(line) - SHINGLE, 0) + 1)}


def near(a: set[str], b: set[str], similarity: float = SIMILARITY) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    common = len(a & b)
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ np.uint64(seed * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def _shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of its line) of every shingle, repeats included."""
    text = "".join([x.ljust(SHINGLE, "\U0010ffff") + "\n" for x in lines])
    s = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(len(s) - SHINGLE + 1, 0)
    size = np.array([max(len(x), SHINGLE) for x in lines], np.int64)
    h, inside = np.zeros(n, np.uint64), np.ones(len(s) + 1, bool)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            h ^= s[k: n + k]
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
    ends = np.cumsum(size + 1)                             # the last places of a line begin no shingle of it
    for k in range(SHINGLE):
        inside[ends - SHINGLE + k] = False
    return h[inside[:n]], np.repeat(np.arange(len(lines)), size - SHINGLE + 1)


def _minima(lines: list[str]) -> np.ndarray:
    """(lines, ROWS, BANDS) smallest hashes, empty parts filled."""
    h, line = _shingle_hashes(lines)
    base = line * BANDS
    out = np.full((ROWS, len(lines) * BANDS), NOTHING)
    for row in range(ROWS):
        v = _mixed(h, 1 + row)
        at = v >> np.uint64(32)
        at *= np.uint64(BANDS)
        at >>= np.uint64(32)
        at = at.view(np.int64)
        at += base
        np.minimum.at(out[row], at, v)
    out = out.reshape(ROWS, len(lines), BANDS)
    for _ in range(BANDS):
        empty = out == NOTHING
        if not empty.any():
            break
        out[empty] = np.roll(out, -1, axis=2)[empty]
    return out


def signature(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(lines, BANDS) band keys, and the sketches: a byte of every smallest hash (they
    estimate the similarity of two lines; no step drops a pair by them)."""
    keys, sketches = [np.zeros((0, BANDS), np.uint64)], [np.zeros((0, ROWS * BANDS), np.uint8)]
    for s, e in byte_chunks(np.array([len(x) + 1 for x in lines], np.int64), STEP):
        low = _minima(lines[s:e])
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), low.shape[1:])
        for row in range(ROWS):
            key = _mixed(key ^ low[row], 77 + row)
        keys.append(key)
        sketches.append((low & np.uint64(255)).astype(np.uint8).transpose(1, 0, 2).reshape(e - s, -1))
    return np.concatenate(keys), np.concatenate(sketches)


# ----------------------------------------------------------------------- blocks
class LineBlock:
    """A block read back: documents and their lines."""

    def __init__(self, path: str, offset: int, length: int):
        system, where = _located(path)
        with system.open_input_file(where) as file:
            raw = file.read_at(length, offset)
        at, parts = HEAD.size, []
        for n in HEAD.unpack_from(raw):
            parts.append(raw[at: at + n])
            at += n
        docs = _loose(parts[0], "<i8").reshape(4, -1)
        self.ids, self.nulls, self.text_keys, self.counts = docs[0], docs[1].astype(bool), docs[2], docs[3]
        self._size, self._letters = parts[1], parts[2]
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.number = np.arange(len(self.doc)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)

    @cached_property
    def lines(self) -> list[bytes]:
        size, letters = _loose(self._size, "<u4"), _loose(self._letters, np.uint8).tobytes()
        ends = np.cumsum(size, dtype=np.int64).tolist()
        return [letters[s:e] for s, e in zip([0, *ends], ends)]

    def different(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(places of the lines that take part, which different line each is,
        the different lines)."""
        found: dict[bytes, int] = {}
        at = [i for i, x in enumerate(self.lines) if x.strip(BLANKS)]
        which = [found.setdefault(self.lines[i], len(found)) for i in at]
        return np.array(at, np.int64), np.array(which, np.int64), list(found)


def line_hashes(lines: list[bytes]) -> list[np.ndarray]:
    import xxhash

    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), "<u8").reshape(-1, 2)
    return [both[:, 0].copy(), both[:, 1].copy()]


def block_bytes(doc_ids: list[int | None], keys: list[int], texts: pa.Array) -> tuple[bytes, int]:
    lists = pc.split_pattern(texts, "\n")
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype("<i8")
    flat = lists.flatten().cast(pa.large_binary())
    _, ends, raw = flat.buffers()
    ends = np.frombuffer(ends, np.int64)[flat.offset: flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    size, letters = np.diff(ends).astype("<u4"), np.frombuffer(raw or b"", np.uint8)[ends[0]: ends[-1]]
    docs = np.r_[np.array([0 if d is None else d for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], "<i8"),
                 np.array(keys, "<i8"), counts]
    parts = [_squeezed(x) for x in (docs, size, letters)] + [b""]
    return HEAD.pack(*map(len, parts)) + b"".join(parts), len(size)


def row_key(docs: DataFrame) -> list[Column]:
    """What tells a row from others: its id and a hash of its text."""
    return [docs["doc_id"].cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("text_key")]


MANIFEST = "task long, path string, start long, length long, lines long"


def write_blocks(docs: DataFrame, folder: str, block_size: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` as blocks in files below ``folder``; one row a block."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("task", pa.int64()), ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("lines", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        path, out, start, ids, keys, held, size = f"{folder}/{uuid.uuid4().hex}.lines", None, 0, [], [], [], 0

        def written() -> Iterator[pa.RecordBatch]:
            nonlocal out, start, task
            raw, n = block_bytes(ids, keys, pa.concat_arrays(held))
            out = out or open_output(path)
            out.write(raw)
            yield batch(schema, [task], [path], [start], [len(raw)], [n])
            start, task = start + len(raw), task + 1

        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False)
            for s, e in byte_chunks(sizes, max(block_size // 4, 1)):
                ids += b.column(0).slice(s, e - s).to_pylist()
                keys += b.column(1).slice(s, e - s).to_pylist()
                held.append(b.column(2).slice(s, e - s))
                size += int(sizes[s:e].sum())
                if size >= block_size:
                    yield from written()
                    ids, keys, held, size = [], [], [], 0
        if ids:
            yield from written()
        if out is not None:
            out.close()

    return docs.select(*row_key(docs), docs["text"].cast("string").alias("text")).mapInArrow(run, MANIFEST)


def _each_block(blocks: DataFrame, tasks: int, **state: DataFrame) -> DataFrame:
    """One row a block with what the steps before say about it: for each table
    of ``state`` (block and other columns) an array of its rows."""
    rows = blocks.select("block", "path", "start", "length")
    for name, table in state.items():
        rest = [c for c in table.columns if c != "block"]
        told = table.groupBy("block").agg(F.collect_list(F.struct(*rest)).alias(name))
        rows = rows.join(told, "block", "left")
    return rows.repartitionById(tasks, F.pmod(F.col("block"), F.lit(tasks)).cast("int"))


ASKED = "block long, part int, hashes binary"
ASKED_SCHEMA = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("hashes", pa.binary())])


def _questions(number: int, different: list[np.ndarray], again: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows of ASKED for sorted different hashes; ``again`` marks those that the
    block holds more than once."""
    part = range_of_hash(different[0], ranges)
    cuts = np.flatnonzero(np.r_[len(part) > 0, part[1:] != part[:-1]])
    for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
        step = different[0][s:e].copy()
        step[1:] = step[1:] - step[:-1]
        flags = np.packbits(np.r_[again[s:e], np.zeros(-(e - s) % 64, bool)]).view("<u8")
        blob = np.concatenate([np.array([e - s], "<u8"), step, *[d[s:e] for d in different[1:]], flags])
        yield batch(ASKED_SCHEMA, [number], [int(part[s])], [_squeezed(blob)])


def _answered(first: np.ndarray, answers: list[dict], field: str, ranges: int) -> np.ndarray:
    """The answer bit of each of a block's sorted different hashes."""
    told = {a["part"]: a[field] for a in answers or ()}
    part = range_of_hash(first, ranges)
    out, cuts = np.zeros(len(part), bool), np.searchsorted(part, np.arange(ranges + 1))
    for r in np.unique(part).tolist():
        s, e = cuts[r], cuts[r + 1]
        out[s:e] = np.unpackbits(_loose(told[r], np.uint8), count=e - s).astype(bool)
    return out


def owners(asked: DataFrame) -> DataFrame:
    """(block, part, copied, owned): for each line hash that a block asked about,
    whether the line occurs twice anywhere, and whether the block is its first."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("copied", pa.binary()), ("owned", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        sizes, a, b, again = [], [], [], []
        for raw in table.column("hashes"):
            values = _loose(raw.as_py(), "<u8")
            n, values = int(values[0]), values[1:]
            sizes.append(n)
            a.append(np.cumsum(values[:n], dtype=np.uint64))
            b.append(values[n: 2 * n])
            again.append(np.unpackbits(values[2 * n:].view(np.uint8), count=n).astype(bool))
        found, place, count = ranked([np.concatenate(a), np.concatenate(b)])
        twice = count > 1
        twice[place[np.concatenate(again)]] = True
        first = np.zeros(len(place), bool)
        first[np.unique(place, return_index=True)[1]] = True           # blocks come in rising order
        ends = np.cumsum(sizes).tolist()
        cut = [(s, e) for s, e in zip([0, *ends], ends)]
        return pa.Table.from_arrays(
            [table.column("block").combine_chunks(), table.column("part").combine_chunks(),
             pa.array([_squeezed(np.packbits(twice[place[s:e]])) for s, e in cut], pa.binary()),
             pa.array([_squeezed(np.packbits(first[s:e])) for s, e in cut], pa.binary())], schema=schema)

    return asked.groupBy("part").applyInArrow(run, "block long, part int, copied binary, owned binary")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for row in b.to_pylist():
            yield row | {"lines": LineBlock(row["path"], row["start"], row["length"])}


def ask_lines(rows: DataFrame, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _opened(batches):
            _, which, lines = row["lines"].different()
            hashes, place, _ = ranked(line_hashes(lines))
            times = np.bincount(place[which], minlength=len(lines))
            yield from _questions(row["block"], hashes, times > 1, ranges)

    return rows.mapInArrow(run, ASKED)


def _told(row: dict, ranges: int) -> tuple:
    """(places, which different line each is, the lines, their hashes, copied, owned)."""
    at, which, lines = row["lines"].different()
    hashes = line_hashes(lines)
    different, place, _ = ranked(hashes)
    copied, owned = (_answered(different[0], row["told"], f, ranges)[place] if len(lines) else np.zeros(0, bool)
                     for f in ("copied", "owned"))
    return at, which, lines, hashes, copied, owned


def ask_bands(rows: DataFrame, ranges: int, band_ranges: int) -> DataFrame:
    """Rows of ASKED for the band keys of owned lines, and with ``part`` -1 the keys
    of all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _opened(batches):
            _, _, lines, _, _, owned = _told(row, ranges)
            keys, _ = signature([lines[i].decode() for i in np.flatnonzero(owned).tolist()])
            yield batch(ASKED_SCHEMA, [row["block"]], [-1], [_squeezed(keys)])
            different, _, count = ranked([keys.ravel()])
            yield from _questions(row["block"], different, count > 1, band_ranges)

    return rows.mapInArrow(run, ASKED)


FOUND = ("candidate boolean, block long, doc int, doc_id long, text_key long, line_no int, a long, b long, line string, "
         "keys array<long>")


def candidates(rows: DataFrame, ranges: int, band_ranges: int) -> DataFrame:
    """Rows of FOUND: each owned line that shares a band key, with its text and
    those keys (``candidate``), and all places of lines that may have to go."""
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _opened(batches):
            block: LineBlock = row["lines"]
            at, which, lines, (a, b), copied, owned = _told(row, ranges)
            a, b = a.view(np.int64), b.view(np.int64)
            mine = np.flatnonzero(owned)
            made = {x["part"]: x["hashes"] for x in row["made"]}
            keys = _loose(made[-1], "<u8").reshape(-1, BANDS)
            different, place, _ = ranked([keys.ravel()])
            twice = _answered(different[0], row["answers"], "mask", band_ranges)[place].reshape(-1, BANDS)
            wanted = np.flatnonzero(twice.any(1))
            for s in range(0, len(wanted), 4096):
                some = wanted[s: s + 4096]
                k, none = mine[some], [None] * len(some)
                yield batch(schema, [True] * len(some), [row["block"]] * len(some), none, none, none, none, a[k], b[k],
                            [lines[i].decode() for i in k.tolist()], [keys[i][twice[i]].view(np.int64) for i in some])
            may_go = copied.copy()
            may_go[mine[wanted]] = True
            place = np.flatnonzero(may_go[which])
            for s in range(0, len(place), 1 << 16):
                some = place[s: s + (1 << 16)]
                i, k = at[some], which[some]
                doc, none = block.doc[i], pa.nulls(len(some))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([False] * len(some)), pa.array([row["block"]] * len(some), pa.int64()), pa.array(doc, pa.int32()),
                     pa.array(block.ids[doc], pa.int64(), mask=block.nulls[doc]), pa.array(block.text_keys[doc], pa.int64()),
                     pa.array(block.number[i], pa.int32()), pa.array(a[k], pa.int64()), pa.array(b[k], pa.int64()),
                     none.cast(pa.string()), none.cast(pa.list_(pa.int64()))], schema=schema)

    return rows.mapInArrow(run, FOUND)


# ------------------------------------------------------------------------- links
def verified(pairs: DataFrame, texts: DataFrame, similarity: float, tiles: int = 0) -> DataFrame:
    """The pairs (x, y) of lines whose shingle sets are similar enough.  ``tiles``: the
    pairs (few bytes of ids, but much work) are dealt in ``tiles`` x ``tiles`` parts first."""
    if tiles:
        part = [F.pmod(F.xxhash64(c), F.lit(tiles)) for c in ("x", "y")]
        pairs = pairs.repartition(split_count(pairs.sparkSession), *part).sortWithinPartitions(*part, "y", "x")
    both = (pairs.join(texts.select(F.col("a").alias("x"), F.col("line").alias("line_x")), "x")
            .join(texts.select(F.col("a").alias("y"), F.col("line").alias("line_y")), "y").select("x", "y", "line_x", "line_y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, last, of_last = [], None, None
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if y != last:                                             # the join leaves the pairs of one y together
                    last, of_last = y, shingles(y)
                keep.append(near(shingles(x), of_last, similarity))
            yield b.filter(pa.array(keep, pa.bool_())).select(["x", "y"])

    return both.mapInArrow(run, "x long, y long")


def different_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The different shingle hashes (44 bits) of each line, one line after the other,
    and how many.  At most 2 ** 20 lines."""
    h, line = _shingle_hashes(lines)
    h = np.sort(line.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20))
    h = h[np.r_[True, h[1:] != h[:-1]]]
    return h & np.uint64((1 << 44) - 1), np.bincount((h >> np.uint64(44)).astype(np.int64), minlength=len(lines))


def marks(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(MARKS, lines) words: a bit is 1 if an odd number of the line's different
    hashes falls on it.  So two lines differ in no more bits than shingles."""
    out = np.zeros(len(n) * MARKS, np.uint64)
    word = np.repeat(np.arange(len(n)), n) * MARKS + (h >> np.uint64(6)).astype(np.int64) % MARKS
    np.bitwise_xor.at(out, word, np.uint64(1) << (h & np.uint64(63)))
    return out.reshape(-1, MARKS).T


def alike(rows: np.ndarray, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the marks of ``rows`` (ROW) x[i] and y[i] leave it open that they are near:
    near lines of n and m shingles differ in at most ``(1 - s) / (1 + s) * (n + m)`` of them,
    and their marks in no more bits.  Spare bits make up for equal hashes in a line."""
    n, words = rows["n"].astype(np.int64), rows["marks"]
    open_ = np.flatnonzero(np.minimum(n[x], n[y]) + 2 >= similarity * np.maximum(n[x], n[y]))
    bits = np.zeros(len(open_), np.int64)
    for s in range(0, MARKS, MARKS // 2):                                 # half the marks refute most
        p, q = x[open_], y[open_]
        bits += np.bitwise_count(words[p, s: s + MARKS // 2] ^ words[q, s: s + MARKS // 2]).sum(1, dtype=np.int64)
        stay = bits <= (n[p] + n[q]) * ((1 - similarity) / (1 + similarity)) + 2
        open_, bits = open_[stay], bits[stay]
    out = np.zeros(len(x), bool)
    out[open_] = True
    return out


ROW = np.dtype([("key", "<u8"), ("a", "<i8"), ("c", "<i8"), ("n", "<i4"), ("marks", "<u8", MARKS)])     # a line of a key


def _marked(texts: DataFrame) -> DataFrame:
    """(a, n, marks, keys): the number of different shingles of each line and their marks."""
    schema = pa.schema([("a", pa.int64()), ("n", pa.int32()), ("marks", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = b.column(1).to_pylist()
            for s, e in byte_chunks(np.array([len(x) + 1 for x in lines], np.int64), STEP):
                h, n = different_hashes(lines[s:e])
                words = np.ascontiguousarray(marks(h, n).T)
                yield batch(schema, b.column(0).slice(s, e - s), n, [w.tobytes() for w in words], b.column(2).slice(s, e - s))

    return texts.select("a", "line", "keys").mapInArrow(run, "a long, n int, marks binary, keys array<long>")


def _by_key(marked: DataFrame, ranges: int) -> DataFrame:
    """(part, rows): the lines of each range of band keys, as runs of ROW.
    ``marked`` has (a, c, n, marks, keys)."""
    schema = pa.schema([("part", pa.int32()), ("rows", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def dealt() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            part = range_of_hash(rows["key"], ranges)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(ranges + 1)).tolist()
            told = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
            yield batch(schema, told, [rows[order[cuts[r]: cuts[r + 1]]].tobytes() for r in told])

        for b in batches:
            keys = b.column(4)
            times = pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False)
            line = np.repeat(np.arange(b.num_rows), times)
            rows = np.zeros(len(line), ROW)
            rows["key"] = keys.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            for name, k in (("a", 0), ("c", 1), ("n", 2)):
                rows[name] = b.column(k).to_numpy(zero_copy_only=False)[line]
            rows["marks"] = np.frombuffer(b"".join(b.column(3).to_pylist()), "<u8").reshape(-1, MARKS)[line]
            held.append(rows)
            size += len(rows)
            if size >= HELD_ROWS:
                yield from dealt()
                held, size = [], 0
        if size:
            yield from dealt()

    return marked.select("a", "c", "n", "marks", "keys").mapInArrow(run, "part int, rows binary")


def _groups(rows: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows in ``order``, in which each key's stand together; where those of each
    key begin, and how many they are."""
    rows = rows[order]
    first = np.flatnonzero(np.r_[len(rows) > 0, rows["key"][1:] != rows["key"][:-1]])
    return rows, first, np.diff(np.r_[first, len(rows)])


PAIRS = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("large", pa.bool_()), ("tile", pa.int32()), ("rows", pa.binary())])
PAIRS_SCHEMA = "x long, y long, large boolean, tile int, rows binary"


def _told_rows(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("rows").to_pylist()), ROW)


def _pairs(x: np.ndarray, y: np.ndarray, large: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(x))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(large), none.cast(pa.int32()),
                                       none.cast(pa.binary())], schema=PAIRS)


def star_pairs(dealt: DataFrame, similarity: float) -> DataFrame:
    """(x, y): each line of a key with the key's head, where the marks leave it open."""
    def run(table: pa.Table) -> pa.Table:
        rows = _told_rows(table)
        by = np.zeros(len(rows), np.uint64)
        for k in range(ORDERS):
            some = rows["key"] % np.uint64(ORDERS) == k
            by[some] = _mixed(rows["a"][some].view(np.uint64), 99 + k)
        rows, first, size = _groups(rows, np.lexsort((by, rows["key"])))
        head, at = np.repeat(first, size), np.arange(len(rows))
        other = rows["a"][head] != rows["a"]
        head, at = head[other], at[other]
        keep = alike(rows, head, at, similarity)
        x, y = rows["a"][head[keep]], rows["a"][at[keep]]
        return pa.Table.from_batches([_pairs(x, y, np.zeros(len(x), bool))]).select(["x", "y"])

    return dealt.groupBy("part").applyInArrow(run, "x long, y long").distinct()


def across(rows: np.ndarray, first: np.ndarray, last: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of row i with first[i] to last[i] - 1, of different clusters,
    that the marks leave open; about PAIRS_AT_ONCE are looked at together."""
    size = np.maximum(last - first, 0)
    for s, e in byte_chunks(size, PAIRS_AT_ONCE):
        x, y = np.repeat(np.arange(s, e), size[s:e]), spread(first[s:e], size[s:e])
        other = np.flatnonzero(rows["c"][x] != rows["c"][y])
        x, y = x[other], y[other]
        keep = alike(rows, x, y, similarity)
        if keep.any():
            yield x[keep], y[keep]


def across_pairs(dealt: DataFrame, similarity: float, open_lines: int, piece: int) -> DataFrame:
    """(x, y, large): all pairs of lines of a key in different clusters that the marks
    leave open; ``large`` for keys of over ``open_lines`` lines.  Keys of over ``piece``
    lines leave as tiles of two pieces, so that many tasks share their pairs."""
    def run(table: pa.Table) -> pa.Table:
        rows = _told_rows(table)
        rows, first, size = _groups(rows, np.lexsort((rows["a"], rows["key"])))
        out = [_pairs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
        split = np.minimum.reduceat(rows["c"], first) != np.maximum.reduceat(rows["c"], first)
        wanted = split & (size > 2) & (size <= piece)                     # two lines have met in the star
        mine = np.repeat(wanted, size)
        ends = np.where(mine, np.repeat(first + size, size), 0)
        large = np.repeat(size > open_lines, size)
        for x, y in across(rows, np.arange(1, len(rows) + 1), ends, similarity):
            out.append(_pairs(rows["a"][x], rows["a"][y], large[x]))
        for s, n in zip(first[split & (size > piece)].tolist(), size[split & (size > piece)].tolist()):
            for i in range(s, s + n, piece):
                for j in range(i, s + n, piece):
                    p, q = rows[i: min(i + piece, s + n)], rows[j: min(j + piece, s + n)]
                    out.append(batch(PAIRS, [None], [None], [n > open_lines], [len(p) if j > i else 0], [p.tobytes() + (q.tobytes() if j > i else b"")]))
        return pa.Table.from_batches(out)

    return dealt.groupBy("part").applyInArrow(run, PAIRS_SCHEMA)


def tile_pairs(tiles: DataFrame, similarity: float) -> DataFrame:
    """(x, y, large) of tiles: the first ``tile`` rows meet the others, or all meet all if 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for large, edge, raw in zip(*(b.column(k).to_pylist() for k in range(3))):
                rows = np.frombuffer(raw, ROW)
                n, at = len(rows), np.arange(len(rows))
                first = np.where(at < edge, edge, n) if edge else at + 1
                for x, y in across(rows, first, np.full(n, n), similarity):
                    yield _pairs(rows["a"][x], rows["a"][y], np.full(len(x), large)).select(["x", "y", "large"])

    dealt = tiles.select("large", "tile", "rows").repartition(split_count(tiles.sparkSession), F.xxhash64("rows"))
    return dealt.mapInArrow(run, "x long, y long, large boolean")


def _lines_of(pairs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, line) of the lines of ``pairs`` (x, y): few of ``texts``, shuffled once here."""
    ends = pairs.select(F.col("x").alias("a")).union(pairs.select(F.col("y").alias("a"))).distinct()
    return scratch.keep(texts.select("a", "line").join(ends, "a", "left_semi"))


def line_links(texts: DataFrame, scratch: Scratch, similarity: float = SIMILARITY, open_lines: int = OPEN_LINES) -> DataFrame:
    """(x, y): verified links that join every component of the lines ``texts``
    (a, line, keys, ...), found as the module text says."""
    marked = scratch.keep(_marked(texts), dictionary=False)
    total = marked.agg(F.sum(F.size("keys"))).first()[0] or 0
    ranges = max(math.ceil(total / RANGE_ROWS), 1)
    star = scratch.keep(star_pairs(_by_key(marked.withColumn("c", F.col("a")), ranges), similarity))
    links = scratch.keep(verified(star, _lines_of(star, texts, scratch), similarity))
    cluster = scratch.keep(connected_components(links).toDF("a", "c"))
    placed = marked.join(cluster, "a", "left").withColumn("c", F.coalesce("c", "a"))
    found = scratch.keep(across_pairs(_by_key(placed, ranges), similarity, open_lines, PIECE))
    tiles = found.filter("rows is not null")
    pairs = found.filter("rows is null").select("x", "y", "large")
    if not tiles.isEmpty():
        pairs = pairs.union(tile_pairs(tiles, similarity))
    pairs = scratch.keep(pairs.groupBy("x", "y").agg(F.min("large").alias("large")))
    scratch.drop(marked, star, found)
    texts = _lines_of(pairs, texts, scratch)
    few = verified(pairs.filter("not large").select("x", "y"), texts, similarity)
    large = verified(pairs.filter("large").select("x", "y"), texts, similarity, max(math.ceil(total / RANGE_ROWS), 1))
    more = scratch.keep(few.union(large))
    scratch.drop(pairs)
    return cluster.filter("a <> c").select(F.col("c").alias("x"), F.col("a").alias("y")).union(more)


# -------------------------------------------------------------------------- runs
class Removal:
    """The lines of ``docs`` that go: ``removed`` has (block, doc, doc_id,
    text_key, line_no), ``blocks`` the texts."""

    def __init__(self, docs: DataFrame, similarity: float = SIMILARITY, open_lines: int = OPEN_LINES,
                 block_size: int = BLOCK_BYTES, range_keys: int = RANGE_KEYS):
        spark = docs.sparkSession
        scratch = Scratch(spark, "lines")
        manifest = scratch.keep(write_blocks(docs, shared_folder(spark, "line-blocks"), block_size))
        # one narrow row a block, numbered from 0
        self.blocks = manifest.withColumn("block", (F.row_number().over(Window.orderBy("task", "path")) - 1).cast("long"))
        size = self.blocks.agg(F.count("*").alias("n"), F.sum("lines").alias("lines")).first()
        self.tasks = min(max(size.n, 1), MOST_TASKS * split_count(spark))
        ranges = max(math.ceil((size.lines or 0) / range_keys), 1)
        band_ranges = max(math.ceil((size.lines or 0) * BANDS / range_keys), 1)
        asked = scratch.keep(ask_lines(_each_block(self.blocks, self.tasks), ranges))
        told = scratch.keep(owners(asked))
        scratch.drop(asked)
        asked = scratch.keep(ask_bands(_each_block(self.blocks, self.tasks, told=told), ranges, band_ranges))
        answers = scratch.keep(judge(asked, 64))
        made = asked.filter("part < 0").select("block", "part", "hashes")
        found = scratch.keep(candidates(_each_block(self.blocks, self.tasks, told=told, made=made, answers=answers), ranges, band_ranges))
        scratch.drop(asked, told, answers)
        texts = found.filter("candidate").select("a", "line", "keys")
        links = line_links(texts, scratch, similarity, open_lines)
        near_lines = scratch.keep(connected_components(links).toDF("a", "root"))
        self.removed = scratch.keep(_later_places(found.filter("not candidate"), near_lines, scratch))
        scratch.drop(found, near_lines)


def _later_places(places: DataFrame, near_lines: DataFrame, scratch: Scratch) -> DataFrame:
    """The places that come after the first of their group.  Equal lines are
    reduced to their first place before groups are formed."""
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "line_no")
    lines = places.groupBy("a", "b").agg(F.min(at).alias("first"), F.count("*").alias("size")).join(near_lines, "a", "left")
    lines = scratch.keep(lines.filter("root is not null or size > 1"))                    # of the others no place goes
    least = lines.filter("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    lines = scratch.keep(lines.join(least, "root", "left").select("a", "b", "size", F.coalesce("least", "first").alias("least")))
    total = lines.agg(F.sum("size")).first()[0] or 0
    joined = join_groups(places.select("block", "doc", "doc_id", "text_key", "line_no", "a", "b"), lines, ["a", "b"], total)
    return joined.filter(at > F.col("least")).select("block", "doc", "doc_id", "text_key", "line_no")


def repeats(docs: DataFrame, similarity: float = SIMILARITY, **options) -> DataFrame:
    """(doc_id, line_no) of every line that goes."""
    return Removal(docs, similarity, **options).removed.select("doc_id", "line_no")


def line_report(docs: DataFrame, similarity: float = SIMILARITY, **options) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (line numbers, rising, joined
    by commas) of every row."""
    r = Removal(docs, similarity, **options)
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("removed_lines", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _opened(batches):
            block: LineBlock = row["lines"]
            gone: dict[int, list[int]] = {}
            for x in row["removed"] or ():
                gone.setdefault(x["doc"], []).append(x["line_no"])
            lists = [sorted(gone.get(i, ())) for i in range(len(block.ids))]
            yield batch(schema, pa.array(block.ids, mask=block.nulls), block.counts, list(map(len, lists)), [",".join(map(str, x)) for x in lists])

    rows = _each_block(r.blocks, r.tasks, removed=r.removed.select("block", "doc", "line_no"))     # at most a block's lines
    return rows.mapInArrow(run, "doc_id long, n_lines long, n_removed long, removed_lines string")


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, **options) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``."""
    gone = Removal(docs, similarity, **options).removed.groupBy(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.collect_set("line_no").alias("gone"))
    rows = docs.select(*row_key(docs), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    out = rows.join(gone, rows["doc_id"].eqNullSafe(gone["id"]) & (rows["text_key"] == gone["key"]), "left")
    kept = F.filter(F.split("row.text", "\n"), lambda x, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return out.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
