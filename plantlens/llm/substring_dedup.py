"""Substring dedup: level-wise doubling from short windows to long ones.

A window of ``WINDOW`` (35) consecutive words is *repeated* when its words also
start anywhere else, in the same text or another.  Every word that a repeated
window covers is removed; windows are judged on the input.

Windows are tested at 9, 18 and 35 words.  All nine-word windows are candidates at
first.  At each level, windows that occur once are dropped; a run of survivors is
extended to windows of twice the length (of 35 words at last), which start only
where every shorter window inside them survived.  A run that is too short to
hold a window of 35 words is dropped at once, so in texts of their own next to
nothing is left after the first level.

No window travels by itself:

1. ``write_blocks``: each task writes its rows as *blocks* of about
   ``BLOCK_BYTES`` of text into one file in the shared folder: the different words
   once and a number for each word.  All levels read these blocks, so texts are
   split once and never shuffled.
2. ``ask``: a block hashes its candidate windows and sends the different hashes,
   sorted, as compressed differences, one row for each range of hashes.  At the
   first levels a hash has a few bits more than the number of windows needs (a
   false hit only keeps a candidate for a level); at the last it has 128 bits.
3. ``judge``: a range's rows meet in one task, which tells every block by one bit
   a hash whether the hash occurs twice.  A passage that a third of all texts
   share is one hash a block, so no range is hot; ranges are as many as keep
   each to about ``RANGE_WINDOWS`` windows.
4. The block applies the bits at the next level, and after the last one covers
   its words.

A level's tables are deleted when the next level has been written.

Words are runs of anything but ASCII white space, unchanged.  Null texts have
none.  Rows of equal id and text count as separate places and get equal results;
rows without an id are handled like others.  A text longer than a block is one
block, so a task holds at least its longest text.  A lost task writes its
blocks anew under another name; files count once their rows arrive.  An empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import Scratch, _located, batch, byte_chunks, open_output, shared_folder, ship_package, split_count

WINDOW = 35
SHORTEST = 9
BLOCK_BYTES = 12 << 20
RANGE_WINDOWS = 4_000_000
SPARE_BITS = 6                    # bits of a hash beyond the count of windows
MOST_TASKS = 64                   # tasks a level, for each shuffle partition

HEAD = struct.Struct("<4Q")
FACTOR = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def levels_of(window: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths from the shortest to ``window``, each at most double."""
    out = [window]
    while out[0] > shortest:
        out.insert(0, -(-out[0] // 2))
    return out


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


# ---------------------------------------------------------------------- blocks
def _squeezed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _loose(raw: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(words per text, code of each word, the different words) of texts."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    real = (pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)[codes] if len(words) else np.zeros(0, bool)
    before = np.r_[0, np.cumsum(real)]
    return np.diff(before[offsets - offsets[0]]), codes[real], words


def block_bytes(doc_ids: list[int | None], texts: pa.Array) -> tuple[bytes, int]:
    sizes, codes, words = words_of(texts)
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype("<u4")
    letters = np.frombuffer("".join(words.to_pylist()).encode(), np.uint8)
    parts = [_squeezed(x) for x in (np.r_[ids, nulls.astype("<i8"), sizes.astype("<i8")], codes.astype("<u4"), size, letters)]
    return HEAD.pack(*map(len, parts)) + b"".join(parts), len(codes)


class Block:
    """A block read back: documents, their words' codes, the different words."""

    def __init__(self, path: str, offset: int, length: int):
        system, where = _located(path)
        with system.open_input_file(where) as file:
            raw = file.read_at(length, offset)
        at, parts = HEAD.size, []
        for n in HEAD.unpack_from(raw):
            parts.append(raw[at: at + n])
            at += n
        docs = _loose(parts[0], "<i8").reshape(3, -1)
        self.ids, self.nulls, self.sizes = docs[0], docs[1].astype(bool), docs[2]
        self.codes, self._size, self._letters = _loose(parts[1], "<u4"), parts[2], parts[3]
        self.ends = np.cumsum(self.sizes)

    def words(self) -> list[bytes]:
        size, letters = _loose(self._size, "<u4"), _loose(self._letters, np.uint8).tobytes()
        ends = np.cumsum(size).tolist()
        return [letters[s:e] for s, e in zip([0, *ends], ends)]

    def sums(self, wide: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Running sums of the words' hashes times rising powers, for one or two
        64-bit hashes, with the inverse powers; any window's hash is a
        difference of two of them."""
        import xxhash

        digest = xxhash.xxh3_128_digest
        halves = np.frombuffer(b"".join(map(digest, self.words())), "<u8").reshape(-1, 2)
        n = len(self.codes)
        with np.errstate(over="ignore"):
            powers, inverse = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, f, np.uint64)])[: n + 1] for f in (FACTOR, INVERSE))
            return [(np.r_[np.uint64(0), np.cumsum(halves[self.codes, k] * powers[:n], dtype=np.uint64)], inverse)
                    for k in ((0, 1) if wide else (0,))]


def window_hashes(sums: list[tuple[np.ndarray, np.ndarray]], at: np.ndarray, width: int, bits: int) -> list[np.ndarray]:
    """Hashes of the windows that start at ``at``; ``bits`` of the first one."""
    out = []
    with np.errstate(over="ignore"):
        for total, inverse in sums:
            h = (total[at + width] - total[at]) * inverse[at]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
            out.append(h)
    if len(out) == 1 and bits < 64:
        out[0] = out[0] >> np.uint64(64 - bits) << np.uint64(64 - bits)
    return out


def ranked(hashes: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(different hashes, rising; place of each among them; count of each)."""
    if len(hashes) == 1:
        h, place, count = np.unique(hashes[0], return_inverse=True, return_counts=True)
        return [h], place, count
    order = np.lexsort(hashes[::-1])
    rows = [h[order] for h in hashes]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([r[1:] != r[:-1] for r in rows])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return [r[first] for r in rows], place, np.diff(np.r_[first, len(order)])


def range_of_hash(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


# ------------------------------------------------------------------ candidates
def first_spans(sizes: np.ndarray, window: int, width: int) -> np.ndarray:
    """(start, count) of the candidate windows of each long enough text."""
    starts = np.cumsum(sizes) - sizes
    long = sizes >= window
    return np.c_[starts[long], sizes[long] - width + 1]


def runs(spans: np.ndarray, alive: np.ndarray, least: int) -> np.ndarray:
    """(start, length) of the runs of at least ``least`` live candidates."""
    if not len(alive):
        return np.zeros((0, 2), np.int64)
    at = spread(spans[:, 0], spans[:, 1])
    opens = np.zeros(len(at), bool)
    opens[np.cumsum(spans[:, 1]) - spans[:, 1]] = True
    edge = np.flatnonzero(opens | np.r_[True, alive[1:] != alive[:-1]])
    length = np.diff(np.r_[edge, len(at)])
    good = alive[edge] & (length >= least)
    return np.c_[at[edge[good]], length[good]]


def survivors(block: Block, spans: np.ndarray, width: int, bits: int, answers: dict[int, bytes], ranges: int) -> np.ndarray:
    """Which candidates of a level occur twice, by the answers of its ranges."""
    sums = block.sums(bits > 64)
    different, place, _ = ranked(window_hashes(sums, spread(spans[:, 0], spans[:, 1]), width, bits))
    part = range_of_hash(different[0], ranges)
    twice = np.zeros(len(part), bool)
    cuts = np.searchsorted(part, np.arange(ranges + 1))
    for r in np.unique(part).tolist():
        s, e = cuts[r], cuts[r + 1]
        twice[s:e] = np.unpackbits(_loose(answers[r], np.uint8), count=e - s).astype(bool)
    return twice[place]


# ----------------------------------------------------------------------- Spark
MANIFEST = "task long, path string, start long, length long, words long"
ASKED = "block long, part int, hashes binary, spans binary"


def write_blocks(docs: DataFrame, folder: str, block_size: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` as blocks in files below ``folder``; the manifest has
    one row a block, and tells which word runs it holds."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("task", pa.int64()), ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        path, out, start, ids, held, size = f"{folder}/{uuid.uuid4().hex}.blocks", None, 0, [], [], 0

        def written() -> Iterator[pa.RecordBatch]:
            nonlocal out, start, task
            raw, words = block_bytes(ids, pa.concat_arrays(held))
            out = out or open_output(path)
            out.write(raw)
            yield batch(schema, [task], [path], [start], [len(raw)], [words])
            start, task = start + len(raw), task + 1

        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
            for s, e in byte_chunks(sizes, max(block_size // 4, 1)):
                ids += b.column(0).slice(s, e - s).to_pylist()
                held.append(b.column(1).slice(s, e - s))
                size += int(sizes[s:e].sum())
                if size >= block_size:
                    yield from written()
                    ids, held, size = [], [], 0
        if ids:
            yield from written()
        if out is not None:
            out.close()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, MANIFEST)


def _each_block(blocks: DataFrame, state: DataFrame | None, answers: DataFrame | None, tasks: int) -> DataFrame:
    """One row a block, with the spans and answers of the level before; dealt
    evenly.  All of it is narrow: hashes and texts stay where they are."""
    rows = blocks
    if state is None:
        rows = rows.withColumn("spans", F.lit(None).cast("binary")).withColumn("answers", F.lit(None).cast(ANSWERS))
    else:
        told = answers.groupBy("block").agg(F.collect_list(F.struct("part", "mask")).alias("answers"))
        rows = rows.join(state, "block").join(told, "block", "left")
    return rows.select("block", "path", "start", "length", "spans", "answers").repartitionById(tasks, F.pmod(F.col("block"), F.lit(tasks)).cast("int"))


ANSWERS = "array<struct<part: int, mask: binary>>"


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(block number, Block, its spans or None, its answers) of the rows."""
    for b in batches:
        for number, path, start, length, spans, answers in zip(*(c.to_pylist() for c in b.columns)):
            spans = None if spans is None else _loose(spans, "<i8").reshape(-1, 2)
            yield number, Block(path, start, length), spans, {a["part"]: a["mask"] for a in answers or ()}


def ask(rows: DataFrame, window: int, width: int, before: int | None, bits: int, bits_before: int, ranges: int) -> DataFrame:
    """Rows of ASKED: a block's candidates of ``width`` words (``part`` -1), and
    their hashes, one row for each range."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("hashes", pa.binary()), ("spans", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, spans, answers in _opened(batches):
            if before is None:
                spans = first_spans(block.sizes, window, width)
            elif len(spans):
                alive = survivors(block, spans, before, bits_before, answers, ranges)
                spans = runs(spans, alive, window - before + 1) - [0, width - before]
            yield batch(schema, [number], [-1], [None], [_squeezed(spans.astype("<i8"))])
            if not len(spans):
                continue
            hashes = window_hashes(block.sums(bits > 64), spread(spans[:, 0], spans[:, 1]), width, bits)
            different, _, count = ranked(hashes)
            again = count > 1
            part = range_of_hash(different[0], ranges)
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
                step = different[0][s:e].copy()
                if len(different) == 1 and bits < 64:
                    step >>= np.uint64(64 - bits)
                step[1:] = step[1:] - step[:-1]
                rest = [d[s:e] for d in different[1:]]
                flags = np.packbits(np.r_[again[s:e], np.zeros(-(e - s) % 64, bool)]).view("<u8")
                blob = _squeezed(np.concatenate([np.array([e - s], "<u8"), step, *rest, flags]))
                yield batch(schema, [number], [int(part[s])], [blob], [None])

    return rows.mapInArrow(run, ASKED)


def judge(asked: DataFrame, bits: int) -> DataFrame:
    """(block, part, mask): for each hash a block asked about in a range, whether
    it occurs twice anywhere."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("mask", pa.binary())])
    width = 2 if bits > 64 else 1

    def run(table: pa.Table) -> pa.Table:
        blocks, sizes, columns, again = table.column("block").to_pylist(), [], [[] for _ in range(width)], []
        for raw in table.column("hashes"):
            values = _loose(raw.as_py(), "<u8")
            n, values = int(values[0]), values[1:]
            sizes.append(n)
            columns[0].append(np.cumsum(values[:n], dtype=np.uint64))
            for k in range(1, width):
                columns[k].append(values[k * n: (k + 1) * n])
            again.append(np.unpackbits(values[width * n:].view(np.uint8), count=n).astype(bool))
        _, place, count = ranked([np.concatenate(c) for c in columns])
        twice = count > 1
        twice[place[np.concatenate(again)]] = True
        hit = twice[place]
        ends = np.cumsum(sizes).tolist()
        masks = [_squeezed(np.packbits(hit[s:e])) for s, e in zip([0, *ends], ends)]
        part = table.column("part")[0].as_py()
        return pa.Table.from_arrays([pa.array(blocks, pa.int64()), pa.array([part] * len(blocks), pa.int32()), pa.array(masks, pa.binary())], schema=schema)

    return asked.filter("part >= 0").select("block", "part", "hashes").groupBy("part").applyInArrow(run, "block long, part int, mask binary")


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def covered(n: int, spans: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of n words the windows that start in the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 0] + spans[:, 1] + window - 1, -1)
    return np.cumsum(edge[:n]) > 0


def _kept(rows: DataFrame, window: int, bits: int, ranges: int, texts: bool) -> DataFrame:
    """The rows of all documents after the last level."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, spans, answers in _opened(batches):
            n = len(block.codes)
            gone = np.zeros(n, bool)
            if len(spans):
                gone = covered(n, runs(spans, survivors(block, spans, window, bits, answers, ranges), 1), window)
            before = np.r_[0, np.cumsum(gone)]
            removed = before[block.ends] - before[block.ends - block.sizes]
            words = block.words()
            kept = block.codes[~gone]
            ends = np.cumsum(block.sizes - removed).tolist()
            for s in range(0, len(ends), 1024):
                lines = [b" ".join(map(words.__getitem__, kept[a:b].tolist())) for a, b in zip([0, *ends][s: s + 1024], ends[s: s + 1024])]
                some = slice(s, s + len(lines))
                yield batch(schema, pa.array(block.ids[some], mask=block.nulls[some]), block.sizes[some], removed[some],
                            [hashlib.sha256(x).hexdigest() for x in lines], [x.decode() if texts else None for x in lines])

    return rows.mapInArrow(run, RESULT)


def deduped(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, texts: bool = True, block_size: int = BLOCK_BYTES,
            range_windows: int = RANGE_WINDOWS, spare_bits: int = SPARE_BITS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (with ``texts``) the kept words
    joined by blanks of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    folder = shared_folder(spark, "blocks")
    manifest = scratch.keep(write_blocks(docs, folder, block_size))
    # one narrow row a block, numbered from 0
    blocks = manifest.withColumn("block", (F.row_number().over(Window.orderBy("task", "path")) - 1).cast("long")).drop("task")
    size = blocks.agg(F.count("*").alias("n"), F.sum("words").alias("words")).first()
    words = max(size.words or 0, 1)
    tasks = min(max(size.n, 1), MOST_TASKS * split_count(spark))
    ranges = math.ceil(words / range_windows)
    few = min(64, max(33, math.ceil(math.log2(words)) + spare_bits))
    state = answers = before = None
    bits_before, old = 0, ()
    for width in levels_of(window, shortest):
        bits = 128 if width == window else few
        rows = _each_block(blocks, state, answers, tasks)
        asked = scratch.keep(ask(rows, window, width, before, bits, bits_before, ranges))
        scratch.drop(*old)
        answers = scratch.keep(judge(asked, bits))
        state = asked.filter("part = -1").select("block", "spans")
        before, bits_before, old = width, bits, (asked, answers)
    return _kept(_each_block(blocks, state, answers, tasks), window, bits, ranges, texts)


def remove_repeats(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    return deduped(docs, window, shortest, texts=False).drop("kept")
