"""Token ids in binary files: frequency ranks in a byte-aligned code.

Every whole text is encoded with the tokenizers library, as its ``encode(text,
add_special_tokens=False)`` does (the strings of special tokens in a text become
those tokens), and closed with an end id.  The ids are counted over all
documents by a partial aggregate, and one table, at most the vocabulary, ranks
them by falling frequency, ties by id.  It is written once beside the files:

    ranks      magic, number of ids, the ids in the order of their ranks (uint32)

Documents are dealt into ranges of ascending id, one file each, a run of blocks
of about ``BLOCK_IDS`` ids:

    magic, then per block
    n_docs, n_ids, n_data            three unsigned 64-bit counts
    doc ids (int64), null flags (uint8), ids per document (int64)
    control bytes: two bits for each rank, its bytes less one, four to a byte
    data: the ranks' low bytes, one to four each

Control and data bytes stand apart, so decoding is a numpy table lookup (control
byte to four lengths), a running sum and a gather.  Memory is bounded by a
block, the longest document and the vocabulary.

A file counts as written when its task's manifest row arrives; a retried task
writes under another name, so a lost executor leaves at most unlisted files.

The tokenizer drops white space, never joins across it, and splits letters from
signs, so the different blank-separated chunks of some texts are encoded once.
Chunks of Latin letters (below U+0250, where normalisation does nothing) and
closing signs go as two pieces to the library's model and byte alphabet; all
others through its whole pipeline.  A Python worker remembers pieces (bounded).

Null texts count as empty: just the end id.  Rows with a null id come last, in
the order of a hash of their text, and are dealt into as many files as their
number asks for.  Repeated ids are ordered by their ids' bytes.  A text of any
length is encoded whole.  An empty table gives an empty table and no file; extra
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plantlens.llm.common import (Scratch, batch, byte_chunks, id_cuts, one_thread, open_input, open_output, range_of,
                                  shared_folder, ship_package, split_count)

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 20
CHUNK = 6 << 20              # bytes of text looked up at once
REMEMBERED = 1_000_000       # pieces a worker keeps; only saves time

MAGIC = b"RANKVB02"
TABLE_MAGIC = b"RANKTB02"
COUNTS = struct.Struct("<3Q")
HASH_BITS = 24               # of a text's hash, for the order of rows without an id


# -------------------------------------------------------------------- encoding
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"          # all letters, none changed by normalisation
SIGNS = r"!-&(-/:-@\[-`{-~"             # ASCII signs but for the apostrophe
SIMPLE = f"^(?P<letters>[{LETTERS}]*)(?P<signs>[{SIGNS}]*)$"


class Encoder:
    """Ids of many texts at once; holds one vocabulary and remembers pieces."""

    def __init__(self, path: str):
        one_thread()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same model and byte alphabet for pieces that need no more splitting
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.starts = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)

    def _learn(self, pieces: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, used = len(self.slot), int(self.starts[len(self.slot)])
        while len(self.starts) < n + len(pieces) + 1:
            self.starts = np.r_[self.starts, np.zeros_like(self.starts)]
        while len(self.flat) < used + len(ids):
            self.flat = np.r_[self.flat, np.empty_like(self.flat)]
        self.starts[n + 1: n + 1 + len(pieces)] = used + np.cumsum(sizes)
        self.flat[used: used + len(ids)] = ids
        self.slot.update(zip(pieces, range(n, n + len(pieces))))

    def _slots(self, pieces: list[str], hard: bool) -> np.ndarray:
        """Slots of different non-empty pieces, encoding those not yet known;
        ``hard`` ones go through the library's whole pipeline."""
        known = self.slot
        fresh = [p for p in pieces if p not in known]
        for at in range(0, len(fresh), 4096):
            some = fresh[at: at + 4096]
            if hard:
                ids = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                sizes = np.array([len(x) for x in ids], np.int64)
                flat = np.fromiter((t for x in ids for t in x), np.uint32, int(sizes.sum()))
            else:
                e = self.pieces.encode(" ".join(some), add_special_tokens=False)
                sizes, flat = np.bincount(e.word_ids, minlength=len(some)), np.array(e.ids, np.uint32)
            self._learn(some, sizes, flat)
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def _part(self, part: pa.Array, hard: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in ``flat`` of the ids of each string; empty or null: 0."""
        coded = pc.fill_null(part, "").dictionary_encode()
        words = coded.dictionary.to_pylist()
        real = [i for i, w in enumerate(words) if w]
        slots = self._slots([words[i] for i in real], hard)
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begin[real] = self.starts[slots]
        size[real] = self.starts[slots + 1] - self.starts[slots]
        index = coded.indices.to_numpy(zero_copy_only=False)
        return begin[index], size[index]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row (nulls as empty), the end id last in each,
        and where each text's ids end."""
        if len(self.slot) > REMEMBERED:
            self.clear()
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        chunks = coded.dictionary
        split = pc.extract_regex(chunks, pattern=SIMPLE)
        # a chunk is letters, then signs; or one hard part
        parts = [self._part(pc.utf8_lower(pc.struct_field(split, "letters"))), self._part(pc.struct_field(split, "signs")),
                 self._part(pc.if_else(pc.is_valid(split), "", chunks), hard=True)]
        sizes = np.stack([n for _, n in parts], 1)[index]
        begins = np.stack([b for b, _ in parts], 1)[index]
        rows, cols = np.nonzero(sizes)                   # most words are one part
        begin, size = begins[rows, cols], sizes[rows, cols]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(begin - (ends - size), size)]
        bounds = np.r_[0, np.cumsum(sizes.sum(1))][offsets[1:] - offsets[0]]
        return np.insert(ids, bounds, END_ID), bounds + np.arange(1, len(texts) + 1)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process and vocabulary, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------------- the code
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    extra = (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    ends = np.cumsum(extra.astype(np.int64) + 1)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    at = ends - extra - 1
    data[at] = values & 255
    for k in range(1, int(extra.max(initial=0)) + 1):
        more = np.flatnonzero(extra >= k)
        data[at[more] + k] = values[more] >> (8 * k) & 255
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    lengths = LENGTHS[control].ravel()[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    values = data[at].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        more = np.flatnonzero(lengths > k)
        values[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def rank_table(counts: np.ndarray) -> np.ndarray:
    """The ids that occur, by falling count, ties by id."""
    known = np.flatnonzero(counts)
    return known[np.lexsort((known, -counts[known]))].astype("<u4")


def ranks_of(table: np.ndarray) -> np.ndarray:
    """The rank of each id in the table."""
    rank = np.zeros(int(table.max(initial=0)) + 1, np.uint32)
    rank[table] = np.arange(len(table), dtype=np.uint32)
    return rank


def write_table(path: str, table: np.ndarray) -> None:
    with open_output(path) as out:
        out.write(TABLE_MAGIC + struct.pack("<Q", len(table)) + table.astype("<u4").tobytes())


def read_table(path: str) -> np.ndarray:
    with open_input(path) as stream:
        if stream.read(len(TABLE_MAGIC)) != TABLE_MAGIC:
            raise ValueError("not a rank table")
        n, = struct.unpack("<Q", stream.read(8))
        return np.frombuffer(stream.read(4 * n), "<u4")


def write_block(out, doc_ids: list[int | None], docs: list[np.ndarray], rank: np.ndarray) -> None:
    ids = np.concatenate(docs)
    control, data = pack(rank[ids])
    out.write(COUNTS.pack(len(docs), len(ids), len(data)))
    out.write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.write(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    out.write(np.array([len(d) for d in docs], "<i8").tobytes())
    out.write(control)
    out.write(data)


def read_blocks(stream, table: np.ndarray) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """(doc ids, ids of each) of every block of an open file."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    while head := stream.read(COUNTS.size):
        n_docs, n_ids, n_data = COUNTS.unpack(head)
        numbers = np.frombuffer(stream.read(8 * n_docs), "<i8")
        nulls = np.frombuffer(stream.read(n_docs), np.uint8)
        sizes = np.frombuffer(stream.read(8 * n_docs), "<i8")
        control = np.frombuffer(stream.read(-(-n_ids // 4)), np.uint8)
        data = np.frombuffer(stream.read(n_data), np.uint8)
        ids = table[unpack(control, data, n_ids)]
        yield ([None if gone else int(d) for d, gone in zip(numbers, nulls)],
               np.split(ids, np.cumsum(sizes)[:-1]))


# ----------------------------------------------------------------------- Spark
def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, key, ids): the ids of every document in as few bytes as the
    vocabulary needs, the end id last, and a hash of the text."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int32()), ("ids", pa.binary())])
        enc = encoder(vocabulary)
        small = id_type(enc)
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False)
            for s, e in byte_chunks(sizes, CHUNK):
                part = b.slice(s, e - s)
                ids, ends = enc.encode(part.column(2))
                offsets = np.r_[0, ends].astype(np.int32) * small.itemsize
                raw = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(small))])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), raw], schema=schema)

    text = docs["text"].cast("string")
    key = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - HASH_BITS).cast("int")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), key.alias("key"), text.alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, key int, ids binary")


def id_type(enc: Encoder) -> np.dtype:
    return np.dtype("<u2") if enc.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")


def id_counts(tokens: DataFrame, vocabulary: str) -> np.ndarray:
    """How often each id occurs in all documents: one row a task and id."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int32()), ("n", pa.int64())])
        small, total = id_type(encoder(vocabulary)), np.zeros(0, np.int64)
        for b in batches:
            for s in range(0, b.num_rows, 512):
                column = b.column(0).slice(s, 512)       # its values lie side by side in one buffer
                _, offsets, data = column.buffers()
                wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
                ends = np.frombuffer(offsets, wide)[[column.offset, column.offset + len(column)]].tolist()
                some = np.bincount(np.frombuffer(data, np.uint8)[ends[0]: ends[1]].view(small), minlength=len(total))
                some[: len(total)] += total
                total = some
        known = np.flatnonzero(total)
        yield batch(schema, known, total[known])

    rows = tokens.select("ids").mapInArrow(counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()   # a vocabulary
    counts = np.zeros(int(max(rows["id"].to_pylist(), default=0)) + 1, np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return counts


def write_tokens(docs: DataFrame, folder: str, vocabulary: str) -> DataFrame:
    """Write the token files of ``docs`` and their rank table below ``folder``;
    returns the manifest (part, path, n_docs, n_ids), one row for each file, parts
    in id order."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "token-ids")
    tokens = scratch.keep(encode_documents(docs, vocabulary), dictionary=False)
    cuts = id_cuts(tokens, "doc_id", split_count(spark))
    rows = tokens.agg(F.count("*").alias("n"), F.count("doc_id").alias("named")).first()
    named = len(cuts) + 1
    unnamed = -(-(rows.n - rows.named) * named // max(rows.n, 1))      # files for rows without an id, by their share
    write_table(f"{folder}/ranks", rank_table(id_counts(tokens, vocabulary)))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
        small, rank = id_type(encoder(vocabulary)), None
        out, number, numbers, held, n_docs, n_ids, size = None, 0, [], [], 0, 0, 0
        for b in batches:
            for i in range(b.num_rows):
                if out is None:
                    number, rank = b.column(0)[i].as_py(), ranks_of(read_table(f"{folder}/ranks"))
                    path = f"{folder}/part-{number:06d}-{uuid.uuid4().hex}.tok"
                    out = open_output(path)
                    out.write(MAGIC)
                ids = np.frombuffer(b.column(3)[i].as_buffer(), small)
                numbers.append(b.column(1)[i].as_py())
                held.append(ids)
                size += len(ids)
                if size >= BLOCK_IDS:
                    write_block(out, numbers, held, rank)
                    n_docs, n_ids, numbers, held, size = n_docs + len(held), n_ids + size, [], [], 0
        if out is not None:
            if held:
                write_block(out, numbers, held, rank)
            out.close()
            yield batch(schema, [number], [path], [n_docs + len(held)], [n_ids + size])

    last = named + F.floor(F.col("key") * F.lit(unnamed).cast("long") / (1 << HASH_BITS))
    part = F.when(F.col("doc_id").isNull(), last).otherwise(range_of(F.col("doc_id"), cuts)).cast("int")
    order = F.when(F.col("doc_id").isNull(), F.col("key"))
    files = (tokens.select(part.alias("part"), "doc_id", "key", "ids").repartitionById(named + unnamed, F.col("part"))
             .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), order, "ids")
             .mapInArrow(written, "part int, path string, n_docs long, n_ids long"))
    manifest = scratch.keep(files)
    scratch.drop(tokens)
    return manifest


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    # one row for each file
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("part", "path", F.coalesce(before, F.lit(0)).cast("long").alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids_crc32", pa.int64())])
        for b in batches:
            table = read_table(f"{folder}/ranks")
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                with open_input(path) as stream:
                    for numbers, docs in read_blocks(stream, table):
                        sizes = np.array([len(d) for d in docs], np.int64)
                        starts = base + np.cumsum(sizes) - sizes
                        base += int(sizes.sum())
                        sums = [zlib.crc32(np.ascontiguousarray(d, "<u4")) for d in docs]
                        yield batch(schema, numbers, starts, sizes, sums)

    n = max(manifest.count(), 1)
    return files.repartitionById(n, F.pmod(F.col("part"), F.lit(n))).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenize(docs: DataFrame, vocabulary: str | None = None, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back."""
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, vocabulary or vocabulary_path()), folder)
