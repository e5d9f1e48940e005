"""Web archives: a WARC writer with a Zstandard dictionary, and its reader.

A file opens with a skippable frame that holds a dictionary, then has one
Zstandard frame for each record, so any record can be read alone.  The
dictionary is built from the file's own first records (at least until
``DICTIONARY_SAMPLE`` bytes are gathered), its magic is that of the public
draft "WARC-zstd"; each writing task makes one file.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes, the smallest
page id is a ``response`` and the others are ``revisit`` records, which name it
and carry both digest and length but no payload.  That choice is made on narrow
rows (id, length, SHA-256); the payloads move at most once, when the choice is
joined to them and is too large to broadcast.

A file counts as written when its task's manifest row arrives; a retried task
writes under another name.  Readers check every response against its digest.

Null html is an empty payload.  Pages without an id come as responses unless an
id'd page has their payload.  Rows with the smallest id of a payload are all
responses if that id repeats.  An empty table gives an empty table and no file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import batch, open_input, open_output, pinned, shared_folder, ship_package

REVISIT_BYTES = 100
LEVEL = 6
DICTIONARY_BYTES = 64 << 10
DICTIONARY_SAMPLE = 4 << 20
DATE = "2024-01-01T00:00:00Z"        # the tables have no fetch time

# Fixed values of the public formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER = struct.Struct("<II")


# --------------------------------------------------------------------- records
def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: header lines, a blank line, the block, two line ends.
    Without a payload it is a revisit, whose HTTP header has the full length."""
    revisit = payload is None
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % size, b"", b""]
    block = b"\r\n".join(http) + (payload or b"")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)),
            ("WARC-Date", DATE), ("WARC-Target-URI", " ".join((url or "").split())),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block)))]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, digest, type, refers_to) of a record; a response
    whose payload does not have its digest raises."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    named = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = named["WARC-Payload-Digest"].removeprefix("sha256:")
    if named["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {named['WARC-Record-ID']}")
    refers = named.get("WARC-Refers-To")
    return _page_id(named["WARC-Record-ID"]), size, digest, named["WARC-Type"], None if refers is None else _page_id(refers)


class Writer:
    """Records into one open stream; the dictionary comes from the first ones."""

    def __init__(self, out):
        self.out, self.held, self.size, self.coder = out, [], 0, None

    def add(self, raw: bytes) -> None:
        if self.coder is None:
            self.held.append(raw)
            self.size += len(raw)
            if self.size >= DICTIONARY_SAMPLE:
                self._start()
        else:
            self.out.write(self.coder.compress(raw))

    def _start(self) -> None:
        import zstandard

        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, self.held).as_bytes()
        except zstandard.ZstdError:                      # too few or too small records to train on
            trained = b""
        self.out.write(HEADER.pack(SKIPPABLE_MAGIC, len(trained)) + trained)
        self.coder = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, dict_data=zstandard.ZstdCompressionDict(trained))
        for raw in self.held:
            self.out.write(self.coder.compress(raw))
        self.held = []

    def close(self) -> None:
        if self.coder is None:
            self._start()
        self.out.close()


def read_records(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The records of an open archive, one at a time."""
    import zstandard

    magic, size = HEADER.unpack(stream.read(HEADER.size))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no leading dictionary frame")
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    rest = b""
    while True:
        rest = rest or stream.read(step)
        if not rest:
            return
        frame, parts = decoder.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
            if frame.eof:
                break
            rest = stream.read(step)
            if not rest:
                raise ValueError("the archive ends inside a record")
        yield b"".join(parts)


# ----------------------------------------------------------------------- Spark
def record_kinds(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the revisit records, one row each pair."""
    narrow = pages.select("page_id", F.sha2("payload", 256).alias("digest"), F.length("payload").alias("size"))
    narrow = pinned(narrow.filter(F.col("size") >= revisit_bytes).select("page_id", "digest"))
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
    again = narrow.join(first.filter("copies > 1 and refers_to is not null"), "digest")
    return again.filter("page_id is null or page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the
    manifest (path, n_records), one row a file."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    kinds = record_kinds(rows).withColumnRenamed("page_id", "id").withColumnRenamed("digest", "same")
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows = rows.join(kinds, (F.col("digest") == F.col("same")) & F.col("page_id").eqNullSafe(F.col("id")), "left")
    # a revisit travels without its payload
    rows = rows.select("page_id", "url", F.when(F.col("same").isNull(), F.col("payload")).alias("payload"),
                       F.length("payload").alias("size"), "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("n_records", pa.int64())])
        writer, path, count = None, f"{folder}/pages-{uuid.uuid4().hex}.warc.zst", 0
        for b in batches:
            for page_id, url, payload, size, digest, refers_to in zip(*b.columns):
                page_id, url, payload = page_id.as_py(), url.as_py(), payload.as_py()
                size, digest, refers_to = size.as_py(), digest.as_py(), refers_to.as_py()
                writer = writer or Writer(open_output(path))
                writer.add(record(page_id, url, payload, size, digest, refers_to))
                count += 1
        if writer is not None:
            writer.close()
            yield batch(schema, [path], [count])

    return pinned(rows.mapInArrow(run, "path string, n_records long"))


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    record in the listed files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                with open_input(path) as stream:
                    for raw in read_records(stream):
                        rows.append(parse(raw))
                        if len(rows) == 4096:
                            yield batch(schema, *zip(*rows))
                            rows = []
                if rows:
                    yield batch(schema, *zip(*rows))

    n = max(manifest.count(), 1)
    return manifest.select("path").repartition(n, "path").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    return read_archives(write_archives(pages, folder or shared_folder(pages.sparkSession, "warc")))


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS page_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
       CASE WHEN f.page_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id < p.page_id THEN f.page_id END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND p.payload_bytes >= 100
"""
