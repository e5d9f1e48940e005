"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

Texts are equal when they are identical after all ASCII white space is deleted.
The index is a Parquet table in shared storage, bucketed and sorted by the
SHA-256 of the normalised text, with one entry for each different text: the
document that stays and the batch it came with.  A batch of documents is
deduplicated in three steps:

1. ``digests``: each document becomes a narrow row (id, digest, length, hash of
   the original text).  Texts are read once and never shuffled.
2. ``groups``: one row for each digest of the batch, with the document that
   stays: most code points in the original text, then the smallest id.  Partial
   aggregates make a group of any size one row a task.
3. A sort-merge anti-join with the index finds the digests it does not have;
   those are appended.  The index is read by buckets and not shuffled.

Then every row of the batch is told its group's entry.  That join would send
a large group's rows to one task, so groups with over 1/10,000 of the rows
(there are at most 10,000 of them) are broadcast and only the others shuffled.

Appending a batch is one atomic write.  A batch that is ingested again under
its name finds its own entries and gets the same answer, so a failed job is
run again.  ``copy_to`` rewrites an index as one sorted file a bucket.

Null texts count as empty, and all empty texts are equal.  An id sorts before a
missing one.  Rows that repeat both the id and the text of the one that stays
cannot be told from it: ``ingest`` reports each of them as kept, ``dedup``
returns one of them.  Texts of any length are hashed whole.  An empty table
gives an empty table and appends nothing; extra columns of any name or type
are ignored by ``ingest`` and returned by ``dedup``.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.llm.common import Scratch, join_groups, shared_folder, split_count

BLANKS = " \t\n\x0b\x0c\r"
BUCKET_ROWS = 2_000_000          # entries of a bucket, about 150 MB

ENTRY = "digest binary, keep_id long, keep_chars long, keep_text long, batch string"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def row_key(docs: DataFrame) -> list[Column]:
    """What tells a document's row from others: its id and a hash of its text."""
    return [docs["doc_id"].cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("text_key")]


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, digest, n_chars) of every row."""
    text = docs["text"]
    return docs.select(*row_key(docs), F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
                       F.coalesce(F.length(text.cast("string")), F.lit(0)).cast("long").alias("n_chars"))


def groups(rows: DataFrame) -> DataFrame:
    """One row for each digest: size, the row that stays (keep_id, keep_chars,
    keep_text) and how many rows repeat that one (ties)."""
    same = rows.groupBy("digest", "n_chars", "doc_id", "text_key").agg(F.count("*").alias("ties"))
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "ties"))
    found = same.groupBy("digest").agg(best.alias("best"), F.sum("ties").alias("size"))
    return found.select("digest", "size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"),
                        F.col("best.text_key").alias("keep_text"), F.col("best.ties").alias("ties"))


class DigestIndex:
    """The entries below ``folder``.  The folder keeps its number of buckets, so
    any later session opens it as it was made."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        about = f"{self.folder}/about"
        try:
            self.buckets = spark.read.schema("buckets int").json(about).first().buckets
        except AnalysisException:                        # a new index
            self.buckets = buckets or split_count(spark)
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.json(about)
        self.name = "plantlens_digests_" + hashlib.sha256(self.folder.encode()).hexdigest()[:16]
        where = f"{self.folder}/entries".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({ENTRY}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{where}'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, entries: DataFrame) -> None:
        """Add entries; dealt by bucket, so each task writes one sorted file."""
        entries.select([c.split()[0] for c in ENTRY.split(", ")]).repartition(self.buckets, "digest").write.insertInto(self.name)

    def unknown(self, found: DataFrame) -> DataFrame:
        """The rows of ``found`` whose digest the index does not have."""
        return found.repartition(self.buckets, "digest").join(self.entries().hint("merge"), "digest", "left_anti")

    def _placed(self, docs: DataFrame, batch: str) -> tuple[DataFrame, DataFrame, int]:
        """Append what is new in ``docs``.  Returns its narrow rows, its groups
        with the index's entry for each, and the number of rows."""
        scratch = Scratch(self.spark, "digests-run")
        rows = scratch.keep(digests(docs))
        found = scratch.keep(groups(rows))
        self.append(self.unknown(found).withColumn("batch", F.lit(batch)))
        own = found.select("digest", "size", "ties").repartition(self.buckets, "digest")
        placed = scratch.keep(own.join(self.entries().hint("merge"), "digest"))
        scratch.drop(found)
        return rows, placed, placed.agg(F.sum("size")).first()[0] or 0

    def ingest(self, docs: DataFrame, batch: str) -> DataFrame:
        """Append ``docs`` and return doc_id, keep_id, group_size (equal texts in
        this batch), kept, text_sha256 of every row."""
        rows, placed, total = self._placed(docs, batch)
        kept = ((F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
                & (F.col("n_chars") == F.col("keep_chars")) & (F.col("text_key") == F.col("keep_text")))
        return join_groups(rows, placed, ["digest"], total).select(
            "doc_id", "keep_id", F.col("size").cast("long").alias("group_size"), kept.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"))

    def dedup(self, docs: DataFrame, batch: str) -> DataFrame:
        """Append ``docs`` and return its rows that stay, with all columns."""
        _, placed, total = self._placed(docs, batch)
        stay = placed.filter(F.col("batch") == batch).select(
            F.col("keep_id").alias("doc_id"), F.col("keep_text").alias("text_key"), F.col("ties").alias("size"))
        whole = docs.select(*row_key(docs), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
        found = join_groups(whole, stay, ["doc_id", "text_key"], total)
        # repeated rows: any one of them; a partial aggregate, as they may be many
        again = found.filter("size > 1").groupBy("doc_id", "text_key").agg(F.first("row").alias("row"))
        return found.filter("size = 1").select("row.*").union(again.select("row.*"))

    def copy_to(self, folder: str, buckets: int | None = None) -> DigestIndex:
        """The same entries as a new index, one sorted file a bucket."""
        new = DigestIndex(self.spark, folder, buckets or self.buckets)
        new.append(self.entries())
        return new


def buckets_for(spark: SparkSession, rows: int) -> int:
    """Buckets of about BUCKET_ROWS entries, as many as tasks at least."""
    return max(split_count(spark), math.ceil(rows / BUCKET_ROWS))


def exact_groups(docs: DataFrame, folder: str | None = None, batch: str = "documents") -> DataFrame:
    """Ingest ``docs`` into the index below ``folder`` (a new one by default)."""
    spark = docs.sparkSession
    index = DigestIndex(spark, folder or shared_folder(spark, "digest-index"), buckets_for(spark, docs.count()))
    return index.ingest(docs, batch)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
