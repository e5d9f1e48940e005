"""The corpus pipeline: five stages from raw documents to token files.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame.
``run`` applies them to ``documents``; each result but the last is written as
Parquet to the shared checkpoint folder and read again as the next stage's
``docs``, so a lost executor costs a part of one stage only.  All stages but the
last keep the columns of ``documents``:

1. toxicity: documents that score as toxic go;
2. simhash_dedup: one document of each near-duplicate component stays;
3. decontamination: documents that contain a benchmark item go;
4. mixing: sources at target weights, documents repeated or left out;
5. tokens: token files of the mix, read back (doc_id, start, n_tokens, ids_crc32).

Stages 1, 2 and 5 are not expressible in SQL (a trained model, hashes of
shingles, a tokenizer), so there is no SQL for the rows of ``run``; it is tested
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantlens.llm import decontamination, mixing, simhash, token_store, toxicity
from plantlens.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.tokenize(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
