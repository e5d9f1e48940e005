"""Registered queries of this subpackage: key -> Spark builder, DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plantlens.llm import (alignment, decontamination, digest, exact_dedup, langid, line_dedup, mixing, prefix_trie, simhash,
                           substring_dedup, token_store, toxicity, warc)
from plantlens.llm.common import table

Builder = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents at target source weights takes."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate classes of all documents."""
    return simhash.op3(table(spark, sf_dir, "documents"))


def op4_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartile digests of every document and of its edited text."""
    return digest.neighbours(table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate lines taken out of every document."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 35-word windows removed from every document."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web archives of all pages, written and read back."""
    return warc.archive(table(spark, sf_dir, "pages"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, read back."""
    return token_store.tokenize(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every document."""
    return alignment.aligned(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal documents, through a new digest index."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Builder] = {
    "op1_mixing": op1_mixing,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_digest": op4_digest,
    "op5_langid": op5_langid,
    "op6_lines": op6_lines,
    "op7_substrings": op7_substrings,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_tokens": op10_tokens,
    "op11_alignment": op11_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_mixing": mixing.ORACLE,
    "op9_warc": warc.ORACLE,
    "op12_exact_dedup": exact_dedup.ORACLE,
}
