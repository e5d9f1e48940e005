"""Every operator: empty tables, clashing columns, other partitionings."""

from __future__ import annotations

import pytest
from llm_fixtures import DOC_SCHEMA, documents, plain, with_extra, with_filled_maps

from plantlens.llm import (alignment, decontamination, digest, exact_dedup, langid, line_dedup, mixing, simhash, substring_dedup,
                           token_store, toxicity, warc)
from plantlens.llm.common import row_columns, whole_row


def labels(spark):
    return spark.createDataFrame([(i * 3, i % 2, int(i % 3 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")


def bench(spark):
    return spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, "too short"), (None, "")],
                                 "item_id long, text string")


OPERATORS = {
    "mixing": lambda s, d: mixing.mixed_sizes(d),
    "mixed rows": lambda s, d: mixing.mixed_documents(d, 4),
    "decontamination": lambda s, d: decontamination.matches(d, bench(s)),
    "clean rows": lambda s, d: decontamination.drop_contaminated(d, bench(s)),
    "simhash": lambda s, d: simhash.op3(d),
    "kept rows": lambda s, d: simhash.drop_near_duplicates(d),
    "digest": lambda s, d: digest.neighbours(d),
    "langid": lambda s, d: langid.identify(d, 20),
    "lines": lambda s, d: line_dedup.line_report(d),
    "deduped lines": lambda s, d: line_dedup.dedup_lines(d),
    "substrings": lambda s, d: substring_dedup.remove_repeats(d),
    "toxicity": lambda s, d: toxicity.scores(d, labels(s), 10),
    "mild rows": lambda s, d: toxicity.drop_toxic(d, labels(s), 10),
    "tokens": lambda s, d: token_store.tokenize(d),
    "alignment": lambda s, d: alignment.aligned(d),
    "exact": lambda s, d: exact_dedup.exact_groups(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_and_clashing_columns(spark, name):
    run = OPERATORS[name]
    docs = documents(spark)
    empty = spark.createDataFrame([], DOC_SCHEMA)
    expected = run(spark, docs)
    found = run(spark, empty)
    assert found.columns == expected.columns and found.count() == 0
    wide = run(spark, with_extra(docs)).select(expected.columns)
    assert plain(wide) == plain(expected)


def test_rows_are_taken_apart_and_put_together(spark):
    """Maps, also inside structs and arrays, null or not, come back as they were."""
    from pyspark.sql import functions as F

    wide = with_filled_maps(documents(spark)).withColumn("m", F.when(F.col("doc_id") % 2 == 0, F.col("m"))).withColumn(
        "nested", F.when(F.col("doc_id") % 3 == 0, F.col("nested")))
    back = wide.select(whole_row(wide).alias("row")).select(row_columns(wide))
    assert back.dtypes == wide.dtypes
    assert plain(back) == plain(wide)


@pytest.mark.parametrize("name", ["mixed rows", "clean rows", "kept rows", "deduped lines", "mild rows"])
def test_stages_keep_all_columns(spark, name):
    wide = with_filled_maps(documents(spark))
    out = OPERATORS[name](spark, wide)
    assert out.columns == wide.columns
    got = out.select("m", "nested").filter("m['a'] = 1 and m['b'] = 2 and nested.y = 3 and nested.x[0][1] = 'x'")
    assert got.count() == out.count() > 0


def test_pages_empty_and_clashing(spark):
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame([(1, "u", "x" * 200), (2, None, "x" * 200), (3, "v", None), (None, "w", "y")], schema)
    assert warc.archive(spark.createDataFrame([], schema)).count() == 0
    assert plain(warc.archive(with_extra(pages))) == plain(warc.archive(pages))


def test_every_row_has_a_result(spark):
    docs = documents(spark)
    n = docs.count()
    for name in ("mixing", "simhash", "digest", "langid", "lines", "substrings", "toxicity", "tokens"):
        assert OPERATORS[name](spark, docs).count() == n, name
