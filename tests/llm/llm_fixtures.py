"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside; they must not clash
EXTRA = ("key string, fp long, part int, place long, draws long, size long, row string, name string, a long, component long, "
         "_keep_id long, _component long, _gone string, _bad_id long, _bad_key long, id string, text_key string, keep_id int, block long, "
         "digest string, hash long, m map<string,int>, nested struct<x:array<map<int,string>>,y:int>")

SYLLABLES = {
    "en": ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it"],
    "de": ["der", "sch", "ein", "ich", "ung", "ver", "zu", "keit", "ge", "be", "lich", "ä", "ö", "ü", "ß", "pf", "tz", "au", "ie", "heit"],
    "fr": ["le", "de", "eau", "oi", "ai", "eux", "ou", "tre", "ment", "é", "è", "ê", "ç", "elle", "que", "pa", "ré", "la", "vi", "on"],
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n)]
    lines = [" ".join(words[i: i + 25]) for i in range(0, n, 25)]
    return "\n".join(x[:1].upper() + x[1:] + "." for x in lines)


def awkward_rows(seed: int = 5, n: int = 60) -> list[tuple]:
    """Plain rows, exact and near copies, shared passages, null and empty
    fields, a long text, blanks of all kinds, repeated rows and a null id."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i * 3, prose(rng, lang, rng.randint(1, 160)), lang, f"s{i % 4}"))
    passage = prose(rng, "en", 80)
    for i in range(6):
        rows.append((1000 + i, prose(rng, "en", 30) + "\n" + passage + "\n" + prose(rng, "en", 20 + i), "en", "s0"))
    base = prose(rng, "de", 120)
    rows += [(1100 + i, base, "de", "s0") for i in range(5)]
    for i in range(5):
        words = base.split(" ")
        words[10 + i] = "anders"
        rows.append((1200 + i, " ".join(words), "de", "s1"))
    rows += [(2000, "", "en", "s1"), (2001, None, "en", "s2"), (2002, " \t\n\r\x0b\x0c ", "fr", "s2"), (2003, "x", None, None),
             (2004, "12 34 !?", "en", None), (2005, "Wort für Wort \U0001f600 café", "de", "s3"), (2006, prose(rng, "fr", 6000), "fr", "s3"),
             (2007, "the the the " * 40, "en", "s1"), (2008, "a\n\n\na\n \nb", "en", "s1"), (None, prose(rng, "en", 30), "en", "s1"),
             (None, None, None, None)]
    rows.append(rows[3])                                  # a repeated row
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOC_SCHEMA).repartition(3)


def with_extra(df):
    """The same rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    for c in EXTRA.split(", "):
        name, kind = c.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def with_filled_maps(df):
    """The same with maps in the map columns."""
    from pyspark.sql import functions as F

    some = F.create_map(F.lit("b"), F.lit(2), F.lit("a"), F.lit(1))
    return with_extra(df).withColumn("m", some).withColumn(
        "nested", F.struct(F.array(F.create_map(F.lit(1), F.lit("x"))).alias("x"), F.lit(3).alias("y")))


def plain(df):
    """Sorted rows, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
