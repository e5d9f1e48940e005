"""Benchmark decontamination: size-partitioned MinHash containment search.

Text is lower-cased and cut into words of letters and digits; a shingle is five
consecutive words.  A document contains an item when it holds at least 80 % of
the item's distinct shingles.

Whole-document MinHash signatures say nothing about a 30-shingle item inside a
20,000-word document: their Jaccard similarity is about 0.001.  So the search
keeps the MinHash order but sizes each sketch by containment.  Items are
partitioned by size, i.e. their number n of distinct shingles; in each
partition the sketch is the m = n - ceil(0.8 n) + 1 shingles with the smallest
hashes.  A document that holds 80 % of an item misses at most m - 1 of its
shingles, so it holds one of the sketch: no contaminated document is lost, and
the sketches are about a fifth of the items' shingles.  A document with fewer
words than an item's ceil(0.8 n) shingles need is not compared with it.

The documents are read once to hash their shingles and probe the sketches:
whole-stage code, no shuffle of the shingles while the sketches pass a size
check (else a shuffled join).  Candidates are then verified on the shingles'
own text, so hash collisions cannot add a row.

Scripts without blanks (Han, kana, Thai, Lao, Khmer, Burmese) count each letter
as a word.  An item with fewer than five words is one shingle, the whole run of
its words, and documents are cut at that length as well; an item without words
matches nothing.  Null and empty texts hold nothing.  Items are told apart by id
and text, also where they share an id or have none, and reported by id.
Documents without an id are searched and reported like others; repeated rows
count once.  Empty tables give an empty
table.  All of it is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plantlens.llm.common import pinned

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
ITEM = ["item_id", "item_key"]
#: letters of scripts that are written without blanks between words
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
BROADCAST_SKETCHES = 2_000_000      # sketch rows (16 bytes each) that may be sent to every task


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not once per use."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _words(text: Column) -> Column:
    """The words of a text; signs of scripts without blanks are words alone.
    Texts of ASCII need neither that nor the Unicode classes."""
    low = F.lower(text)
    apart = F.when(low.rlike(UNSPACED), F.regexp_replace(low, UNSPACED, " $1 ")).otherwise(low)
    words = F.when(F.octet_length(text) == F.length(text), F.split(low, "[^a-z0-9]+")).otherwise(F.split(apart, r"[^\p{L}\p{N}]+"))
    return F.array_remove(words, "")


def _windows(w: Column, lengths: list[int], one) -> Column:
    """``one(words, i, n)`` for each run of n words from i (from 0) on, for each
    n of ``lengths``."""
    def run(n):
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: one(w, i, n)))

    runs = [run(n) for n in lengths]
    return runs[0] if len(runs) == 1 else F.flatten(F.filter(F.array(*runs), lambda r: r.isNotNull()))


def _shingles(text: Column, lengths: list[int]) -> Column:
    """All shingles of a text, as text."""
    return _bound(_words(text), lambda w: _windows(
        w, lengths, lambda w, i, n: F.array_join(F.slice(w, i + 1, n), " ")))


def _hash(h: Column, i, n: int) -> Column:
    """The hash of n words from i on, of their words' hashes ``h``."""
    return F.xxhash64(*[F.get(h, i + k) for k in range(n)])


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def _keys(text: Column, lengths: list[int]) -> Column:
    """The hashes of all shingles of a text: each word is hashed once."""
    return _bound(_word_hashes(_words(text)), lambda h: _windows(h, lengths, _hash))


def _item_shingles(items: DataFrame, n: int) -> DataFrame:
    """(ITEM, length, shingle, key): each distinct shingle of each item; an item
    below n words is one shingle of its length."""
    def cut(w):
        short = F.when(F.size(w) > 0, F.array(w))
        return F.when(F.size(w) < n, short).otherwise(F.transform(
            F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.slice(w, i, n)))

    each = items.select(*ITEM, F.explode(_bound(_words(F.col("text")), cut)).alias("words"))
    hashes = _word_hashes(F.col("words"))
    key = F.coalesce(*[F.when(F.size("words") == k, _hash(hashes, F.lit(0), k)) for k in range(1, n + 1)])
    return each.select(*ITEM, F.size("words").alias("length"), F.array_join("words", " ").alias("shingle"),
                       key.alias("key")).distinct()


def _with_text(items: DataFrame) -> DataFrame:
    """(ITEM, text): an item is its id and its text, so items of one id or of
    none stay apart."""
    text = F.col("text").cast("string")
    return items.select("item_id", F.xxhash64(text).alias("item_key"), text.alias("text"))


def sketches(items: DataFrame, n: int = SHINGLE_WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """(item_id, item_key, length, needed, size, key): the sketch of each item,
    one row a key."""
    of_item = Window.partitionBy(*ITEM)
    sized = _item_shingles(_with_text(items), n).withColumn("size", F.count("*").over(of_item)).withColumn(
        "place", F.row_number().over(of_item.orderBy("key", "shingle")))
    needed = F.ceil(F.round(F.col("size") * containment, 6)).cast("int")
    return (sized.withColumn("needed", needed).filter("place <= size - needed + 1")
            .select(*ITEM, "length", "needed", F.col("size").cast("int").alias("size"), "key"))


def _row_matches(docs: DataFrame, items: DataFrame, n: int, containment: float) -> DataFrame:
    """(doc_id, text_key, item_id, n_shingles, n_found): a row for each document
    row's id and text hash and each item it contains."""
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    keys = pinned(sketches(items, n, containment))
    small = keys.count() <= BROADCAST_SKETCHES
    # documents are cut at n words, and at the lengths below that short items have
    short = keys.filter(F.col("length") < n).agg(F.sort_array(F.collect_set("length")).alias("l")).first().l
    lengths = [n, *short]
    # the text is identified by its row's hash as well, so repeated ids with other texts stay apart
    text_key = F.xxhash64("text")
    hashed = docs.filter("text is not null").select(
        "doc_id", text_key.alias("text_key"), _keys(F.col("text"), lengths).alias("keys"))
    probe = hashed.select("doc_id", "text_key", F.size("keys").alias("held"), F.explode("keys").alias("key"))
    found = (probe.join(F.broadcast(keys) if small else keys, "key").filter("held >= needed")
             .select("doc_id", "text_key", *ITEM).distinct())
    found = pinned(found)
    # verification on the shingles themselves, for candidate documents only
    of_item = _item_shingles(_with_text(items), n).groupBy(*ITEM).agg(F.collect_set("shingle").alias("wanted"))
    texts = docs.filter("text is not null").select(F.col("doc_id").alias("id"), "text", text_key.alias("key"))
    wanted = found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct(*ITEM)).alias("some"))
    held = texts.join(wanted, (texts.key == wanted.text_key) & texts.id.eqNullSafe(wanted.doc_id)).select(
        "doc_id", "text_key", "some", F.array_distinct(_shingles(F.col("text"), lengths)).alias("holds"))
    pairs = held.select("doc_id", "text_key", "holds", F.explode("some").alias("i")).select(
        "doc_id", "text_key", "holds", "i.*")
    of_item = of_item.toDF("item", "item_hash", "wanted")
    checked = pairs.join(of_item, (pairs.item_key == of_item.item_hash) & pairs.item_id.eqNullSafe(of_item.item)).select(
        "doc_id", "text_key", "item_id", F.size("wanted").alias("n_shingles"),
        F.size(F.array_intersect("wanted", "holds")).alias("n_found"))
    return checked.filter(F.col("n_found") >= F.ceil(F.round(F.col("n_shingles") * containment, 6)))


def matches(docs: DataFrame, items: DataFrame, n: int = SHINGLE_WORDS,
            containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of every document
    and item with at least the containment, one row a pair of ids: of several
    the highest containment, then the largest item."""
    share = F.col("n_found") / F.col("n_shingles")
    best = F.max(F.struct(share.alias("containment"), "n_shingles", "n_found"))
    return (_row_matches(docs, items, n, containment).groupBy("doc_id", "item_id").agg(best.alias("x"))
            .select("doc_id", "item_id", "x.n_shingles", "x.n_found", "x.containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = SHINGLE_WORDS,
                      containment: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns kept.  Each row is
    judged by its own id and text, so rows of a shared or missing id stand alone."""
    bad = _row_matches(docs, items, n, containment).select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    rows = docs.select(docs["doc_id"].alias("id"), F.xxhash64(docs["text"].cast("string")).alias("key"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return rows.join(bad, rows["id"].eqNullSafe(bad["bad_id"]) & (rows["key"] == bad["bad_key"]), "left_anti").select("row.*")
