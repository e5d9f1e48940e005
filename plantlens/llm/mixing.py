"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree.

A document has a 60-bit order number from its id's hash.  A source's documents
in that order are a random permutation; its blocks are equal ranges of the
number, about ``BLOCK_DOCS`` documents each, so block numbers are permuted
already and no sort of the corpus is needed.

1. Sizes are summed by source; targets follow from the weights by water filling
   (a source stops at ``MAX_REPEATS`` times its size, the excess goes to the
   others by weight).
2. A source's target becomes whole passes over its blocks and a part of one
   more.  The part's end is found by running sums over two levels of about
   sqrt(blocks) rows, then over the documents of the one block it falls in, so
   no window ever sees a source's documents or all its blocks.  After the last
   document that fits by at least half, the one document of that block that best
   fits the words still missing (or none) joins.
3. The block quotas (blocks that a source gives in all, repeats counted) are
   split among ``shards`` outputs (as many as keep each to about ``SHARD_WORDS``
   words, 64 at least) by a binary tree: a node gives its left child
   half of its draws, divided among sources by a multivariate hypergeometric
   draw (one univariate draw per source, conditional on those before), and the
   rest to its right child.  Leaves hold exact quotas; a source's draws go to
   the shards as consecutive, disjoint runs of its permuted blocks.
4. A block meets its shards by (source, block); each shard orders its documents
   by a hash: the local shuffle.

Only DataFrame and SQL functions are used.  All hashes are of ids and source
names, so reruns agree, whatever the partitioning.

Null texts have size 0; null sources form one source, ordered last.  Rows that
share an id or have none get their order number from the id, a hash of the row
and the number of the copy among equal rows, so they spread over the blocks and
each is decided by itself.  Documents of size 0 are taken as often as their place in
the order says, with no words.  With no words at all every target is 0 and
nothing is taken.  An empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plantlens.llm.common import WORD, pinned, row_columns, whole_row

MAX_REPEATS = 3
BLOCK_DOCS = 64
SHARDS = 64                              # at least
SHARD_WORDS = 20_000_000                 # words of a shard, about 130 MB of text
ORDER_BITS = 60
SEED = 11
BROADCAST_SOURCES = 50_000               # rows of about 200 bytes
BROADCAST_IDS = 1_000_000                # ids (8 bytes) that several rows have


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order_number(doc_id: Column) -> Column:
    """The first 15 hex digits of the id's MD5 as a long."""
    return F.conv(F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def _row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(whole_row(docs))


def _shared_ids(docs: DataFrame) -> DataFrame:
    """(shared_id): the ids that several rows have, and null if a row has none."""
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    return pinned(counts.filter("n > 1 or doc_id is null").select(F.col("doc_id").alias("shared_id")))


def _placed(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` (doc_id, hash and others) with place and copy.  A row alone with
    its id has its place from the id, and no hash or copy.  Others have theirs
    from id, hash and the number of the copy: equal rows are counted and
    numbered from 1, whichever of them gets a number."""
    none = [F.lit(None).cast("long").alias("hash"), F.lit(None).cast("long").alias("copy")]
    others = [c for c in rows.columns if c != "hash"]
    single = rows.select(*others, *none, _order_number(F.col("doc_id")).alias("place"))
    n_shared = shared.count()
    if n_shared == 0:
        return single
    if n_shared <= BROADCAST_IDS:
        shared = F.broadcast(shared)
    alone = rows.join(shared, F.col("doc_id") == F.col("shared_id"), "left_anti").filter("doc_id is not null")
    single = alone.select(*others, *none, _order_number(F.col("doc_id")).alias("place"))
    several = rows.filter("doc_id is null").union(rows.join(shared, F.col("doc_id") == F.col("shared_id"), "left_semi"))
    counted = several.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    numbered = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    place = _order_number(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("hash").cast("string"), F.col("copy").cast("string")))
    return single.unionByName(numbered.select(*others, "hash", "copy", place.alias("place")))


def sizes(docs: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, size, hash, copy, place): one row for each row of ``docs``."""
    rows = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"),
                       word_count(F.col("text").cast("string")).alias("size"), _row_hash(docs).alias("hash"))
    return _placed(rows, _shared_ids(docs) if shared is None else shared)


# -------------------------------------------------------------------- targets
def weights_123(order: Column) -> Column:
    """1, 2, 3, repeating, by the source's place in code-point order."""
    return (order - 1) % 3 + 1


def targets(sized: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row a source: source, docs, source_size, weight, target.

    Sources fill in order of the level max_repeats * size / weight at which
    they are full; the first that is not full sets the level of all others.
    The windows here hold one row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    s = s.withColumn("weight", weights_123(F.row_number().over(by_name)).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * max_repeats)
    fills = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    s = (s.withColumn("all", F.sum("source_size").over(Window.partitionBy()))
         .withColumn("full", F.coalesce(F.sum("cap").over(fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("open", F.sum("weight").over(fills.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("rank", F.row_number().over(fills)))
    # share of this source if it and all behind it were open; it is full where that reaches its cap
    s = s.withColumn("stays_open", (F.col("all") - F.col("full")) * F.col("weight") < F.col("cap") * F.col("open"))
    first = F.min(F.when(F.col("stays_open"), F.struct("rank", "full", "open"))).over(Window.partitionBy())
    s = s.withColumn("level", first)
    share = ((F.col("all") - F.col("level.full")) * F.col("weight")).cast("double") / F.col("level.open")
    target = F.when(F.col("level").isNull() | (F.col("rank") < F.col("level.rank")), F.col("cap").cast("double")).otherwise(share)
    return s.select("source", "docs", "source_size", "weight", target.alias("target"))


# --------------------------------------------------------- whole and part passes
SOURCE = ["name", "no_name"]             # null-safe form of the source


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("name", F.coalesce("source", F.lit(""))).withColumn("no_name", F.col("source").isNull())


def _key() -> Column:
    """A row's place in its source's order, its own also among rows of one id."""
    return F.struct(F.col("place"), F.col("doc_id").isNull().alias("none"), *[
        F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("doc_id", "hash", "copy")])


def _edge(rows: DataFrame, order: str) -> DataFrame:
    """Per source the last row at which the running sum of words, from
    ``reached`` on, has not yet passed the rest; and the sum before it."""
    w = Window.partitionBy(*SOURCE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("begun", F.col("reached") + F.sum("words").over(w) - F.col("words"))
    at = run.filter("begun <= rest").groupBy(*SOURCE).agg(F.max(F.struct(F.col(order).alias("at"), "begun")).alias("x"))
    return at.select(*SOURCE, F.col("x.at").alias(order), F.col("x.begun").alias("reached"))


def passes(sized: DataFrame, per_source: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``per_source`` with, for each source: bits (it has 2^bits blocks), whole
    passes, and where the part pass ends: block ``edge``, row ``stop`` in it,
    and the ``spare`` row behind that joins as well."""
    bits = F.when(F.col("docs") <= block_docs, 0).otherwise(F.length(F.bin(F.expr(f"(docs - 1) div {block_docs}"))))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    s = (_keyed(per_source).withColumn("bits", bits.cast("int")).withColumn("passes", whole.cast("int"))
         .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")))
    s = pinned(s)
    part = s.filter("rest > 0").select(*SOURCE, "bits", "rest")
    blocks = pinned(_with_block(sized, part).groupBy(*SOURCE, "bits", "rest", "block").agg(F.sum("size").alias("words"))
                    .withColumn("upper", F.expr("shiftright(block, bits div 2)")))
    top = _edge(blocks.groupBy(*SOURCE, "rest", "upper").agg(F.sum("words").alias("words"))
                .withColumn("reached", F.lit(0)), "upper")
    edge = pinned(_edge(blocks.join(top, [*SOURCE, "upper"]), "block"))
    # the documents of the one block where the part pass ends
    rows = _with_block(sized, part).join(edge, [*SOURCE, "block"]).withColumn("key", _key())
    run = F.sum("size").over(Window.partitionBy(*SOURCE).orderBy("key"))
    rows = pinned(rows.withColumn("run", F.col("reached") + run).withColumn(
        "fits", F.col("run") * 2 - F.col("size") <= F.col("rest") * 2).select(*SOURCE, "key", "size", "run", "fits", "rest", "reached"))
    stop = rows.groupBy(*SOURCE).agg(F.max(F.when(F.col("fits"), F.struct("key", "run"))).alias("x"), F.max("reached").alias("reached"))
    stop = pinned(stop.select(*SOURCE, F.col("x.key").alias("stop"), F.coalesce("x.run", "reached").alias("taken")))
    left = rows.join(stop, SOURCE).filter("stop is null or key > stop").withColumn("missing", F.col("rest") - F.col("taken"))
    left = left.withColumn("off", F.abs(F.col("missing") - F.col("size"))).filter(F.col("off") < F.abs("missing"))
    spare = left.groupBy(*SOURCE).agg(F.min(F.struct("off", "key")).alias("x")).select(*SOURCE, F.col("x.key").alias("spare"))
    return s.join(edge.select(*SOURCE, F.col("block").alias("edge")), SOURCE, "left").join(
        stop.drop("taken"), SOURCE, "left").join(spare, SOURCE, "left")


def _with_block(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` with their source's columns and block.  ``per_source`` is pinned,
    so its rows can be counted: it is broadcast up to a bound."""
    if per_source.count() <= BROADCAST_SOURCES:
        per_source = F.broadcast(per_source)
    return rows.join(per_source, SOURCE).withColumn("block", F.expr(f"shiftright(place, {ORDER_BITS} - bits)"))


# -------------------------------------------------------------- splitting tree
def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value written into the plan once, not once a use."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _ln_factorial(x: Column) -> Column:
    """Stirling's series eight steps up, brought down again (in doubles: the
    product of whole numbers would overflow)."""
    def series(x):
        down = x + 1
        for k in range(2, 9):
            down = down * (x + k)
        return _bound(x + 8, lambda y: y * F.log(y) - y + F.log(y * 6.283185307179586) / 2 + 1 / (12 * y)
                      - 1 / (360 * y * y * y)) - F.log(down)

    return _bound(x.cast("double"), series)


def _ln_choose(n: Column, k: Column) -> Column:
    terms = F.transform(F.array(n, k, n - k), _ln_factorial)
    return _bound(terms, lambda t: F.get(t, 0) - F.get(t, 1) - F.get(t, 2))


def _hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked items among ``drawn`` of ``total`` without replacement, by
    inversion of the distribution function at ``u``."""
    def limits(c):
        t, m, d = c["t"], c["m"], c["d"]
        mean = d * m / F.greatest(t, F.lit(1.0))
        spread = F.sqrt(mean * (1 - m / F.greatest(t, F.lit(1.0)))) * 10 + 20
        low, high = F.greatest(F.lit(0.0), d + m - t), F.least(d, m)
        return F.struct(t.alias("t"), m.alias("m"), d.alias("d"), c["u"].alias("u"), low.alias("low"), high.alias("high"),
                        F.greatest(low, F.floor(mean - spread)).cast("double").alias("first"),
                        F.least(high, F.ceil(mean + spread)).cast("double").alias("last"))

    def search(c):
        p0 = F.exp(_ln_choose(c["m"], c["first"]) + _ln_choose(c["t"] - c["m"], c["d"] - c["first"]) - _ln_choose(c["t"], c["d"]))
        start = F.struct(c["first"].cast("long").alias("x"), F.lit(0.0).alias("sum"), p0.cast("double").alias("p"))

        def step(a, x):
            more = (c["m"] - x) * (c["d"] - x) / ((x + 1) * (c["t"] - c["m"] - c["d"] + x + 1))
            return F.struct(F.when(a["sum"] + a["p"] < c["u"], F.least((x + 1).cast("double"), c["last"])).otherwise(a["x"]).cast("long").alias("x"),
                            (a["sum"] + a["p"]).cast("double").alias("sum"), (a["p"] * more).cast("double").alias("p"))

        return F.when(c["low"] >= c["high"], c["low"].cast("long")).otherwise(F.aggregate(
            F.sequence(c["first"].cast("long"), c["last"].cast("long")), start, step, lambda a: a["x"]))

    given = F.struct(total.cast("double").alias("t"), marked.cast("double").alias("m"), drawn.cast("double").alias("d"),
                     u.cast("double").alias("u"))
    return _bound(_bound(given, limits), search)


def _left_share(quotas: Column, drawn: Column, node: Column) -> Column:
    """The left child's quotas: a multivariate hypergeometric draw."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)
    start = F.struct(total.alias("total"), drawn.cast("long").alias("drawn"), F.array().cast("array<bigint>").alias("out"))

    def step(a, q):
        u = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), node, F.size(a["out"])), 11) / F.lit(float(1 << 53))
        x = _hypergeometric(a["total"], q, a["drawn"], u)
        return _bound(x, lambda v: F.struct((a["total"] - q).alias("total"), (a["drawn"] - v).alias("drawn"),
                                            F.concat(a["out"], F.array(v)).alias("out")))

    return F.aggregate(quotas, start, step, lambda a: a["out"])


LEVELS_A_ROW = 6                         # tree levels that one row unfolds before its nodes become rows


def _children(node: Column) -> Column:
    """A node's two children, or the node itself where it is a leaf."""
    def split(n):
        total = F.aggregate(n["quotas"], F.lit(0).cast("long"), lambda a, q: a + q)
        lefts = F.floor(n["leaves"] / 2).cast("int")
        drawn = F.floor((total * lefts + lefts) / n["leaves"]).cast("long")
        return _bound(_left_share(n["quotas"], drawn, n["node"]), lambda left: F.array(
            _node(left, n["node"] * 2, n["first"], lefts),
            _node(F.zip_with(n["quotas"], left, lambda q, x: q - x), n["node"] * 2 + 1, n["first"] + lefts, n["leaves"] - lefts)))

    return F.when(node["leaves"] > 1, split(node)).otherwise(F.array(
        _node(node["quotas"], node["node"], node["first"], node["leaves"])))


def _node(quotas: Column, node: Column, first: Column, leaves: Column) -> Column:
    return F.struct(quotas.cast("array<bigint>").alias("quotas"), node.cast("long").alias("node"),
                    first.cast("int").alias("first"), leaves.cast("int").alias("leaves"))


def split_quotas(sources: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(name, no_name, shard, first, count): each source's draws (numbered from
    0 to its quota) dealt to the shards as runs.  ``sources`` has SOURCE and a
    quota; the tree's rows hold one number for each source."""
    listed = F.array_sort(F.collect_list(F.struct("no_name", "name", F.col("quota").cast("long").alias("quota"))))
    node = sources.agg(listed.alias("s")).select(F.col("s").alias("names"), _node(
        F.transform("s", lambda x: x["quota"]), F.lit(1), F.lit(0), F.lit(shards)).alias("kid"))
    depth = (shards - 1).bit_length()
    for done in range(0, depth, LEVELS_A_ROW):
        levels = min(LEVELS_A_ROW, depth - done)
        grown = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array("kid"),
                            lambda nodes, _: F.flatten(F.transform(nodes, _children)))
        node = node.select("names", F.explode(grown).alias("kid"))
        if done + levels < depth:
            node = node.repartition(F.col("kid.node"))
    node = node.select("names", "kid.*")
    dealt = node.select(F.col("first").alias("shard"), F.explode(F.arrays_zip("names", F.col("quotas").alias("counts"))).alias("x"))
    dealt = pinned(dealt.select(F.col("x.names.name").alias("name"), F.col("x.names.no_name").alias("no_name"), "shard",
                                F.col("x.counts").alias("count")))
    w = Window.partitionBy(*SOURCE).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)     # a row per shard
    return dealt.withColumn("first", F.coalesce(F.sum("count").over(w), F.lit(0))).filter("count > 0")


# ------------------------------------------------------------------------ mix
def plan(sized: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(sources, draws): the sources' targets and passes, and for every block
    that is drawn the shard of each of its passes."""
    sources = pinned(passes(sized, targets(sized.withColumn("source", F.when(~F.col("no_name"), F.col("name"))))))
    quota = F.expr("shiftleft(cast(passes as bigint), bits)") + F.coalesce(F.col("edge") + 1, F.lit(0))
    runs = split_quotas(sources.select(*SOURCE, quota.alias("quota")), shards)
    each = runs.join(sources.select(*SOURCE, "bits"), SOURCE).withColumn(
        "draw", F.explode(F.expr("sequence(first, first + count - 1)")))
    blocks = F.expr("shiftleft(1L, bits)")
    each = each.select(*SOURCE, (F.col("draw") % blocks).alias("block"), F.struct(
        F.floor(F.col("draw") / blocks).cast("int").alias("pass"), "shard").alias("one"))
    # a block has one draw a pass: at most max_repeats + 1
    return sources, each.groupBy(*SOURCE, "block").agg(F.sort_array(F.collect_list("one")).alias("draws"))


def mix(rows: DataFrame, sources: DataFrame, draws: DataFrame) -> DataFrame:
    """``rows`` (doc_id, hash, copy, place, SOURCE and any others) with source_size, target
    and ``draws``: (pass, shard) of each copy that the mix takes of the row."""
    info = sources.select(*SOURCE, "bits", "passes", "rest", "edge", "stop", "spare", "source_size", "target")
    key = _key()
    in_part = F.coalesce((F.col("block") < F.col("edge")) | ((F.col("block") == F.col("edge")) & (
        F.coalesce(key <= F.col("stop"), F.lit(False)) | F.coalesce(key == F.col("spare"), F.lit(False)))), F.lit(False))
    rows = _with_block(rows, info).withColumn("in_part", in_part).drop("edge", "stop", "spare", "rest", "bits")
    joined = rows.join(draws, [*SOURCE, "block"], "left")
    taken = F.filter("draws", lambda d: (d["pass"] < F.col("passes")) | F.col("in_part"))
    return joined.withColumn("draws", F.coalesce(taken, F.array().cast("array<struct<pass:int,shard:int>>"))).drop(
        "in_part", "passes", "block", *SOURCE)


def shards_for(sized: DataFrame) -> int:
    """Shards of about SHARD_WORDS words; the mix has as many words as its input."""
    words = sized.agg(F.sum("size")).first()[0] or 0
    return max(SHARDS, math.ceil(words / SHARD_WORDS))


def mixed_sizes(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: what the mix takes."""
    sized = pinned(_keyed(sizes(docs)).drop("source"))
    sources, draws = plan(sized, shards or shards_for(sized))
    m = mix(sized, sources, draws)
    copies = F.size("draws")
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"),
                    copies.alias("copies"))


def mixed_documents(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The mix itself: the rows of ``docs``, repeated or left out, dealt to one
    partition a shard and shuffled in it."""
    shared = _shared_ids(docs)
    sized = pinned(_keyed(sizes(docs, shared)).drop("source"))
    shards = shards or shards_for(sized)
    sources, draws = plan(sized, shards)
    rows = docs.select("doc_id", "source", _row_hash(docs).alias("hash"), whole_row(docs).alias("row"))
    rows = _keyed(_placed(rows, shared)).drop("source")
    out = mix(rows, sources, draws).select("doc_id", "hash", "copy", "row", F.explode("draws").alias("d"))
    order = F.xxhash64(F.lit(SEED), "d.shard", "doc_id", "d.pass", "hash", "copy")
    out = out.select("row", F.col("d.shard").alias("shard"), order.alias("order"))
    return out.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "order").select(row_columns(docs))


ORACLE = """
WITH words AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS place
  FROM documents),
per AS (
  SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size FROM words GROUP BY source),
weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, sum(source_size) OVER () AS total FROM per),
filling AS (
  SELECT *, source_size * 3 AS cap,
         row_number() OVER (ORDER BY source_size * 3 / weight, source NULLS LAST) AS turn FROM weighted),
levels AS (
  SELECT a.*, a.total - coalesce((SELECT sum(b.cap) FROM filling b WHERE b.turn < a.turn), 0) AS left_over,
         (SELECT sum(b.weight) FROM filling b WHERE b.turn >= a.turn) AS open_weight FROM filling a),
water AS (
  SELECT arg_min(left_over, turn) AS l, arg_min(open_weight, turn) AS w, min(turn) AS t
  FROM levels WHERE left_over * weight < cap * open_weight),
aimed AS (
  SELECT source, docs, source_size,
         CASE WHEN t IS NULL OR turn < t THEN cap::DOUBLE ELSE (l * weight)::DOUBLE / w END AS target
  FROM levels, water),
passed AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes,
         CASE WHEN docs <= 64 THEN 0 ELSE length(bin((docs - 1) // 64)) END AS bits FROM aimed),
placed AS (
  SELECT w.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
         w.place >> (60 - p.bits) AS block,
         sum(w.size) OVER (PARTITION BY w.source ORDER BY w.place, w.doc_id) AS run
  FROM words w JOIN passed p ON w.source IS NOT DISTINCT FROM p.source),
edges AS (
  SELECT source, max(block) AS edge FROM (
    SELECT source, block, rest, min(run - size) AS begun FROM placed GROUP BY ALL) WHERE rest > 0 AND begun <= rest GROUP BY source),
prefix AS (
  SELECT p.*, e.edge, p.rest > 0 AND (p.block < e.edge OR (p.block = e.edge AND 2 * p.run - p.size <= 2 * p.rest)) AS kept
  FROM placed p LEFT JOIN edges e ON p.source IS NOT DISTINCT FROM e.source),
reach AS (
  SELECT source, max(place) FILTER (kept) AS stop, coalesce(max(run) FILTER (kept), 0) AS taken FROM prefix GROUP BY source),
fit AS (
  SELECT p.source, arg_min(p.doc_id, (abs(p.rest - r.taken - p.size), p.place, p.doc_id)) AS spare
  FROM prefix p JOIN reach r ON p.source IS NOT DISTINCT FROM r.source
  WHERE p.rest > 0 AND p.block = p.edge AND (r.stop IS NULL OR p.place > r.stop)
    AND abs(p.rest - r.taken - p.size) < abs(p.rest - r.taken)
  GROUP BY p.source)
SELECT p.doc_id, p.size, p.source_size, p.target,
       (p.size * (p.passes + (coalesce(p.place <= r.stop, FALSE) OR coalesce(p.doc_id = f.spare, FALSE))::INT))::BIGINT AS taken,
       (p.passes + (coalesce(p.place <= r.stop, FALSE) OR coalesce(p.doc_id = f.spare, FALSE))::INT)::INT AS copies
FROM prefix p JOIN reach r ON p.source IS NOT DISTINCT FROM r.source
LEFT JOIN fit f ON p.source IS NOT DISTINCT FROM f.source
"""
