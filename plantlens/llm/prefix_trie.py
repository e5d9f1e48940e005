"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns (role and text); its members are
the conversations that start with it.  Peeling starts at the greatest depth:
conversations that end there are merged into one node for each sequence, then
the last turn of every node is stripped, and what is left is regrouped with the
conversations that end one level higher.  Each strip hands a node's sums (members,
leaves, saved code points) to its parent, so nodes are found and their subtrees
summed in one pass over the levels.

1. ``conversation_paths``: turns are hashed where they are read; only 128-bit
   digests and lengths are shuffled, and a conversation becomes a *path*, the
   chained digests of its first 1, 2, ... turns.  Two nodes are equal when their
   chained digests are.
2. ``distinct_paths``: equal conversations become one path with their count and the
   hash of their sorted ids.  Ids are dealt by ranges of (path, id), so a
   sequence that a third of all conversations share is spread over tasks; a
   task packs its run of ids into chunks, and only chunks meet in one task.
3. Prefixes with more than a bounded number of distinct paths below them (at
   least ``GROUP_PATHS``, else a 1/``HOT_NODES`` share of all) are *hot*: few
   nodes close to the root.  Everything below them falls apart into small
   subtrees, and each is peeled whole inside one task (``peel``).
4. The hot nodes are peeled level by level as Spark aggregates over the
   subtrees' top rows, so a first turn that a third of all conversations share
   is a partial aggregate.  A level has at most ``HOT_NODES`` hot nodes, which is
   the bound of the broadcasts here.

Nothing depends on the depth of the trie but step 4, one round for each level
that has a hot node.  A task holds the digests of one conversation in step 1 (24
bytes a turn) and of one small subtree in step 3.

Turns are ordered by turn number, null first, equal numbers by their digest.
Null roles and texts are empty ones.  Rows without a conversation id belong to no
conversation and are left out.  Texts of any length are hashed whole; a repeated
row is a further turn.  An empty table gives an empty table (no root); extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import Scratch, batch, ship_package

GROUP_PATHS = 256            # distinct paths a task may always peel at once
HOT_NODES = 100_000          # most hot nodes of a level
CHUNK_IDS = 1 << 16          # ids packed into one row
JOINS = 16                   # levels looked up before the paths are written again
WIDTH = 16                   # bytes of a digest

PATH = "path binary, chars array<long>"
NODE = ("node binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        f"saved long, ends string, {PATH}")
NOBODY = hashlib.sha256(b"").hexdigest()
KINDS = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in ddl.split(", ")])


class Rows:
    """Rows gathered into record batches."""

    def __init__(self, ddl: str, most: int = 8192):
        self.schema, self.most, self.rows = arrow_schema(ddl), most, []

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        if len(self.rows) >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield batch(self.schema, *zip(*self.rows))
            self.rows = []


# ----------------------------------------------------------------------- paths
def chained(turns: list[tuple[bytes, int]]) -> tuple[bytes, list[int]]:
    """The digest of every prefix, one after the other, and the lengths."""
    parts, last = [], b""
    for digest, _ in turns:
        last = hashlib.blake2b(last + digest, digest_size=WIDTH).digest()
        parts.append(last)
    return b"".join(parts), [n for _, n in turns]


def with_head(conv_id: int, head: list, own: list, modulus: int) -> list:
    """``own`` with its first h turns replaced by the first h of ``head``."""
    h = zlib.crc32(str(conv_id).encode()) % modulus
    return head[:h] + own[h:]


def conversation_paths(conversations: DataFrame, block: int = 1, modulus: int = 1) -> DataFrame:
    """(conv_id, n, last, path, chars) of every conversation: its turns, the
    digest of all of them, of every prefix, and the turns' code points.

    With ``block`` over 1 the first h turns of conversation c are those of the
    conversation c - c % block, where h is crc32(c) % modulus."""
    ship_package(conversations.sparkSession)
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    conv = conversations["conv_id"].cast("long")
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.select(conv.alias("conv_id"), (conv - conv % block).alias("base"), conversations["turn"].alias("turn"),
                                 digest.alias("digest"), F.length(text).cast("long").alias("chars")).filter("conv_id is not null")
    # the conversation that lends its head comes first in its block
    dealt = turns.repartition("base").sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id",
                                                           F.col("turn").asc_nulls_first(), "digest")
    ddl = f"conv_id long, n int, last binary, {PATH}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, own, head = Rows(ddl, 1024), None, [], (None, [])

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal head
            conv_id, base = now
            turns = own
            if conv_id == base:
                head = (base, own[: modulus - 1])
            else:
                turns = with_head(conv_id, head[1] if head[0] == base else [], own, modulus)
            path, chars = chained(turns)
            yield from out.add(conv_id, len(turns), path[-WIDTH:], path, chars)

        for b in batches:
            for conv_id, base, digest, chars in zip(*(b.column(c).to_pylist() for c in ("conv_id", "base", "digest", "chars"))):
                if (conv_id, base) != now:
                    if now is not None:
                        yield from closed()
                    now, own = (conv_id, base), []
                own.append((digest, chars))
        if now is not None:
            yield from closed()
        yield from out.flush()

    return dealt.mapInArrow(run, ddl)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """One row for each different path: (last, conv_id, n_convs, ends, n, path,
    chars) with the smallest id, the number of conversations and the SHA-256 of
    their ids, rising, joined by commas."""
    chunk = f"last binary, conv_id long, n_convs long, ids binary, n int, {PATH}"
    whole = f"last binary, conv_id long, n_convs long, ends string, n int, {PATH}"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first, ids = Rows(chunk, 1024), None, []

        def closed() -> Iterator[pa.RecordBatch]:
            last, conv_id, n, path, chars = first
            yield from out.add(last, conv_id, len(ids), ",".join(map(str, ids)).encode(), n, path, chars)

        for b in batches:
            last_of, ids_of = b.column("last").to_pylist(), b.column("conv_id").to_pylist()
            for i, (last, conv_id) in enumerate(zip(last_of, ids_of)):
                if first is None or last != first[0] or len(ids) >= CHUNK_IDS:
                    if first is not None:
                        yield from closed()
                    first = (last, conv_id, b.column("n")[i].as_py(), b.column("path")[i].as_py(), b.column("chars")[i].as_py())
                    ids = []
                ids.append(conv_id)
        if first is not None:
            yield from closed()
        yield from out.flush()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first, total, sha = Rows(whole, 1024), None, 0, None

        def closed() -> Iterator[pa.RecordBatch]:
            last, conv_id, n, path, chars = first
            yield from out.add(last, conv_id, total, sha.hexdigest(), n, path, chars)

        for b in batches:
            for last, conv_id, k, ids, n, path, chars in zip(*(c.to_pylist() for c in b.columns)):
                if first is None or last != first[0]:
                    if first is not None:
                        yield from closed()
                    first, total, sha = (last, conv_id, n, path, chars), 0, hashlib.sha256(ids)
                else:
                    sha.update(b"," + ids)
                total += k
        if first is not None:
            yield from closed()
        yield from out.flush()

    chunks = paths.repartitionByRange("last", "conv_id").sortWithinPartitions("last", "conv_id").mapInArrow(packed, chunk)
    return chunks.repartition("last").sortWithinPartitions("last", "conv_id").mapInArrow(joined, whole)


# --------------------------------------------------------------------- peeling
class Node:
    """A node that survives at the current level, with its children's sums."""

    __slots__ = ("conv_id", "n_convs", "leaves", "saved", "children", "ends", "path", "chars")

    def __init__(self, path: bytes, chars: list[int]):
        self.conv_id, self.n_convs, self.leaves, self.saved = None, 0, 0, 0
        self.children, self.ends, self.path, self.chars = [], NOBODY, path, chars

    def take(self, conv_id: int, n_convs: int, leaves: int, saved: int) -> None:
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)
        self.n_convs += n_convs
        self.leaves += leaves
        self.saved += saved


def peel(paths: list[tuple], top: int) -> Iterator[tuple]:
    """The nodes (rows of NODE) at depth ``top`` and below of distinct paths that
    share their first ``top`` turns: (conv_id, n_convs, ends, n, path, chars).
    The row of the top node comes last; its parent is not known here."""
    ending: dict[int, list[tuple]] = {}
    for p in paths:
        ending.setdefault(p[3], []).append(p)
    alive: dict[bytes, Node] = {}
    for depth in range(max(ending), top - 1, -1):
        for conv_id, n_convs, ends, _, path, chars in ending.pop(depth, ()):
            node = alive.setdefault(path[-WIDTH:], Node(path, chars))
            node.take(conv_id, n_convs, 0, 0)
            node.ends = ends
        above: dict[bytes, Node] = {}
        for key, node in alive.items():
            node.leaves = node.leaves or 1
            node.saved += (node.n_convs - 1) * node.chars[depth - 1] if depth else 0
            for child in node.children:
                yield (*child[:3], node.conv_id, *child[3:], None, None)
            row = (key, depth, node.conv_id, node.n_convs, len(node.children), node.leaves, node.saved, node.ends)
            if depth == top:
                yield (*row[:3], None, *row[3:], node.path[: WIDTH * depth], node.chars[:depth])
                continue
            # strip the last turn and regroup
            over = node.path[WIDTH * (depth - 2): WIDTH * (depth - 1)] if depth > 1 else b""
            parent = above.setdefault(over, Node(node.path, node.chars))
            parent.take(node.conv_id, node.n_convs, node.leaves, node.saved)
            parent.children.append(row)
        alive = above


def prefix(depth: int) -> Column:
    """The digest of a path's first ``depth`` turns."""
    return F.substring("path", WIDTH * (depth - 1) + 1, WIDTH) if depth else F.substring("path", 1, 0)


def small_subtrees(paths: DataFrame) -> DataFrame:
    """NODE rows of the subtrees below the hot nodes; ``paths`` has their top
    depth in ``hot``.  Rows with a path are the subtrees' own roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, held = Rows(NODE), None, []

        def closed() -> Iterator[pa.RecordBatch]:
            for row in peel(held, now[1]):
                yield from out.add(*row)

        for b in batches:
            for root, top, *path in zip(*(c.to_pylist() for c in b.columns)):
                if (root, top) != now:
                    if now is not None:
                        yield from closed()
                    now, held = (root, top), []
                held.append(path)
        if now is not None:
            yield from closed()
        yield from out.flush()

    start = WIDTH * (F.col("hot") - 1) + 1
    root = F.when(F.col("hot") == 0, F.lit(b"")).otherwise(F.substring(F.col("path"), start, F.lit(WIDTH)))
    rows = paths.filter("n >= hot").select(root.alias("root"), "hot", "conv_id", "n_convs", "ends", "n", "path", "chars")
    return rows.repartition("root").sortWithinPartitions("root", "hot").mapInArrow(run, NODE)


def hot_levels(paths: DataFrame, scratch: Scratch, limit: int) -> tuple[DataFrame, int]:
    """``paths`` with ``hot``, the number of hot nodes on each (the root counts),
    and the number of levels that have any."""
    tagged = paths.withColumn("hot", F.lit(1))
    depth = 1
    while True:
        open_paths = tagged.filter((F.col("hot") == depth) & (F.col("n") >= depth))
        found = scratch.keep(open_paths.groupBy(prefix(depth).alias("key")).agg(F.count("*").alias("below"))
                             .filter(F.col("below") > limit).select("key"))
        if found.isEmpty():
            return tagged, depth
        some = F.broadcast(found.withColumn("one", F.lit(1)))            # at most HOT_NODES rows
        here = (prefix(depth) == F.col("key")) & (F.col("hot") == depth)
        tagged = tagged.join(some, here, "left").withColumn("hot", F.col("hot") + F.coalesce("one", F.lit(0))).drop("key", "one")
        if depth % JOINS == 0:
            tagged = scratch.keep(tagged)
        depth += 1


SUMS = ["conv_id", "n_convs", "n_leaves", "saved"]
OUT = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]


def trie(paths: DataFrame, group_paths: int = GROUP_PATHS, hot_nodes: int = HOT_NODES) -> DataFrame:
    """The nodes of the trie of ``paths`` (from ``conversation_paths``): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    scratch = Scratch(paths.sparkSession, "trie")
    every = scratch.keep(paths)
    known = scratch.keep(distinct_paths(every))
    scratch.drop(every)
    total = known.count()
    limit = max(group_paths, total // hot_nodes)
    if total <= limit:
        tagged, levels = known.withColumn("hot", F.lit(0)), 0
    else:
        tagged, levels = hot_levels(known, scratch, limit)
        tagged = scratch.keep(tagged)
    nodes = scratch.keep(small_subtrees(tagged))
    done = nodes.filter("path is null or depth = 0").select(OUT)
    tops = nodes.filter("path is not null").drop("parent_conv_id")
    above = tops.limit(0)
    for depth in range(levels - 1, -1, -1):
        below = tops.filter(F.col("depth") == depth + 1).union(above)
        children = below.select(prefix(depth).alias("key"), *SUMS, F.lit(1).alias("child"), F.lit(None).cast("string").alias("ends"),
                                "path", "chars")
        ended = tagged.filter((F.col("n") == depth) & (F.col("hot") == depth + 1)).select(
            prefix(depth).alias("key"), "conv_id", "n_convs", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"),
            F.lit(0).alias("child"), "ends", "path", "chars")
        grouped = children.union(ended).groupBy("key").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").cast("long").alias("n_children"),
            F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("below"),
            F.coalesce(F.max("ends"), F.lit(NOBODY)).alias("ends"), F.first(F.struct("path", "chars")).alias("p"))
        own = (F.col("n_convs") - 1) * F.get(F.col("p.chars"), depth - 1) if depth else F.lit(0)
        level = scratch.keep(grouped.select(
            F.col("key").alias("node"), F.lit(depth).alias("depth"), "conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("below") + own).cast("long").alias("saved"), "ends", F.substring("p.path", 1, WIDTH * depth).alias("path"),
            F.slice("p.chars", 1, depth).alias("chars")))
        parents = F.broadcast(level.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")))   # hot nodes
        done = done.union(below.join(parents, prefix(depth) == F.col("parent")).select(OUT))
        above = level
    if levels:
        done = done.union(above.withColumn("parent_conv_id", F.lit(None).cast("long")).select(OUT))
    return done.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                       F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations whose first turns come from their block."""
    return trie(conversation_paths(conversations, block=100, modulus=6))
