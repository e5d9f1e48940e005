"""Connected components of a distributed link table (union-find on Spark).

Alternates the two star steps of Kiveris et al., "Connected Components in
MapReduce and Beyond": the large step hangs every larger neighbour of a node
on the smallest node it sees, the small step does so for its smaller
neighbours.  Each is a minimum per node and a join, so a hub with very many
links is only a skewed join key, which AQE splits; no neighbour list is ever
gathered.  The link table shrinks to one star per component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("m"))
    # a larger neighbour of `node` is hung on the least of node and its neighbours
    return (links.select(F.col("lo").alias("node"), F.col("hi").alias("other")).join(least, "node")
            .select(F.col("other").alias("hi"), F.col("m").alias("lo")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).filter("hi > lo").distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` has two columns of any one orderable type, a row per link.
    Returns (node, component): every node of a link with the smallest node it
    reaches.  Links with a null end, self links and repeats are ignored; an
    empty table gives an empty table."""
    a, b = links.columns
    links = (links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a).alias("_a"), F.col(b).alias("_b"))
             .filter("_a is not null and _b is not null and hi > lo").select("hi", "lo").distinct())
    scratch = Scratch(links.sparkSession, "components")
    links = scratch.keep(links)
    before = None
    for _ in range(max_rounds):
        last, links = links, scratch.keep(_small_star(_large_star(links)))
        scratch.drop(last)
        # star shape reached when no row changes; the digest is order-free
        state = links.agg(F.count("*"), F.sum(F.hash("hi", "lo").cast("long")), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    roots = links.select(F.col("lo").alias("node")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
