"""Ordered scans that no key can hold in one task.

A window partitioned by a key sends all rows of that key to one task.  Here
the rows are dealt by *ranges* of (key, order) instead and written, so a key
with a third of the rows spreads over as many tasks as it fills.  Each block
is scanned by itself, and what a block needs from the blocks before it (a
running total, the last price) is carried over in a table with one row a block:
only the first key of a block can have begun earlier.  That bounds the
broadcast of the carried rows by the number of blocks.

Rows that agree in key and all order columns stay in one block.  These
operators run jobs while the plan is built (the ranges are sampled and the
blocks written to the shared checkpoint folder, which also cuts the lineage).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.operators.joins import price_intervals
from plantlens.sources.staging import staged

BLOCK = "_block"


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` in blocks of ascending (keys, order), nulls first, numbered in
    that order; written, so that the numbers hold."""
    return staged(df.repartitionByRange(*keys, *order).withColumn(BLOCK, F.spark_partition_id()), "ranged")


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality on the names, null with null; the right ones end in ``_in``."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[f"{n}_in"]) for n in names])


def carried(ends: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """``ends`` (one row for each block and key) reduced to the blocks whose
    first key began earlier, with the aggregates ``values`` over that key's earlier
    blocks."""
    everything = Window.partitionBy(*keys).orderBy(BLOCK) if keys else Window.orderBy(BLOCK)
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    out = ends.select(*keys, BLOCK, F.row_number().over(everything).alias("_nth"), *[v.over(before).alias(n) for n, v in values.items()])
    out = out.filter(F.col("_nth") > 1).drop("_nth")
    for name in (*keys, BLOCK):
        out = out.withColumnRenamed(name, f"{name}_in")
    return out


def running_sums_by_blocks(df: DataFrame, partition: list[str], order: list[str], cols: dict[str, str]) -> DataFrame:
    """The rows and sums of :func:`plantlens.operators.windows.running_sums`
    (``{output: input}``, ROWS from the first to the current row), with each key
    spread over many tasks; ``partition`` may be empty."""
    blocks = ranged(df, partition, order)
    inside = (Window.partitionBy(BLOCK, *partition).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = blocks.groupBy(*partition, BLOCK).agg(*[F.sum(src).alias(f"{out}_sum") for out, src in cols.items()])
    offsets = carried(totals, partition, {f"{out}_before": F.sum(f"{out}_sum") for out in cols})
    scanned = blocks.withColumns({out: F.sum(src).over(inside) for out, src in cols.items()})
    joined = scanned.join(F.broadcast(offsets), _same(scanned, offsets, [BLOCK, *partition]), "left")   # a row a block at most

    def added(out: str) -> Column:
        here, before = F.col(out), F.col(f"{out}_before")
        return F.coalesce(here + before, here, before).alias(out)

    return joined.select(*[scanned[c] for c in df.columns], *[added(out) for out in cols])


def asof_price_carry(loads: DataFrame, costs: DataFrame, open_end: str, keys=("region", "variety", "dm_band"),
                     load_date: str = "date", value: str = "price_usd_per_ton") -> DataFrame:
    """J3, union form: loads and prices in one order of (key, time, price before
    load), each load taking the last price seen, carried across blocks.

    Same rows as :func:`plantlens.operators.joins.asof_price_join`.  Nothing is
    expanded to days, so the interval ends may be of any orderable type (days,
    timestamps) and the work grows with loads + prices.  Loads with a null key or
    time get no price."""
    keys = list(keys)
    prices = price_intervals(costs, open_end, tuple(keys)).filter(F.col("next_effective_date") > F.col("effective_date"))
    prices = prices.dropna(subset=keys)
    price = F.struct(F.col(value).alias("value"), F.col("next_effective_date").alias("until"))
    load = F.struct(*[loads[c] for c in loads.columns])
    hashable = [c for c in loads.columns if not isinstance(loads.schema[c].dataType, (T.MapType, T.VariantType))]
    at = loads.schema[load_date].dataType
    row_t, price_t = loads.select(load.alias("r")).schema["r"].dataType, prices.select(price.alias("p")).schema["p"].dataType
    both = prices.select(*keys, F.col("effective_date").cast(at).alias("_time"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"),
                         price.alias("_price"), F.lit(None).cast(row_t).alias("_load")).unionByName(
        loads.select(*keys, F.col(load_date).alias("_time"), F.lit(1).alias("_kind"), F.xxhash64(*hashable).alias("_tie"),
                     F.lit(None).cast(price_t).alias("_price"), load.alias("_load")))
    blocks = ranged(both, keys, ["_time", "_kind", "_tie"])
    seen = Window.partitionBy(BLOCK, *keys).orderBy("_time", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = blocks.groupBy(*keys, BLOCK).agg(F.max_by("_price", F.when(F.col("_kind") == 0, F.col("_time"))).alias("_end"))
    before = carried(ends, keys, {"_carried": F.last("_end", ignorenulls=True)})
    scanned = blocks.withColumn("_seen", F.last("_price", ignorenulls=True).over(seen)).filter(F.col("_kind") == 1)
    joined = scanned.join(F.broadcast(before), _same(scanned, before, [BLOCK, *keys]), "left")          # a row a block at most
    found = F.coalesce("_seen", "_carried")
    return joined.select("_load.*", F.when(F.col("_time") < found["until"], found["value"]).alias(value))
