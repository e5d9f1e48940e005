"""Join operators.

A side is hinted for broadcast only where the caller states that it is a small
dimension; other joins are left to Spark's size threshold and to AQE, and may
be salted for hot keys.  Building a plan runs no job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def stated_small(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast hint for a side whose bound the caller states (``small``); any
    other side is left to ``spark.sql.autoBroadcastJoinThreshold`` and AQE, which
    measure its bytes.  Nothing is counted while a plan is built."""
    return F.broadcast(df) if small else df


def spec_join(events: DataFrame, specs: DataFrame,
              keys=("plant_id", "plant_name", "product_name"),
              spec_cols=("plant_line", "min_dry_matter_pct", "max_dry_matter_pct"),
              small: bool = False) -> DataFrame:
    """LEFT join readings to the product spec.

    Readings carry no line, so one reading fans out to every line that makes
    the product (parity, H2).  ``small`` states that the spec table is a bounded
    dimension (plants x lines x products): it is then broadcast and the
    readings are never shuffled.
    """
    right = specs.select(*keys, *spec_cols)
    return events.join(stated_small(right, small), list(keys), "left")


def price_intervals(costs: DataFrame, open_end: str,
                    keys=("region", "variety", "dm_band"), date_col: str = "effective_date",
                    tie_break=("supplier_id", "contract_id", "price_usd_per_ton")) -> DataFrame:
    """``[effective_date, next_effective_date)`` per key with
    ``LEAD(effective_date, 1, open_end)``.

    Prices that share a key and a date get a total order from ``tie_break``
    (H1): all but the last of them get an empty interval, so at most one
    price covers any day and the result is repeatable.  The window partitions
    the price list (a dimension) by key; the large load table never passes
    through it.
    """
    w = Window.partitionBy(*keys).orderBy(date_col, *tie_break)
    return costs.select(
        *keys, date_col, *tie_break,
        F.lead(date_col, 1, _dt.date.fromisoformat(str(open_end))).over(w).alias("next_effective_date"),
    )


def interval_days(intervals: DataFrame, keys=("region", "variety", "dm_band"),
                  date_col: str = "effective_date", value_col: str = "price_usd_per_ton",
                  out_date: str = "date") -> DataFrame:
    """Expand each non-empty interval into one row per covered day.

    Because the intervals of one key are disjoint, the result has at most one
    row per (key, day), and the as-of join becomes a plain equi-join on a
    high-cardinality key: no range predicate, no per-key hot partition.
    """
    non_empty = intervals.filter(F.col("next_effective_date") > F.col(date_col))
    return non_empty.select(
        *keys, value_col,
        F.explode(F.sequence(F.col(date_col), F.date_sub("next_effective_date", 1))).alias(out_date),
    )


def asof_price_join(loads: DataFrame, costs: DataFrame, open_end: str,
                    keys=("region", "variety", "dm_band"), load_date: str = "date",
                    small: bool = False, salt_buckets: int = 0) -> DataFrame:
    """LEFT join each load to the price in force on its day.

    Same rows as ``l.key = p.key AND l.date >= p.effective_date AND
    l.date < p.next_effective_date``, as an equi-join of the loads with the
    per-day price table on (key, day): no range predicate and no hot key.
    ``small`` states that this table (keys x covered days) is bounded: it is
    broadcast and the loads are not shuffled.  Otherwise Spark chooses;
    ``salt_buckets > 0`` salts that join (:func:`salted_join`).
    """
    days = interval_days(price_intervals(costs, open_end, keys), keys, out_date=load_date)
    if small or salt_buckets < 1:
        return loads.join(stated_small(days, small), [*keys, load_date], "left")
    return salted_join(loads, days, [*keys, load_date], "left", salt_buckets)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
                buckets: int = 8) -> DataFrame:
    """Equi-join that spreads each key of ``big`` over ``buckets`` tasks.

    ``big`` rows get a salt from a hash of their own columns (deterministic,
    so a retried task sees the same salt; no random numbers); ``small`` is
    replicated once per salt.  A key holding a third of ``big`` then lands
    in ``buckets`` shuffle partitions instead of one.  The small side grows
    by ``buckets``, so use this for a many-to-few join whose small side is
    too large to broadcast.  Same rows as ``big.join(small, keys, how)`` for
    inner and left joins.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets))
    b = big.withColumn("_salt", salt)
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    return b.join(s, [*keys, "_salt"], how).drop("_salt")


def _range_join(loads: DataFrame, intervals: DataFrame, keys, load_date: str) -> DataFrame:
    p = intervals.select(*[F.col(k).alias(f"_p_{k}") for k in keys], "effective_date", "next_effective_date",
                         "price_usd_per_ton")
    cond = [F.col(k) == F.col(f"_p_{k}") for k in keys] + [
        F.col(load_date) >= F.col("effective_date"), F.col(load_date) < F.col("next_effective_date")]
    return loads.join(p, cond, "left").select(*loads.columns, "price_usd_per_ton")


def asof_price_join_range(loads: DataFrame, costs: DataFrame, open_end: str,
                          keys=("region", "variety", "dm_band"), load_date: str = "date") -> DataFrame:
    """J3, literal form: equi-join on the keys with the range as the join
    condition, no broadcast hint.  Kept as a reference plan for tests."""
    return _range_join(loads, price_intervals(costs, open_end, keys), keys, load_date)
