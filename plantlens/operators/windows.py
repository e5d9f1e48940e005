"""Window operators (W2-W4) and trailing-period KPIs (Q2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, partition: list[str], order: list[str],
                 cols: dict[str, str]) -> DataFrame:
    """``SUM(c) OVER (PARTITION BY … ORDER BY … ROWS UNBOUNDED
    PRECEDING TO CURRENT ROW)`` for each ``{output: input}``.  All sums share
    one window, so Spark plans one sort and one Window node.

    Callers aggregate to (partition, order) grain first, so each window
    partition holds one row per period rather than raw events.
    """
    w = (Window.partitionBy(*partition).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({out: F.sum(src).over(w) for out, src in cols.items()})


def trailing_window(df: DataFrame, date_col: str, days: int, inclusive: bool = True,
                    anchor: Column | None = None) -> DataFrame:
    """Q2 (P12/J7): rows whose date lies in ``[max(date) - days, max(date)]``.

    The anchor is an uncorrelated scalar subquery (``DataFrame.scalar``), run
    once before the filter; no cross join and no driver round trip.  A caller
    that knows a cheaper table with the same latest date (e.g. the source an
    aggregate was built from) may pass that scalar as ``anchor``.  As in the
    reference, ``days=30`` keeps 31 calendar days (H10); ``inclusive=False``
    keeps exactly ``days`` days.
    """
    if anchor is None:
        anchor = df.select(F.max(date_col)).scalar()
    lo = F.date_sub(anchor, days if inclusive else days - 1)
    return df.filter(F.col(date_col).between(lo, anchor))


def trailing_kpi(df: DataFrame, date_col: str, days: int, agg: Column,
                 inclusive: bool = True, anchor: Column | None = None) -> DataFrame:
    """Q2: one-row KPI over the trailing window (any aggregate)."""
    return trailing_window(df, date_col, days, inclusive, anchor).agg(agg)


def trailing_sums(df: DataFrame, date_col: str, days: int, sums: dict[str, Column],
                  inclusive: bool = True, anchor: Column | None = None) -> DataFrame:
    """Q2: one row with the sum of each column over the trailing window
    ``[max(date) - days, max(date)]``.

    With an ``anchor`` (the latest day, known from partition names) the rows are
    filtered first, so a table partitioned by the date reads only the window's
    partitions.  Without one the rows are read once: a partial aggregate keeps
    one row a day, and the latest day is found among those.  Empty window -> NULL
    sums, as in SQL.  An average is a ratio of two such sums."""
    if anchor is not None:
        kept = trailing_window(df, date_col, days, inclusive, anchor)
        return kept.agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    daily = df.groupBy(F.col(date_col).alias("_day")).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    latest = F.max("_day").over(Window.partitionBy())                   # over one row a day
    kept = daily.withColumn("_latest", latest).filter(
        F.col("_day") >= F.date_sub("_latest", days if inclusive else days - 1))
    return kept.agg(*[F.sum(n).alias(n) for n in sums])
