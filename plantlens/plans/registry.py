"""Registry of checkable queries: key -> Spark builder + DuckDB oracle.

takes (spark, sf_dir) and returns a lazy DataFrame over the whole test
tables; the oracle is the same result written as plain SQL for DuckDB over
the same parquet files, or ``None`` where only a rows check is possible.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.functions.columns import stable_round

MONEY = 2      # digits kept for money and other large sums
RATIO = 6      # digits kept for averages and ratios


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None
    digits: dict[str, int] = field(default_factory=dict)
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(key: str, oracle: str | None = None, digits: dict[str, int] | None = None):
    def deco(fn):
        REGISTRY[key] = Query(fn, oracle, dict(digits or {}), (fn.__doc__ or "").strip())
        return fn
    return deco


DATE_TEXT = ("yyyy-MM-dd", "%Y-%m-%d")                                  # (Spark, DuckDB)
TIMESTAMP_TEXT = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "%Y-%m-%d %H:%M:%S.%f")


def finish(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Check projection: an engine-independent rendering of the result.

    Double columns are bucketed (every one must be listed in ``digits`` so
    the oracle rounds the very same set); dates and timestamps become ISO
    text, which both engines print the same way whatever client reads them.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            if f.name not in digits:
                raise KeyError(f"double column {f.name!r} has no rounding digits")
            cols.append(stable_round(F.col(f.name), digits[f.name]).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(f.name, DATE_TEXT[0]).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(f.name, TIMESTAMP_TEXT[0]).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def spark_query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    q = REGISTRY[key]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(q.build(spark, sf_dir), q.digits)

    run.__name__ = key
    run.__doc__ = q.doc
    return run


def oracle_text(key: str) -> str | None:
    from plantlens.oracle import as_text_dates, rounded

    q = REGISTRY[key]
    return None if q.oracle is None else as_text_dates(rounded(q.oracle, q.digits), DATE_TEXT[1], TIMESTAMP_TEXT[1])


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from plantlens.plans import queries_core  # noqa: F401
    from plantlens.plans import queries_ops  # noqa: F401
    from plantlens.plans import queries_extra  # noqa: F401
    from plantlens.plans import queries_stream  # noqa: F401
    return REGISTRY
