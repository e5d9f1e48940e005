"""Brute-force DuckDB oracle texts for the correctness gate.

Each oracle query is the stand-in projections, the silver and gold tables as
CTEs (unreferenced CTEs are dropped by DuckDB's planner) and a final SELECT.
Double columns are rounded with the same IEEE steps the Spark side uses
(plantlens.functions.columns.stable_round), so two engines that summed in a
different order still hash equal.
"""

from __future__ import annotations

from plantlens.functions.columns import ROUND_OFFSET
from plantlens.oracle.layers_sql import GOLD_CTES, KPI_SQL, SILVER_CTES
from plantlens.oracle.standins_sql import RAW_CTES

ALL_CTES = {**RAW_CTES, **SILVER_CTES, **GOLD_CTES}


def with_ctes(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in ALL_CTES.items())
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def rounded(body: str, digits: dict[str, int]) -> str:
    """Wrap ``body`` so the named double columns are rounded like the Spark side."""
    if not digits:
        return with_ctes(body)
    repl = ", ".join(f"floor({c} * {10 ** d}.0 + {ROUND_OFFSET!r}) / {10 ** d}.0 AS {c}" for c, d in digits.items())
    return with_ctes(f"SELECT * REPLACE ({repl}) FROM (\n{body.strip()}\n) q")


# Folders whose parquet schemas (not data) type the oracle texts; the column
# types of a query do not depend on the scale factor.
SCHEMA_SOURCES = ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"]
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# The test tables' published schemas (TESTDATA.md, FIXTURES.md), used as empty
# tables when no parquet folder is at hand.
_DDL = {
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, "
                "l_linestatus VARCHAR, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
    "conversations": "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR",
    "labels": "doc_id BIGINT, quality INTEGER, toxic INTEGER",
    "pages": "page_id BIGINT, url VARCHAR, html VARCHAR",
    "documents": "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT",
}
_con = None


def _schema_connection():
    import os

    import duckdb

    con = duckdb.connect()
    for folder in SCHEMA_SOURCES:
        if all(os.path.exists(f"{folder}/{t}.parquet") for t in _DDL):
            for t in _TABLES:
                if os.path.exists(f"{folder}/{t}.parquet"):
                    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
            return con
    for t, cols in _DDL.items():
        con.execute(f"CREATE TABLE {t} ({cols})")
    return con


def _describe(sql: str) -> list[tuple[str, str]]:
    global _con
    if _con is None:
        _con = _schema_connection()
    rel = _con.sql(f"SELECT * FROM ({sql}) LIMIT 0")
    return list(zip(rel.columns, [str(t) for t in rel.types]))


def as_text_dates(sql: str, date_fmt: str, ts_fmt: str) -> str:
    """Wrap ``sql`` so DATE and TIMESTAMP columns come out as ISO text (the
    Spark side renders them the same way).  Column types are found by
    binding the query in DuckDB against the test tables' schemas; if that is
    not possible the text is returned unchanged."""
    try:
        cols = _describe(sql)
    except Exception:
        return sql
    repl = []
    for name, typ in cols:
        if typ == "DATE":
            repl.append(f"strftime({name}, '{date_fmt}') AS {name}")
        elif typ.startswith("TIMESTAMP"):
            repl.append(f"strftime({name}, '{ts_fmt}') AS {name}")
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) dated"


__all__ = ["ALL_CTES", "KPI_SQL", "as_text_dates", "rounded", "with_ctes"]
