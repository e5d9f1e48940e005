"""Spark's ``hash(string)`` (Murmur3 x86 32-bit over UTF-8 bytes, seed 42) as
a DuckDB expression, so the oracle can check the fallback arrival day of
malformed load ids.  ASCII input only (load ids are ASCII).

Spark mixes the 4-byte little-endian words, then each remaining tail byte as
its own (sign-extended) block, then finalises with the byte length.
32-bit arithmetic is emulated on HUGEINT/BIGINT with masks.
"""

M32 = "4294967296"


def _mul(x: str, c: int) -> str:
    return f"CAST((CAST({x} AS HUGEINT) * {c}) % {M32} AS BIGINT)"


def _rotl(x: str, r: int) -> str:
    return f"(((({x}) << {r}) | (({x}) >> {32 - r})) & 4294967295)"


def bytes_list(s: str) -> str:
    return f"list_transform(range(1, length({s}) + 1), lambda i: ascii(substr({s}, i, 1)))"


def murmur3_blocks(s: str) -> str:
    """The k1 values (already passed through mixK1) of string ``s``."""
    b = bytes_list(s)
    n = f"length({s})"
    aligned = f"({n} - {n} % 4)"
    words = (f"list_transform(range(0, {aligned} // 4), lambda j: "
             f"CAST({b}[4 * j + 1] + {b}[4 * j + 2] * 256 + {b}[4 * j + 3] * 65536 "
             f"+ {b}[4 * j + 4] * 16777216 AS BIGINT))")
    tail = f"list_transform(range({aligned}, {n}), lambda i: CAST({b}[i + 1] AS BIGINT))"
    ks = f"list_concat({words}, {tail})"
    k1 = f"list_transform({ks}, lambda x: {_mul('x', 0xCC9E2D51)})"
    k1 = f"list_transform({k1}, lambda x: {_rotl('x', 15)})"
    return f"list_transform({k1}, lambda x: {_mul('x', 0x1B873593)})"


def murmur3_body(s: str) -> str:
    """h1 after all blocks (before finalisation)."""
    mixed = f"xor(acc, k)"
    step = f"(({_rotl(mixed, 13)} * 5 + {0xE6546B64}) % {M32})"
    return f"list_reduce(list_prepend(CAST(42 AS BIGINT), {murmur3_blocks(s)}), lambda acc, k: {step})"


def fmix_steps(h: str, n: str) -> list[tuple[str, str]]:
    """Finalisation as (column, expression) steps for chained subqueries."""
    return [
        ("_h1", f"xor({h}, {n})"),
        ("_h2", "xor(_h1, _h1 >> 16)"),
        ("_h3", _mul("_h2", 0x85EBCA6B)),
        ("_h4", "xor(_h3, _h3 >> 13)"),
        ("_h5", _mul("_h4", 0xC2B2AE35)),
        ("_h6", "xor(_h5, _h5 >> 16)"),
        ("_hash", f"CASE WHEN _h6 >= 2147483648 THEN _h6 - {M32} ELSE _h6 END"),
    ]


def with_spark_hash(table_sql: str, col: str) -> str:
    """``SELECT *, <spark hash of col> AS _hash FROM (table_sql)`` via chained selects."""
    inner = (f"SELECT *, {murmur3_body(col)} AS _h0, CAST(length({col}) AS BIGINT) AS _len "
             f"FROM ({table_sql})")
    steps = fmix_steps("_h0", "_len")
    sql = inner
    for name, expr in steps:
        sql = f"SELECT *, {expr} AS {name} FROM ({sql})"
    return sql
