"""

Everything is a built-in Column expression, so it stays inside whole-stage
codegen and parquet pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for right results.
REGION_PREFIXES = [("NA-", "NA"), ("EU-", "EU")]        # P7: plant name prefix -> region
DM_BAND_LABELS = ["<=21%", "21-22%", "22-23%", ">=23%"]  # P9: band labels, edges 21 / 22 / 23
FLAG_TOLERANCE_PP = 0.3                                  # P11: flag tolerance in points
LOAD_DATE_PATTERN = ".*-([0-9]{8})-.*"                   # F6: yyyyMMdd between dashes
# Same matches as LOAD_DATE_PATTERN with less backtracking: RLIKE searches,
# so the test needs no '.*' around it, and the trailing '.*' never changes
# group 1 (the greedy leading '.*' still picks the last date in the id).
LOAD_DATE_TEST = "-[0-9]{8}-"
LOAD_DATE_EXTRACT = ".*-([0-9]{8})-"
LOAD_DATE_FALLBACK_START = "2025-07-10"                  # F9: fallback date base
LOAD_DATE_FALLBACK_DAYS = 114                            # F9: fallback date modulus


def unknown(c: Column | str, default: str = "Unknown") -> Column:
    """Default for missing text."""
    return F.coalesce(_col(c), F.lit(default))


def mutual_fallback(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """(a <- b, b <- a), both cast to text first (H6: under ANSI,
    COALESCE(int, string) widens to BIGINT and fails on text)."""
    a, b = _col(a).cast("string"), _col(b).cast("string")
    return F.coalesce(a, b), F.coalesce(b, a)


def region_of(plant_name: Column | str) -> Column:
    """P7: 'NA-…' -> 'NA', 'EU-…' -> 'EU', else NULL."""
    c = _col(plant_name)
    expr = None
    for prefix, region in REGION_PREFIXES:
        cond = c.startswith(prefix)
        expr = F.when(cond, F.lit(region)) if expr is None else expr.when(cond, F.lit(region))
    return expr


def dm_band(dm: Column | str) -> Column:
    """Dry-matter price band.  Half-open bands with an asymmetric top edge:
    <=21, (21,22], (22,23), >=23; NULL stays NULL."""
    c = _col(dm)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c <= 21.0, F.lit(DM_BAND_LABELS[0]))
            .when((c > 21.0) & (c <= 22.0), F.lit(DM_BAND_LABELS[1]))
            .when((c > 22.0) & (c < 23.0), F.lit(DM_BAND_LABELS[2]))
            .otherwise(F.lit(DM_BAND_LABELS[3])))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """P10: num / den when den > 0, else NULL (never an ANSI divide error)."""
    d = _col(den)
    return F.when(d > 0, _col(num) / d)


def nonzero_or_one(total: Column) -> Column:
    """P10: a zero total becomes 1 so shares of an empty reading are 0."""
    return F.when(total == 0, F.lit(1)).otherwise(total)


def below(value: Column | str, lower: Column | str, tol: float = FLAG_TOLERANCE_PP) -> Column:
    """Value < lower - tol; a NULL comparison gives FALSE, not NULL."""
    return F.when(_col(value) < (_col(lower) - F.lit(tol)), F.lit(True)).otherwise(F.lit(False))


def above(value: Column | str, upper: Column | str, tol: float = FLAG_TOLERANCE_PP) -> Column:
    """Value > upper + tol; NULL -> FALSE."""
    return F.when(_col(value) > (_col(upper) + F.lit(tol)), F.lit(True)).otherwise(F.lit(False))


def initcap_trim(c: Column | str) -> Column:
    """INITCAP(TRIM(x)); INITCAP lowers the rest of each word."""
    return F.initcap(F.trim(_col(c)))


def load_arrival_date(load_number: Column | str) -> Column:
    """yyyyMMdd between dashes, else a stable pseudo-random day in a
    114-day range from Murmur3 ``hash`` (widened before ABS: ABS(INT_MIN)
    raises under ANSI).  Eight digits that are not a calendar day give NULL
    instead of failing the job (TO_DATE raises under ANSI)."""
    c = _col(load_number)
    parsed = F.try_to_timestamp(F.regexp_extract(c, LOAD_DATE_EXTRACT, 1), F.lit("yyyyMMdd")).cast("date")
    fallback = F.date_add(F.lit(LOAD_DATE_FALLBACK_START).cast("date"),
                          (F.abs(F.hash(c).cast("bigint")) % LOAD_DATE_FALLBACK_DAYS).cast("int"))
    return F.when(c.rlike(LOAD_DATE_TEST), parsed).otherwise(fallback)


def week_start(c: Column | str) -> Column:
    """Monday of the week, as a TIMESTAMP (DATE_TRUNC('WEEK', …))."""
    return F.date_trunc("WEEK", _col(c))


def age_years(start: Column | str, as_of: Column) -> Column:
    """ROUND(DATEDIFF(as_of, start) / 365.25, 2) as a double; NULL
    start -> NULL.  Rounded in exact decimal (HALF_UP), then widened."""
    days = F.datediff(as_of, _col(start)).cast("decimal(10,0)")
    return F.when(_col(start).isNotNull(),
                  F.round(days / F.lit(365.25).cast("decimal(5,2)"), 2).cast("double"))


def depreciated_throughput(rated: Column | str, age: Column, rate: float = 0.005,
                           floor_share: float = 0.70) -> Column:
    """max(rated * (1 - rate * age), rated * floor_share); NULL rated -> NULL."""
    r = _col(rated)
    return F.when(r.isNotNull(),
                  F.greatest(r * (F.lit(1.0) - F.lit(rate) * F.coalesce(age, F.lit(0.0))),
                             r * F.lit(floor_share)))


def dominant_class(avgs: list[Column]) -> Column:
    """A3: index of the largest of five averages; ties -> lowest index;
    when every average is NULL the chain falls through to the last class."""
    expr = None
    for i, a in enumerate(avgs[:-1]):
        others = [o for j, o in enumerate(avgs) if j != i]
        cond = a >= F.greatest(*others)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(avgs) - 1))


def sanitize_name(c: Column | str, default: str = "knowledge_assistant") -> Column:
    """Space -> '_', other non [A-Za-z0-9_-] -> '_', runs of '_'/'-' of length
    two or more -> '_', strip '_'/'-' at both ends, empty -> default."""
    s = F.regexp_replace(_col(c), " ", "_")
    s = F.regexp_replace(s, "[^a-zA-Z0-9_-]", "_")
    s = F.regexp_replace(s, "[_-]{2,}", "_")
    s = F.regexp_replace(s, "^[_-]+|[_-]+$", "")
    return F.when(s == "", F.lit(default)).otherwise(s)


def path_leaf_name(c: Column | str) -> Column:
    """Last path component (trailing '/' ignored), space and '.' -> '_'."""
    leaf = F.regexp_extract(F.regexp_replace(_col(c), "/+$", ""), "[^/]*$", 0)
    return F.translate(leaf, " .", "__")


# Offset of the bucketing grid in stable_round: an irrational-looking fraction
# so that short terminating decimals (x.xxxxxx5, common in averages of
# 2-decimal data) never sit on a bucket edge.
ROUND_OFFSET = 0.3819660112501051


def stable_round(c: Column | str, digits: int) -> Column:
    """floor(x * 10^d + 0.381966...) / 10^d: buckets of width 10^-d whose edges
    lie off the decimal grid.  The same IEEE steps run in every engine, so two
    engines that computed the same double always agree, and two that differ
    by float summation order only disagree when the value lies within that
    noise of an edge (ROUND itself differs between engines at half-way
    cases, and half-way cases are common)."""
    scale = float(10 ** digits)
    return F.floor(_col(c) * F.lit(scale) + F.lit(ROUND_OFFSET)) / F.lit(scale)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
