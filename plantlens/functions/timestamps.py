"""Timestamp encodings used at the sink and source edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
MISSING_TS_TEXT = "NaT"


def iso_utc_ms(c: Column) -> Column:
    """S3: timestamp -> ISO-8601 UTC text floored to milliseconds; NULL -> 'NaT'.

    Relies on the session time zone being UTC (see plantlens.session).
    """
    return F.coalesce(F.date_format(F.date_trunc("MILLISECOND", c), ISO_MS_FORMAT),
                      F.lit(MISSING_TS_TEXT))


def native_ms(c: Column) -> Column:
    """Keep a real timestamp, floored to milliseconds."""
    return F.date_trunc("MILLISECOND", c.cast("timestamp"))


def parse_iso_timestamp(c: Column) -> Column:
    """Inverse of :func:`iso_utc_ms`.  'NaT', empty and malformed text -> NULL
    instead of an ANSI cast error (H8)."""
    return F.nullif(F.nullif(F.trim(c), F.lit(MISSING_TS_TEXT)), F.lit("")).try_cast("timestamp")


def try_timestamp(c: Column, formats: list[str] | None = None) -> Column:
    """``TRY_CAST(text AS TIMESTAMP)``; optional extra formats are tried
    in order after the cast (H9), e.g. ``["MM/dd/yyyy HH:mm:ss"]``."""
    parsed = c.try_cast("timestamp")
    if not formats:
        return parsed
    return F.coalesce(parsed, *[F.try_to_timestamp(c, F.lit(f)) for f in formats])
