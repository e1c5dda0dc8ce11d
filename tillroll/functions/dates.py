"""Date and time expressions of the reports (SQLite strftime/JULIANDAY re-expressed).

Times are TIMESTAMP_NTZ and nothing here depends on the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(ts: Column) -> Column:
    """``strftime('%Y-%m', ts)`` as text."""
    return F.substring(F.to_date(ts).cast("string"), 1, 7)


def month_ordinal(ts: Column) -> Column:
    """year * 12 + month, for month arithmetic without text."""
    d = F.to_date(ts)
    return F.year(d) * 12 + F.month(d) - 1


def month_of_ordinal(n: Column) -> Column:
    """Inverse of :func:`month_ordinal`, as 'YYYY-MM' text."""
    return F.format_string("%04d-%02d", F.floor(n / 12).cast("int"), (n % 12 + 1).cast("int"))


def day(ts: Column) -> Column:
    """``DATE(ts)``."""
    return F.to_date(ts)


def days_between(later: Column, earlier: Column) -> Column:
    """``CAST(JULIANDAY(DATE(later)) - JULIANDAY(DATE(earlier)) AS INTEGER)`` as BIGINT."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("bigint")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the same clock, as DECIMAL(20,0).

    Decimal, so that sums and products of it do not overflow BIGINT.
    """
    gap = ts.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    part = lambda name: F.extract(F.lit(name), gap)
    whole = part("DAY").cast("bigint") * 86_400 + part("HOUR") * 3_600 + part("MINUTE") * 60
    return (whole.cast("decimal(14,0)") * F.lit(1_000_000)
            + (part("SECOND") * F.lit(1_000_000)).cast("decimal(14,0)")).cast("decimal(20,0)")


def micros_between(later: Column, earlier: Column) -> Column:
    """Exact timestamp difference in microseconds, DECIMAL(20,0) (fractional JULIANDAY difference * 86400e6)."""
    return (epoch_micros(later) - epoch_micros(earlier)).cast("decimal(20,0)")


def iso_date(d: Column) -> Column:
    """SQLite-style date text 'YYYY-MM-DD'."""
    return F.to_date(d).cast("string")


def iso_datetime(ts: Column) -> Column:
    """SQLite-style datetime text 'YYYY-MM-DD HH:MM:SS'."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)
