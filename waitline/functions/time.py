"""Time arithmetic as column expressions (H1-H3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MICROS = 60_000_000
ONE_DAY_MINUTES = 24 * 60
ONE_WEEK_MINUTES = 7 * 24 * 60


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def elapsed_minutes(start, end) -> Column:
    """Whole minutes from ``start`` to ``end``, floored (-90 s gives -2).

    ``timestamp_diff(MINUTE)`` truncates toward zero, so the floor is taken
    on exact microseconds with integer arithmetic: (d - pmod(d, m)) div m.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    m = F.lit(MINUTE_MICROS)
    # the numerator is an exact multiple of m, so rounding the quotient
    # only guards against double conversion beyond 2**53 microseconds
    return F.round((micros - F.pmod(micros, m)) / m).cast("bigint")


def ln(x) -> Column:
    """Natural log; null for non-positive input."""
    return F.ln(_c(x))


def log10(x) -> Column:
    return F.log10(_c(x))


def pow10(x) -> Column:
    """Inverse of ``log10``."""
    return F.pow(F.lit(10.0), _c(x))
