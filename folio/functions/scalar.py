"""Column-level helpers. All are built-in Spark expressions (no Python UDFs),
so they stay inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.config import FINE_PER_DAY


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first="first_name", last="last_name") -> Column:
    """``CONCAT(first, ' ', last)``: NULL if either part is NULL (MySQL semantics)."""
    return F.concat(col_(first), F.lit(" "), col_(last))


def days_between(end, start) -> Column:
    """``DATEDIFF(end, start)`` as BIGINT (whole days, end minus start)."""
    return F.datediff(col_(end), col_(start)).cast("long")


def fine_days(due, returned) -> Column:
    """W1 ``CalculateFineDays``: days late, never negative; NULL if a date is NULL."""
    d = F.datediff(col_(returned), col_(due)).cast("long")
    return F.when(d < 0, F.lit(0).cast("long")).otherwise(d)


def fine_for_days(days) -> Column:
    """``days * 0.25`` as DECIMAL(10,2), the fine for a number of late days."""
    return (col_(days) * F.lit(Decimal(FINE_PER_DAY))).cast("decimal(10,2)")


def year_month(d) -> Column:
    """``DATE_FORMAT(d, '%Y-%m')``."""
    return F.date_format(col_(d), "yyyy-MM")


def ratio_round(num, den, scale: int, mult: int = 1) -> Column:
    """``ROUND(num * mult / den, scale)`` computed exactly, rounding half up.

    ``num`` is an integer (a count or a sum of day counts, which may be
    negative), ``den`` a count. Halves round away from zero. The quotient is
    an integer division, and only the final value is a DOUBLE, so the result
    does not depend on floating-point rounding of the ratio. NULL when ``den``
    is NULL or 0.
    """
    factor = 10 ** scale
    den_nz = F.when(col_(den) != 0, col_(den).cast("long"))
    n = col_(num).cast("long")
    quotient = F.call_function("div", F.abs(n) * (2 * mult * factor) + den_nz, den_nz * 2)
    return F.signum(n) * quotient / F.lit(float(factor))
