"""Scalar column expressions with pandas-compatible missing-value rules.

pandas treats NaN as missing and divides IEEE style (0/0 -> NaN, x/0 -> inf);
Spark 4 runs with ANSI on, where ``/`` raises on a zero divisor and NaN is a
value that compares greater than everything.  These helpers give the pandas
meaning with SQL NULL as "missing" and keep everything JVM side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_or(c)
    return F.when(~F.isnan(c), c)


def ieee_div(a, b) -> Column:
    """a / b with IEEE results: x/0 -> +-inf, 0/0 -> NULL, NULL in -> NULL."""
    a, b = col_or(a), col_or(b)
    q = F.try_divide(a, b)
    return (F.when(b != 0, F.when(~F.isnan(q), q))
             .when(b == 0, F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))))


def inf_to_null(c) -> Column:
    c = col_or(c)
    return F.when(F.abs(c) != F.lit(INF), c)


def rnd(c, digits: int) -> Column:
    """Round half up for output as ``floor(x * 10^d + 0.5) / 10^d`` in double
    arithmetic (the same IEEE steps in any engine, unlike decimal ``round``).
    NaN becomes NULL, -0.0 becomes 0.0, |x| >= 1e14 and +-inf pass unchanged."""
    x = nan_to_null(col_or(c))
    scale = float(10 ** digits)
    return F.when(F.abs(x) < F.lit(1e14),
                  F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)).otherwise(x)


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 int with NULL condition meaning 0 (numpy.where)."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(1)).otherwise(F.lit(0)).cast("int")
