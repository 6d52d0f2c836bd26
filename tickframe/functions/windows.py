"""Per-series window specs and pandas-style rolling aggregates.

A bar series is the rows of one ``symbol`` ordered by ``open_time``.  Its rows
are numbered once (``_i``, 0-based) and cut into stretches of ``BLOCK_ROWS``
(``_blk``); a frame is dealt in parts (``_part``): one part a series
(``positioned``), or parts of a fixed number of rows with copies of their
neighbours' rows (``operators.parts``).  Every window of the library is
partitioned by ``(symbol, _part)`` and ordered by ``(_blk, _i)`` -- the same
order as ``open_time`` -- so part windows, stretch windows
(``partitionBy(key, _part, _blk)``) and stretch-range frames all need the same
sort: one exchange and two sorts for a whole chain of indicators.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickframe.functions.expr import col_or

KEY = "symbol"
TIME = "open_time"
POS = "_i"
PART = "_part"
BLK = "_blk"
OWN = "_own"      # in a frame of parts: whether the row is the part's own
BLOCK_ROWS = 640  # default stretch; EWMs whose decay needs others take multiples or fractions of it


def positioned(df: DataFrame, key: str = KEY, order: str = TIME) -> DataFrame:
    """Add ``_i`` (row number - 1 in ``order``), ``_blk`` and one ``_part`` per series; frames that have them pass."""
    if POS in df.columns:
        return df
    df = df.withColumn(POS, F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)
    return df.withColumns({PART: F.lit(0).cast("long"), BLK: stretch()})


def stretch(rows: int = BLOCK_ROWS) -> Column:
    return F.floor(F.col(POS) / F.lit(rows)).cast("long")


def unpositioned(df: DataFrame) -> DataFrame:
    return df.drop(POS, BLK, PART)


@dataclass(frozen=True)
class Parts:
    """Rows of a part, and the rows copied into it from the part before and the part after."""
    rows: int = 65_536
    back: int = 0
    fwd: int = 0


#: The parts of the plan being built; a context variable, so threads building plans don't see each other's.
_PARTS: ContextVar[Parts | None] = ContextVar("tickframe_parts", default=None)


@contextmanager
def in_parts(parts: Parts):
    """Within this context a window that looks past the rows copied into a part raises."""
    token = _PARTS.set(parts)
    try:
        yield parts
    finally:
        _PARTS.reset(token)


def current_parts() -> Parts | None:
    return _PARTS.get()


#: The most rows of a series in the plan being built, if the caller has cut the series.
_LONGEST: ContextVar[int | None] = ContextVar("tickframe_longest", default=None)


@contextmanager
def series_upto(rows: int | None):
    """Within this context no series has more than ``rows`` rows (None: no bound)."""
    token = _LONGEST.set(rows)
    try:
        yield rows
    finally:
        _LONGEST.reset(token)


def longest_series() -> int | None:
    return _LONGEST.get()


def _reach(back: int = 0, fwd: int = 0) -> None:
    """A window that looks past the copied neighbour rows would be cut short without notice."""
    p = _PARTS.get()
    if p is not None and (back > p.back or fwd > p.fwd):
        raise ValueError(f"window needs {back} rows back and {fwd} ahead; the parts hold {p.back} and {p.fwd}")


def series(key: str = KEY, order: str = TIME) -> WindowSpec:
    """Series window; needs ``positioned`` columns (order is by position)."""
    return Window.partitionBy(key, PART).orderBy(BLK, POS)


def running(key: str = KEY, order: str = TIME) -> WindowSpec:
    if _PARTS.get() is not None:
        raise ValueError("a running window spans parts")
    return series(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trailing(n: int, key: str = KEY, order: str = TIME) -> WindowSpec:
    _reach(back=n - 1)
    return series(key, order).rowsBetween(-(n - 1), Window.currentRow)


def full_window(c, n: int, agg, key: str = KEY, order: str = TIME) -> Column:
    """``agg`` over the last ``n`` rows, NULL unless all ``n`` values are present.

    This is pandas ``rolling(n)`` with the default ``min_periods=n``: Spark
    frames are partial at the start of a series, so the count guard restores
    the "full window" rule (one NULL inside the frame also blanks the row).
    """
    c = col_or(c)
    frame = trailing(n, key, order)
    return F.when(F.count(c).over(frame) == n, agg(c).over(frame))


def rolling_min(c, n, **kw) -> Column:
    return full_window(c, n, F.min, **kw)


def rolling_max(c, n, **kw) -> Column:
    return full_window(c, n, F.max, **kw)


def rolling_mean(c, n, **kw) -> Column:
    return full_window(c, n, F.avg, **kw)


def with_rolling_mean(df: DataFrame, c, n: int, out: str) -> DataFrame:
    """``rolling_mean`` as a column.  A sliding frame adds up all its rows for every row, so a long window is put
    together from sums of shorter ones that follow each other: 200 rows are 10 sums of 20."""
    short = max(d for d in range(1, math.isqrt(n) * 2 + 1) if n % d == 0)
    if n < 50 or not 2 < short < n:
        return df.withColumn(out, rolling_mean(c, n))
    _reach(back=n - 1)
    df = df.withColumn("_short", rolling_sum(c, short))          # NULL unless all its rows are there
    total = F.col("_short")
    for at in range(short, n, short):
        total = total + lag("_short", at)
    return df.withColumn(out, total / F.lit(float(n))).drop("_short")


def rolling_sum(c, n, **kw) -> Column:
    return full_window(c, n, F.sum, **kw)


def rolling_std(c, n, **kw) -> Column:
    """Sample standard deviation (ddof=1) over a full window."""
    return full_window(c, n, F.stddev_samp, **kw)


def lag(c, n: int = 1, key: str = KEY, order: str = TIME) -> Column:
    _reach(back=n)
    return F.lag(col_or(c), n).over(series(key, order))


def lead(c, n: int = 1, key: str = KEY, order: str = TIME) -> Column:
    _reach(fwd=n)
    return F.lead(col_or(c), n).over(series(key, order))


def diff(c, n: int = 1, key: str = KEY, order: str = TIME) -> Column:
    return col_or(c) - lag(c, n, key, order)


def forward_max(c, n: int, key: str = KEY, order: str = TIME) -> Column:
    """max of the next ``n`` rows; NULL unless all ``n`` exist and are non-null,
    and NULL on the first ``n-1`` rows (pandas ``shift(-n).rolling(n).max()``)."""
    _reach(fwd=n)
    c = col_or(c)
    frame = series(key, order).rowsBetween(1, n)
    return F.when((F.col(POS) >= n - 1) & (F.count(c).over(frame) == n), F.max(c).over(frame))
