"""Row selection over bar tables: completeness, maturation, date ranges,
chronological split, latest rows, de-duplication, universe checks."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickframe.functions.windows import KEY, TIME

MATURATION_DAYS = 90  # fixed value: bars of a symbol's first 90 days are skipped in backtests


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``subset`` (default: all columns)."""
    return df.dropna("any", subset=subset)


def maturation(df: DataFrame, days: int = MATURATION_DAYS, key: str = KEY, time: str = TIME,
               skew_safe: bool = False) -> DataFrame:
    """Keep bars at or after (first bar of the symbol + ``days``).  The first bar
    is taken over the rows given, so apply after ``drop_incomplete``.

    Default: a window over the symbol (free on symbol-clustered rows).
    ``skew_safe``: minimum per (symbol, month), then per symbol on that small
    table, joined back; both branches read one (symbol, month) exchange."""
    if skew_safe:
        m = df.withColumn("_bk", F.trunc(F.to_date(time), "month")).repartition(key, "_bk")
        firsts = (m.groupBy(key, "_bk").agg(F.min(time).alias("_m"))
                   .groupBy(key).agg(F.min("_m").alias("_first")))
        return (m.join(firsts, key)
                 .filter(F.col(time) >= F.col("_first") + F.make_interval(days=F.lit(days)))
                 .drop("_first", "_bk"))
    first = F.min(time).over(Window.partitionBy(key))
    return (df.withColumn("_first", first)
              .filter(F.col(time) >= F.col("_first") + F.make_interval(days=F.lit(days)))
              .drop("_first"))


def _ts(v):
    if v is None or isinstance(v, dt.datetime):
        return v
    return dt.datetime.fromisoformat(str(v))


def ntz_lit(v):
    """A timestamp_ntz literal from a naive datetime / ISO text, independent of
    the session and Python time zones (a Python datetime literal is zoned)."""
    return F.lit(_ts(v).isoformat(sep=" ")).cast("timestamp_ntz")


def date_range(df: DataFrame, start=None, end=None, time: str = TIME) -> DataFrame:
    """Inclusive ``start <= time <= end``; either bound optional.  A date bound
    means midnight, so later bars of the end day fall out (as in the reference)."""
    start, end = _ts(start), _ts(end)
    if start is not None:
        df = df.filter(F.col(time) >= ntz_lit(start))
    if end is not None:
        df = df.filter(F.col(time) <= ntz_lit(end))
    return df


def chrono_split(df: DataFrame, train_frac: float = 0.8, time: str = TIME, key: str = KEY,
                 out: str = "is_train") -> DataFrame:
    """Mark the first floor(frac * n) rows of the global (time, key) order, unique per (time, key); rows
    without a time are 0.  The boundary row is an ``order_statistic``."""
    timed = df.filter(F.col(time).isNotNull()).select(time, key)
    n = timed.count()
    last = order_statistic(timed, time, key, math.floor(n * train_frac))
    if last is None:
        return df.withColumn(out, F.lit(0))
    at, name = ntz_lit(last[0]), F.lit(last[1])
    train = (F.col(time) < at) | ((F.col(time) == at) & (F.col(key) <= name))
    return df.withColumn(out, F.coalesce(train, F.lit(False)).cast("int"))


SKETCH = 10_000       # accuracy of the quantile sketches
EXACT_ROWS = 50_000   # a range of so many rows is put in order
KEY_BYTES = 7         # bytes of a key that one number holds, in order


def order_statistic(df: DataFrame, time: str, key: str, k: int, exact_rows: int = EXACT_ROWS) -> tuple | None:
    """The (time, key) of rank ``k`` (from 1) in their order, None if there is none.

    A quantile sketch gives bounds of the range in which rank k lies; the rows before it are counted exactly, and
    the range is narrowed again until few rows are left, first by time, then by ever more bytes of the key.  Each
    round is one aggregate of a few numbers; only the last range, of at most ``exact_rows`` rows (or rows
    equal in time and key), is ordered."""
    if k < 1:
        return None
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    rows, depth = df.select(time, key, micros.alias("_v")), 0
    while True:
        n, low, high = rows.agg(F.count("*"), F.min("_v"), F.max("_v")).first()
        if n < k:
            return None
        if n <= exact_rows:
            last = rows.orderBy(time, key).limit(k).agg(F.max(F.struct(time, key)).alias("m")).first()["m"]
            return last[time], last[key]
        if low == high:      # one value: go on with the next bytes of the key
            longest = rows.agg(F.max(F.octet_length(key))).first()[0] or 0
            if depth * KEY_BYTES >= longest:
                r = rows.first()
                return r[time], r[key]
            rows = rows.withColumn("_v", _bytes_of(key, depth))
            depth += 1
            continue
        share = [max(0.0, k / n - 2 / SKETCH), min(1.0, k / n + 2 / SKETCH)]
        a, b = rows.agg(F.percentile_approx("_v", share, SKETCH).alias("q")).first()["q"]
        below, inside = rows.agg(F.count_if(F.col("_v") < a), F.count_if(F.col("_v").between(a, b))).first()
        if below < k <= below + inside:
            found = F.col("_v").between(a, b)
        elif k <= below:     # the sketch missed: the range before it
            found, below = F.col("_v") < a, 0
        else:
            found, below = F.col("_v") > b, below + inside
        if a == low and b == high:   # no narrower: halve the range
            middle = (low + high) // 2
            below = rows.agg(F.count_if(F.col("_v") <= middle)).first()[0]
            found, below = (F.col("_v") <= middle, 0) if k <= below else (F.col("_v") > middle, below)
        rows, k = rows.filter(found), k - below


def _bytes_of(key: str, depth: int):
    """Bytes ``depth * KEY_BYTES`` to the next of a text as a number: the order of texts that agree before."""
    part = F.substring(F.encode(F.col(key), "UTF-8"), depth * KEY_BYTES + 1, KEY_BYTES)
    padded = F.rpad(F.hex(part), 2 * KEY_BYTES, "0")
    return F.conv(padded, 16, 10).cast("long") * (KEY_BYTES + 1) + F.octet_length(part)


def latest_bar(df: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """Latest row per series as an aggregate (partial max_by per task, no sort)."""
    cols = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(time)).alias("_r"))
              .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def last_n_bars(df: DataFrame, n: int, key: str = KEY, time: str = TIME) -> DataFrame:
    """Latest ``n`` bars per series (Catalyst applies a per-group limit before the shuffle)."""
    w = Window.partitionBy(key).orderBy(F.col(time).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def dedup_bars(pages: list[DataFrame], key: str = KEY, time: str = TIME, arrival: str | None = None) -> DataFrame:
    """Stitch pages of bars (older page first) and keep, per (key, time), the row
    of the earliest page.  An aggregate, so duplicates collapse map side.  Rows of
    one page: the smallest ``arrival`` (a column, not returned), then the smallest values."""
    tagged = None
    for n, p in enumerate(pages):
        p = p.withColumn("_page", F.lit(n))
        tagged = p if tagged is None else tagged.unionByName(p)
    cols = [c for c in pages[0].columns if c not in (key, time, arrival)]
    first = F.struct("_page", *([arrival] if arrival else []), *cols)
    return (tagged.groupBy(key, time).agg(F.min_by(F.struct(*cols), first).alias("_r"))
                  .select(key, time, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def first_n_symbols(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """Rows of the first ``n`` symbols in name order.  The symbol list is a
    distributed top-n (at most ``n`` rows), so the semi join broadcasts a
    side of proven size."""
    first = df.select(key).distinct().orderBy(key).limit(n)
    return df.join(F.broadcast(first), key, "left_semi")


def available_symbols(universe: DataFrame, bars: DataFrame, key: str = KEY) -> DataFrame:
    """Universe entries that have at least one bar."""
    return universe.join(bars.select(key), key, "left_semi")


def ingest_audit(universe: DataFrame, bars: DataFrame, min_bars: int = 250, key: str = KEY) -> DataFrame:
    """Enrichment counters: universe size, processed, missing source, too few rows."""
    counts = bars.groupBy(key).agg(F.count(F.lit(1)).alias("n_bars"))
    per = universe.select(key).distinct().join(counts, key, "left")
    n = F.col("n_bars")
    return per.agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(n >= min_bars).alias("processed"),
                   F.count_if(n.isNull()).alias("missing"),
                   F.count_if(n < min_bars).alias("too_few"))


def update_counted(universe: DataFrame, existing: DataFrame, recent: DataFrame, write, min_bars: int = 250,
                   key: str = KEY) -> dict[str, int]:
    """Writes the universe's recent bars with ``write(rows)`` and counts the symbols in the same job.

    ``updated`` have recent bars, ``skipped`` have none; of the updated, ``new`` had no bars before and ``too_few``
    have fewer than ``min_bars`` now.  The counts are metrics observed on the rows as they are written: a row's
    place in its symbol marks one row a symbol."""
    symbols = universe.select(key).distinct()
    before = existing.groupBy(key).agg(F.count(F.lit(1)).alias("_before"))
    per = (symbols.join(recent.groupBy(key).agg(F.count(F.lit(1)).alias("_recent"), F.min(TIME).alias("_first")), key, "left")
           .join(before, key, "left"))
    rows = per.join(recent.withColumnRenamed(key, "_k"), F.col(key) == F.col("_k"), "left").drop("_k")
    one = F.col("_first").isNull() | (F.col(TIME) == F.col("_first"))      # one row a symbol
    fresh = F.col("_recent").isNotNull()
    had = F.coalesce("_before", F.lit(0))
    seen = Observation()
    counted = rows.observe(seen, F.count_if(one).alias("total"), F.count_if(one & fresh).alias("updated"), F.count_if(one & ~fresh).alias("skipped"),
                           F.count_if(one & fresh & (had == 0)).alias("new"), F.count_if(one & fresh & (had + F.col("_recent") < min_bars)).alias("too_few"))
    write(counted.filter(F.col(TIME).isNotNull()).select(*[c for c in recent.columns]))
    return seen.get


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Outer union of columns: a column absent from a frame is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Column-pruned projection of the wanted columns that exist (Catalyst prunes the scan)."""
    return df.select(*[c for c in wanted if c in df.columns])
