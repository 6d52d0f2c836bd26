"""Series in parts of a bounded number of rows: one layout for every size, no task holds a whole series.

1. Rows are numbered without a window over a series: bars are counted per (symbol, month), the months' offsets are
   prefix sums on that small table, rows are numbered inside their month.  The counts also give the series'
   length, by which short series leave.
2. A part is ``Parts.rows`` rows.  It gets a copy of the ``back`` last rows of the part before and of the ``fwd``
   first rows of the part after (``_own`` is False on them); the frame is hash-partitioned by (symbol, part).
   Rolling, lag and lead windows run per part: the copies give them their full context.
3. EWMs need all history.  A part computed without it yields the affine map of its recurrence (``state_columns`` of
   its last row).  A scan over the table of parts, one row for ``rows`` bars, composes the maps; what a part takes over comes
   back as a seed on the row before its first own row (``ewm.seed_columns``).  Maps are only computed of
   parts that another one follows, so series of one part cost no more than windows per series.

The maps' branch reads the same exchange as the rows, which Spark reuses (``followed`` keeps them alike).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.windows import BLK, KEY, OWN, PART, POS, TIME, Parts, in_parts, positioned, series_upto, stretch, unpositioned
from tickframe.operators.ewm import Ewm, decay, ewm_passes, seed_columns, state_columns

#: deepest look-back of the feature chain: 200-row SMA, then a 3-row difference; label look-ahead
ENRICH = Parts(back=199 + 3, fwd=5)
LENGTH = "_n_series"   # where the series ends: one more than its last position
START = "_start"       # position of a part's first own row
_UNB = Window.unboundedPreceding


def numbered(df: DataFrame, key: str = KEY, time: str = TIME, bucket: str = "month", min_rows: int | None = None) -> DataFrame:
    """Add ``_i`` and the series length ``_n_series`` without a window over a series; series below ``min_rows`` go."""
    df = df.withColumn("_bk", F.trunc(F.to_date(time), bucket))
    counts = df.groupBy(key, "_bk").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(key).orderBy("_bk")
    offs = counts.select(key, "_bk",
                         F.coalesce(F.sum("_cnt").over(w.rowsBetween(_UNB, -1)), F.lit(0)).alias("_off"),
                         F.sum("_cnt").over(Window.partitionBy(key)).alias(LENGTH))
    if min_rows:
        offs = offs.filter(F.col(LENGTH) >= min_rows)
    df = df.join(offs, [key, "_bk"])
    rn = F.row_number().over(Window.partitionBy(key, "_bk").orderBy(time))
    return df.withColumn(POS, (F.col("_off") + rn - 1).cast("long")).drop("_bk", "_off")


def parted(df: DataFrame, parts: Parts = ENRICH, key: str = KEY, base: str | None = None, before: DataFrame | None = None) -> DataFrame:
    """A numbered frame dealt in parts: own rows and copies, hash-partitioned by (key, part).

    ``base``: column with the position at which the frame's rows begin (else 0); ``before``: rows before it, which
    the first part takes as copies."""
    if max(parts.back, parts.fwd) > parts.rows:
        raise ValueError(f"a copy comes from one neighbour: {parts} needs longer parts")
    first = F.col(base) if base else F.lit(0).cast("long")
    part = F.floor((F.col(POS) - first) / F.lit(parts.rows)).cast("long")
    df = df.withColumn(PART, part).withColumn(START, first + F.col(PART) * F.lit(parts.rows))
    at = F.col(POS) - F.col(START)
    to_next = (at >= parts.rows - parts.back) & (F.col(START) + F.lit(parts.rows) < F.col(LENGTH))
    to_last = (at < parts.fwd) & (F.col(PART) > 0)
    home = lambda where, shift, own: F.when(where, F.struct(
        (F.col(PART) + shift).alias(PART), (F.col(START) + shift * parts.rows).alias(START), F.lit(own).alias(OWN)))
    homes = F.array_compact(F.array(home(F.lit(True), 0, True), home(to_next, 1, False), home(to_last, -1, False)))
    rows = [c for c in df.columns if c not in (PART, START)]
    dealt = df.select(*rows, F.inline(homes))
    if before is not None:
        dealt = dealt.unionByName(before.withColumns({PART: F.lit(0).cast("long"), START: first, OWN: F.lit(False)}).select(dealt.columns))
    return dealt.repartition(key, PART).withColumn(BLK, stretch())


def own_rows(df: DataFrame, *kept: str) -> DataFrame:
    """The rows of a frame of parts without copies and helper columns (but ``kept``)."""
    helpers = [c for c in (OWN, PART, BLK, POS, LENGTH, START) if c not in kept]
    return df.filter(F.col(OWN) & (F.col(LENGTH) > 0)).drop(*helpers)


def followed(df: DataFrame, parts: Parts) -> DataFrame:
    """The rows of parts that another part follows.  The condition counts as non-deterministic, so it is not
    moved below the exchange, which this branch then shares with the rows."""
    return df.filter(F.when(F.spark_partition_id() >= 0, F.col(START) + F.lit(parts.rows) < F.col(LENGTH)))


def maps(df: DataFrame, specs: list[Ewm], parts: Parts, kept: list[str], key: str = KEY) -> DataFrame:
    """One row per followed part: (key, part, its start, state columns of its last own row).

    ``kept`` are the columns of the frame's exchange; one value of them all keeps the exchange the same."""
    found = ewm_passes(df, specs, key, states=True).filter(OWN)
    states = [c for s in specs for c in state_columns(s)]
    return (found.groupBy(key, PART, START)
            .agg(F.max_by(F.struct(*states), F.col(POS)).alias("_state"), F.max(F.struct(*kept)).alias("_kept"))
            .select(key, PART, START, "_state.*", F.col("_kept").isNotNull().alias("_kept")))


def seeds(part_maps: DataFrame, specs: list[Ewm], parts: Parts, key: str = KEY, initial: DataFrame | None = None) -> DataFrame:
    """(key, part, seed columns) of every part that takes something over: the maps of the parts before it, composed,
    beginning with the ``initial`` state (key, seed columns) of a series if there is one.

    The table of maps has one row for ``parts.rows`` bars; a task streams a series' rows in order."""
    names = [c for s in specs for c in seed_columns(s)]
    if initial is not None:
        known = {c: F.col(n) for s in specs for c, n in zip(state_columns(s), seed_columns(s))}
        typed = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in part_maps.schema.fields if f.name not in (key, PART)]
        part_maps = part_maps.unionByName(initial.select(key, F.lit(-1).cast("long").alias(PART), *typed))
    kind = part_maps.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, {PART} long, " + ", ".join(f"{c} {'long' if c.startswith('_sn') else 'double'}" for c in names)
    return (part_maps.repartition(key).sortWithinPartitions(key, PART)
            .mapInArrow(_scan(specs, parts.rows, key), schema))


def _scan(specs: list[Ewm], rows: int, key: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        series, carried = None, {}
        for batch in batches:
            out: dict[str, list] = {c: [] for c in (key, PART, *(c for s in specs for c in seed_columns(s)))}
            for row in batch.to_pylist():
                if row[key] != series:
                    series, carried = row[key], {}
                out[key].append(series)
                out[PART].append(row[PART] + 1)
                for s in specs:
                    state = carried[s.out] = compose(s, carried.get(s.out), [row[c] for c in state_columns(s)], row[START], rows)
                    for c, v in zip(seed_columns(s), state):
                        out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(key)), pa.array(out[PART], pa.int64()),
                 *(pa.array(v, pa.int64() if c.startswith("_sn") else pa.float64()) for c, v in list(out.items())[2:])], list(out))
    return run


def compose(s: Ewm, carried: tuple | None, part: list, start: int, rows: int) -> tuple:
    """The state (value, log weight, observations) after a part of ``rows`` rows from ``start`` on, given the state
    before it and the part's own map."""
    y, w, n, first, x, factor = part
    if carried is None or carried[0] is None:
        return (y, w, n or 0)
    y_in, w_in, n_in = carried
    lam = decay(s)
    if not n:
        return (y_in, w_in - lam * rows, n_in)
    if s.alpha >= 1:
        return (y, w, n + n_in)
    if s.adjust:
        old = w_in - lam * rows
        top = max(old, w)
        a, b = math.exp(old - top), math.exp(w - top)
        return ((a * y_in + b * y) / (a + b), top + math.log(a + b), n + n_in)
    old = math.exp(w_in - lam * (first - start + 1))
    at_first = (old * y_in + s.alpha * x) / (old + s.alpha)
    return (y + math.exp(factor) * (at_first - x), w, n + n_in)


def seeded(df: DataFrame, table: DataFrame, specs: list[Ewm], parts: Parts, key: str = KEY) -> DataFrame:
    """``df`` with the seed columns, set on the row before each part's first own row."""
    names = [c for s in specs for c in seed_columns(s)]
    here = F.col(POS) == F.col(START) - 1
    given = table.select(F.col(key).alias("_k"), F.col(PART).alias("_kp"), *[F.col(c).alias(f"_g{c}") for c in names])
    j = df.join(given, (F.col(key) == F.col("_k")) & (F.col(PART) == F.col("_kp")), "left")
    return j.select(*df.columns, *[F.when(here, F.col(f"_g{c}")).alias(c) for c in names])


def staged_ewms(df: DataFrame, stages: list[tuple[Callable[[DataFrame], DataFrame], list[Ewm]]], parts: Parts,
                key: str = KEY, initial: DataFrame | None = None, states: bool = False) -> DataFrame:
    """Runs stages of (columns before, EWMs) on a frame of parts; a stage may read the EWMs of those before.

    ``initial``: (key, seed columns) of series that go on; ``states``: keep the state columns."""
    base, tables = list(df.columns), []

    def upto(frame: DataFrame, k: int, states: bool) -> DataFrame:
        for (prepare, specs), table in zip(stages[:k], tables):
            frame = prepare(frame)
            if specs:
                names = [c for s in specs for c in seed_columns(s)]
                frame = ewm_passes(seeded(frame, table, specs, parts, key), specs, key, seeded=True, states=states).drop(*names)
        return frame

    for k, (prepare, specs) in enumerate(stages):
        own_maps = maps(prepare(upto(followed(df, parts), k, False)), specs, parts, base, key) if specs else None
        tables.append(seeds(own_maps, specs, parts, key, initial) if specs else None)
    return upto(df, len(stages), states)


def on_parts(df: DataFrame, compute: Callable[[DataFrame], DataFrame], parts: Parts | None = ENRICH, min_rows: int | None = None,
             key: str = KEY, longest: int | None = None) -> DataFrame:
    """Numbers and deals ``df``, applies ``compute`` to the frame of parts and returns the own rows.

    ``parts=None`` is for series that the caller has cut to a bounded number of rows (the last 300 bars of each
    symbol, say): they need no counts and no seeds, a series is one part; ``longest`` tells that number."""
    if parts is None:
        df = positioned(df.repartition(key))
        if min_rows:
            length = F.count(F.lit(1)).over(Window.partitionBy(key))
            df = df.withColumn(LENGTH, length).filter(F.col(LENGTH) >= min_rows).drop(LENGTH)
        with series_upto(longest):
            return unpositioned(compute(df))
    with in_parts(parts):
        return own_rows(compute(parted(numbered(df, key, min_rows=min_rows), parts, key)))


def with_ewm_parts(df: DataFrame, specs: list[Ewm], parts: Parts = Parts(back=1), key: str = KEY) -> DataFrame:
    """``ewm.with_ewm`` in parts: one column per spec for series of any length, any decay and any gaps."""
    return on_parts(df, lambda d: staged_ewms(d, [(lambda f: f, specs)], parts, key), parts, key=key)
