"""Exponentially weighted means as window functions (no UDF, no collect_list).

pandas ``Series.ewm(...).mean()`` is the recurrence
``y_k = a_k * y_{k-1} + b_k * x_k`` over the observed (non-NULL) rows, with
``a = w**g / (w**g + alpha)``, ``b = alpha / (w**g + alpha)`` (``g`` = rows since
the previous observation, ``w = 1 - alpha``; ``g = 1`` gives ``a = w``,
``b = alpha``) when ``adjust=False``, and the normalised weighted sum
``sum w**(i-j) x_j / sum w**(i-j)`` when ``adjust=True``.

Both unroll into ``y_k = sum_j b_j x_j exp(L_j - L_k)`` with ``L`` a running
log-decay.  A running sum over the whole series would overflow, so rows are
cut into stretches of ``B`` rows (``w**B < 1e-20`` for the slowest decay):
inside a stretch a running ``sum`` carries the terms relative to its start,
and the one previous stretch enters through a range frame
``rangeBetween(-1, -1)`` on the stretch number.  Older ones weigh less than
1e-20 relative and are dropped.  All specs of one call share the same windows,
so Catalyst puts them in the same Window operators.

The history of a part of a series (``operators.parts``) is three numbers a spec:
value, log of the weight it has left, observations.  They stand on the row before
the part's first own row as one weighted observation, from which the same
recurrence goes on; no history is dropped at the edge of a part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tickframe.functions.windows import BLK, BLOCK_ROWS, KEY, OWN, PART, POS, TIME, longest_series, positioned, stretch

_CARRY_LOG = math.log(1e20)  # older stretches weigh < 1e-20
_MAX_EXP = 600.0             # exp() is finite below ~709; the rest is room for the values


def alpha_from(span=None, com=None, alpha=None, halflife=None) -> float:
    given = [v is not None for v in (span, com, alpha, halflife)]
    if sum(given) != 1:
        raise ValueError("give exactly one of span, com, alpha, halflife")
    if span is not None:
        if span < 1:
            raise ValueError("span must be >= 1")
        return 2.0 / (span + 1.0)
    if com is not None:
        if com < 0:
            raise ValueError("com must be >= 0")
        return 1.0 / (1.0 + com)
    if halflife is not None:
        return 1.0 - math.exp(math.log(0.5) / halflife)
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    return float(alpha)


@dataclass(frozen=True)
class Ewm:
    """One EWM mean: ``out = ewm(src, alpha, adjust, min_periods).mean()``."""
    src: str  # a column name
    out: str
    alpha: float
    adjust: bool
    min_periods: int = 0


def ewm(src, out, *, span=None, com=None, alpha=None, halflife=None,
        adjust: bool = True, min_periods: int = 0) -> Ewm:
    return Ewm(src, out, alpha_from(span, com, alpha, halflife), adjust, min_periods)


def block_rows(alpha: float) -> int:
    """Rows a stretch needs for ``alpha``: ``BLOCK_ROWS`` doubled until older ones weigh < 1e-20, or halved
    until the growth inside one stays finite.  It depends on the parameter alone, never on the data."""
    lam = -math.log1p(-alpha) if alpha < 1 else 0.0
    rows = BLOCK_ROWS
    while 0 < rows * lam < _CARRY_LOG:
        rows *= 2
    while rows > 1 and rows * lam > _MAX_EXP:
        rows //= 2
    return rows


def with_ewm(df: DataFrame, specs: list[Ewm], key: str = KEY, order: str = TIME,
             keep_helpers: bool = False) -> DataFrame:
    """Add one column per spec.  Input rows must be unique per (key, order).
    Specs of one stretch size share one pass of windows over the same clustering."""
    if not specs:
        return df
    base = list(df.columns)
    df = ewm_passes(positioned(df, key, order), specs, key)
    keep = base + ([POS, BLK, PART] if keep_helpers or POS in base else []) + [s.out for s in specs]
    return df.select(*dict.fromkeys(keep))


def seed_columns(s: Ewm) -> tuple[str, str, str]:
    """Columns that hold, on the row before a part's first own row, the value, the log of the weight and the
    number of observations that the part takes over; NULL on all other rows."""
    return f"_sy_{s.out}", f"_sw_{s.out}", f"_sn_{s.out}"


def state_columns(s: Ewm) -> list[str]:
    """Columns of the state after a row: value, log weight, observations; then what a part that was computed
    without a seed tells about its map: first observation (place, value) and log of the factor of that value."""
    return [f"_t{c}_{s.out}" for c in ("y", "w", "n", "p", "x", "a")]


def ewm_passes(df: DataFrame, specs: list[Ewm], key: str = KEY, seeded: bool = False, states: bool = False) -> DataFrame:
    """The EWM columns (and ``state_columns``) of a frame with positions, a pass of windows per stretch size."""
    most = longest_series()
    if most is not None and not seeded and not states and OWN not in df.columns:
        one = [s for s in specs if s.alpha < 1 and block_rows(s.alpha) >= most]
        df = _one_stretch(df, one, most, key) if one else df
        specs = [s for s in specs if s not in one]
    for rows in sorted({block_rows(s.alpha) for s in specs}):
        df = _ewm_pass(df, [s for s in specs if block_rows(s.alpha) == rows], rows, key, seeded, states)
    return df


def _one_stretch(df: DataFrame, specs: list[Ewm], most: int, key: str) -> DataFrame:
    """The EWM columns of series of at most ``most`` rows, which one stretch holds: no stretch before, no reference
    for the log-correction (it begins at 0), and running sums that carry a value over NULL rows by themselves."""
    base = list(df.columns)
    part = f"PARTITION BY `{key}`, {PART} ORDER BY {BLK}, {POS} ROWS BETWEEN UNBOUNDED PRECEDING AND"
    run, before = f"({part} CURRENT ROW)", f"({part} 1 PRECEDING)"
    at = list(enumerate(specs))
    recursive = [(n, s) for n, s in at if not s.adjust]
    place = {src: n for n, src in enumerate(dict.fromkeys(s.src for _, s in recursive))}   # previous observed position
    num = lambda v: f"{float(v)!r}D"
    kept = f"IF({POS} < {most}, {POS}, raise_error('a series has more than {most} rows'))"
    if place:
        df = df.selectExpr("*", *[f"last(CASE WHEN `{src}` IS NOT NULL THEN {POS} END, true) OVER {before} AS _p{n}" for src, n in place.items()])
        even = {n: f"({POS} - _p{place[s.src]} = 1)" for n, s in recursive}
        wg = {n: f"pow({num(1.0 - s.alpha)}, CAST({POS} - _p{place[s.src]} AS DOUBLE))" for n, s in recursive}
        df = df.selectExpr("*", *[f"sum(CASE WHEN `{s.src}` IS NOT NULL AND NOT {even[n]} THEN ln({wg[n]} + {num(s.alpha)}) ELSE 0D END) OVER {run} AS _E{n}"
                                  for n, s in recursive])
    terms = []
    for n, s in at:
        grown = f"CAST({kept} AS DOUBLE) * {num(decay(s))}"
        if s.adjust:
            terms += [f"`{s.src}` * exp({grown}) AS _tn{n}", f"CASE WHEN `{s.src}` IS NOT NULL THEN exp({grown}) END AS _td{n}"]
        else:
            a = num(s.alpha)
            weight = f"CASE WHEN _p{place[s.src]} IS NULL THEN 1D WHEN {even[n]} THEN {a} ELSE {a} / ({wg[n]} + {a}) END"
            terms.append(f"{weight} * `{s.src}` * exp({grown} + _E{n}) AS _tn{n}")
    df = df.selectExpr("*", *terms)
    sums = []
    for n, s in at:
        sums += [f"sum(_tn{n}) OVER {run} AS _sn{n}", f"count(`{s.src}`) OVER {run} AS _c{n}"]
        sums += [f"sum(_td{n}) OVER {run} AS _sd{n}"] if s.adjust else []
    df = df.selectExpr("*", *sums)
    outs = []
    for n, s in at:
        last = "" if s.adjust else f"CASE WHEN `{s.src}` IS NOT NULL THEN {POS} ELSE _p{place[s.src]} END"
        y = f"_sn{n} / _sd{n}" if s.adjust else f"exp(-(CAST({last} AS DOUBLE) * {num(decay(s))} + _E{n})) * _sn{n}"
        outs.append(f"CASE WHEN _c{n} >= {max(s.min_periods, 1)} THEN {y} END AS `{s.out}`")
    return df.selectExpr(*[f"`{c}`" for c in base], *outs)


def decay(s: Ewm) -> float:
    return -math.log1p(-s.alpha) if s.alpha < 1 else 0.0


def _ewm_pass(df: DataFrame, specs: list[Ewm], B: int, key: str, seeded: bool, states: bool) -> DataFrame:
    """One pass of windows.  The expressions are SQL text: a plan of many series columns is built much faster."""
    base = list(df.columns)
    block = BLK
    if B != BLOCK_ROWS:
        block = "_ewm_blk"
        df = df.withColumn(block, stretch(B))
    # one sort order (key, part, stretch, _i) serves all windows
    part = f"PARTITION BY `{key}`, {PART}"
    run = f"({part} ORDER BY {block}, {POS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"({part} ORDER BY {block}, {POS} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    run_b = f"({part}, {block} ORDER BY {POS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    all_b = f"({part}, {block} ORDER BY {POS} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    last_b = f"({part} ORDER BY {block} RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)"
    offs = f"CAST({POS} - {block} * {B} AS DOUBLE)"     # row offset inside the stretch
    at = list(enumerate(specs))
    recursive = [(n, s) for n, s in at if not s.adjust]
    num = lambda v: f"{float(v)!r}D"

    def layer(d: DataFrame, exprs: list[str]) -> DataFrame:
        return d.selectExpr("*", *exprs) if exprs else d

    # layer 0: the observations of a part are its own rows' and its seed (with the log weight it has left)
    X = {n: f"`{s.src}`" for n, s in at}
    W0 = {n: "0D" for n, s in at}
    if OWN in base:
        for n, s in at:
            X[n] = f"CASE WHEN {OWN} THEN {X[n]} END"
            if seeded:
                sy, sw, _ = seed_columns(s)
                X[n], W0[n] = f"coalesce({sy}, {X[n]})", f"coalesce({sw}, 0D)"
        df = layer(df, [f"{X[n]} AS _x{n}" for n, _ in at])
        X = {n: f"_x{n}" for n, _ in at}

    # layer 1: previous observed position and the log weight it was left with (adjust=False only needs them)
    l1 = [f"last(CASE WHEN {X[n]} IS NOT NULL THEN {POS} END, true) OVER {before} AS _p{n}" for n, s in recursive]
    if seeded:
        l1 += [f"last(CASE WHEN {X[n]} IS NOT NULL THEN {W0[n]} END, true) OVER {before} AS _q{n}" for n, s in recursive]
    df = layer(df, l1)

    # layer 2: per-row step weight and running log-correction E (gaps and seeds only)
    l2 = []
    for n, s in recursive:
        a, g = num(s.alpha), f"({POS} - _p{n})"
        left = f"coalesce(_q{n}, 0D)" if seeded else "0D"
        wg = f"pow({num(1.0 - s.alpha)}, CAST({g} AS DOUBLE))" + (f" * exp({left})" if seeded else "")
        even = f"({g} = 1" + (f" AND {left} = 0D)" if seeded else ")")
        l2 += [f"CASE WHEN _p{n} IS NULL THEN 1D WHEN {even} THEN {a} ELSE {a} / ({wg} + {a}) END AS _b{n}",
               f"sum(CASE WHEN {X[n]} IS NOT NULL AND NOT {even} THEN ln({wg} + {a}) - {left} ELSE 0D END) OVER {run} AS _E{n}"]
    df = layer(df, l2)

    # layer 3: stretch reference for E
    df = layer(df, [f"max(_E{n}) OVER {all_b} AS _Em{n}" for n, s in recursive])

    # layer 4: scaled terms
    rel = {n: f"({offs} * {num(decay(s))}" + (")" if s.adjust else f" + (_E{n} - _Em{n}))") for n, s in at}
    l4 = []
    for n, s in at:
        if s.adjust:
            grown = f"exp({rel[n]} + {W0[n]})"
            l4 += [f"{X[n]} * {grown} AS _tn{n}", f"CASE WHEN {X[n]} IS NOT NULL THEN {grown} END AS _td{n}"]
        else:
            l4.append(f"_b{n} * {X[n]} * exp({rel[n]}) AS _tn{n}")
    df = layer(df, l4)

    # layer 5: running sums of the stretch and the previous stretch's totals
    l5 = []
    for n, s in at:
        l5 += [f"sum(_tn{n}) OVER {run_b} AS _sn{n}", f"sum(_tn{n}) OVER {last_b} AS _cn{n}"]
        if s.adjust:
            l5 += [f"sum(_td{n}) OVER {run_b} AS _sd{n}", f"sum(_td{n}) OVER {last_b} AS _cd{n}"]
        else:
            l5.append(f"max(_E{n}) OVER {last_b} AS _Ep{n}")
    df = layer(df, l5)

    # layer 6: value at observed rows, and the log of the weight it has there
    l6 = []
    for n, s in at:
        left = W0[n]
        if s.alpha >= 1:
            y, left = X[n], "0D"
        elif s.adjust:
            prev = f"({rel[n]} + {num(B * decay(s))})"
            over = lambda c, n=n, prev=prev: f"(exp(-{rel[n]}) * _s{c}{n} + exp(-{prev}) * coalesce(_c{c}{n}, 0D))"
            y, left = f"{over('n')} / {over('d')}", f"ln({over('d')})"
        else:
            prev = f"(({offs} + {num(B)}) * {num(decay(s))} + (_E{n} - _Ep{n}))"
            y = f"exp(-{rel[n]}) * _sn{n} + coalesce(exp(-{prev}) * _cn{n}, 0D)"
        l6.append(f"CASE WHEN {X[n]} IS NOT NULL THEN {y} END AS _y{n}")
        if states:
            l6.append(f"CASE WHEN {X[n]} IS NOT NULL THEN {left} END AS _w{n}")
    df = layer(df, l6)

    # layer 7: carry forward over NULL rows, apply min_periods
    outs = []
    for n, s in at:
        here = lambda c, n=n: f"CASE WHEN {X[n]} IS NOT NULL THEN {c} END"
        v = f"last(_y{n}, true) OVER {run}"
        seen = f"count({X[n]}) OVER {run}"
        if seeded:
            seen = f"coalesce(sum({here(f'coalesce({seed_columns(s)[2]}, 1)')}) OVER {run}, 0)"
        outs.append(f"CASE WHEN {seen} >= {max(s.min_periods, 1)} THEN {v} END AS `{s.out}`")
        if states:
            last_at, first_at = f"last({here(POS)}, true) OVER {run}", f"first({here(POS)}, true) OVER {run}"
            factor = "0D" if s.adjust else f"-(({last_at} - {first_at}) * {num(decay(s))} + _E{n})"
            found = (v, f"last(_w{n}, true) OVER {run} - ({POS} - {last_at}) * {num(decay(s))}", seen, first_at,
                     f"first({X[n]}, true) OVER {run}", factor)
            outs += [f"{e} AS `{c}`" for e, c in zip(found, state_columns(s))]
    return df.selectExpr(*[f"`{c}`" for c in base], *outs)
