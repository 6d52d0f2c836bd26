"""Text builders for the DuckDB oracle queries.

The oracle restates each operator from its definition (row-by-row recursion
for EWMs, plain window frames with count guards for rolling statistics), so it
shares no trick with the Spark side.
"""

from __future__ import annotations

W = "PARTITION BY symbol ORDER BY open_time"


def frame(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, x: str, n: int) -> str:
    f = frame(n)
    return f"(CASE WHEN count({x}) OVER {f} = {n} THEN {agg}({x}) OVER {f} END)"


def lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER ({W})"


def nn(x: str) -> str:
    """NaN -> NULL."""
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def div(a: str, b: str) -> str:
    """IEEE division with NULL for 0/0 and NaN."""
    return (f"(CASE WHEN ({b}) <> 0 THEN {nn(f'({a}) / ({b})')} "
            f"WHEN ({b}) = 0 AND ({a}) > 0 THEN 'Infinity'::DOUBLE "
            f"WHEN ({b}) = 0 AND ({a}) < 0 THEN '-Infinity'::DOUBLE END)")


def noinf(x: str) -> str:
    return f"(CASE WHEN abs({x}) = 'Infinity'::DOUBLE THEN NULL ELSE {x} END)"


def flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER)"


def ewm_recursive(name: str, src: str, specs: list[tuple[str, str, float, bool, int]],
                  keep: list[str] = ()) -> str:
    """Recursive CTE ``name(symbol, i, <keep>, <outs>)`` stepping i -> i+1.

    ``src`` must have columns ``symbol, i`` (0-based, gap free per symbol) and the
    inputs.  Each spec is ``(input, out, alpha, adjust, min_periods)``; the step
    is the textbook weighted-average update (weights decay over NULL rows).
    """
    init, step, outs = [], [], []
    for x, out, a, adjust, mp in specs:
        w = 1.0 - a
        nw = "1.0::DOUBLE" if adjust else f"{a!r}::DOUBLE"
        init += [f"CAST({x} AS DOUBLE) AS {out}_y", f"CASE WHEN {x} IS NULL THEN NULL ELSE 1.0::DOUBLE END AS {out}_w",
                 f"CAST({x} IS NOT NULL AS INTEGER) AS {out}_n"]
        xd = f"s.{x}"
        dec = f"(r.{out}_w * {w!r})"
        step += [
            f"CASE WHEN r.{out}_y IS NULL THEN {xd} WHEN {xd} IS NULL THEN r.{out}_y "
            f"ELSE ({dec} * r.{out}_y + {nw} * {xd}) / ({dec} + {nw}) END AS {out}_y",
            f"CASE WHEN r.{out}_y IS NULL THEN (CASE WHEN {xd} IS NULL THEN NULL ELSE 1.0::DOUBLE END) "
            f"WHEN {xd} IS NULL THEN {dec} ELSE {(dec + ' + 1.0::DOUBLE') if adjust else '1.0::DOUBLE'} END AS {out}_w",
            f"r.{out}_n + CAST({xd} IS NOT NULL AS INTEGER) AS {out}_n",
        ]
        outs.append(f"CASE WHEN {out}_n >= {max(mp, 1)} THEN {out}_y END AS {out}")
    kp = "".join(f", {k}" for k in keep)
    skp = "".join(f", s.{k}" for k in keep)
    return (f"{name}_r AS (SELECT symbol, i{kp}, {', '.join(init)} FROM {src} WHERE i = 0 "
            f"UNION ALL SELECT s.symbol, s.i{skp}, {', '.join(step)} FROM {name}_r r "
            f"JOIN {src} s ON s.symbol = r.symbol AND s.i = r.i + 1), "
            f"{name} AS (SELECT symbol, i{kp}, {', '.join(outs)} FROM {name}_r)")


def rnd(x: str, digits: int) -> str:
    """Same IEEE steps as the Spark side: floor(x * 10^d + 0.5) / 10^d."""
    scale = float(10 ** digits)
    v = nn(x)
    return (f"(CASE WHEN abs({v}) < 1e14 THEN CAST(floor({v} * {scale!r} + 0.5) AS DOUBLE) / {scale!r} "
            f"ELSE {v} END)")


def rounded_select(cols: list[tuple[str, str]], digits: int, src: str) -> str:
    """Final projection: doubles NaN -> NULL and rounded; ints and others as is.
    ``cols`` are (name, kind) with kind in double/int/other."""
    parts = []
    for name, kind in cols:
        if kind == "double":
            parts.append(f"{rnd(name, digits)} AS {name}")
        elif kind == "int":
            parts.append(f"CAST({name} AS INTEGER) AS {name}")
        else:
            parts.append(name)
    return f"SELECT {', '.join(parts)} FROM {src}"
