"""Registry of named queries: the Spark plan and its DuckDB oracle side by side.

Each entry maps a name to ``(build(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
Output doubles are rounded (4 decimals on lineitem bars, whose prices reach
1e5; 6 on event bars) identically on both sides; ints are cast to int.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.functions.expr import rnd
from tickframe.schemas import INT_FEATURES
from tickframe.sources.fixtures import FIXTURES

REGISTRY: dict[str, tuple[Callable, str | None]] = {}
DIGITS = {"bars_d": 4, "bars_s": 4, "bars_h": 6}
KEYS = ("symbol", "open_time")


def register(name: str, sql: str | None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def kind(name: str) -> str:
    if name in INT_FEATURES or name in INT_COLS:
        return "int"
    if name in OTHER_COLS:
        return "other"
    return "double"


INT_COLS = {"volume_spike_flag", "n_bars", "trade_no", "pos", "rank", "entry", "exit",
            "signal", "run_id", "is_train", "k"}
OTHER_COLS = set(KEYS) | {"entry_time", "exit_time", "exit_reason", "dialect", "signal_label",
                          "class", "trend", "token", "run_version", "file_name", "name"}


def finish(df: DataFrame, digits: int, cols: list[str] | None = None) -> DataFrame:
    """Project ``cols`` (default all) with doubles rounded and NaN as NULL."""
    cols = cols or df.columns
    types = dict(df.dtypes)
    out = []
    for c in cols:
        t = types[c]
        if t == "double":
            out.append(rnd(c, digits).alias(c))
        elif t in ("int", "smallint", "tinyint") or (t == "bigint" and kind(c) == "int"):
            out.append(F.col(c).cast("int").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def finish_sql(with_body: str, rel: str, cols: list[str], digits: int, kinds: dict | None = None,
               recursive: bool = True, where: str = "") -> str:
    from tickframe.plans.sqlkit import rounded_select
    kinds = kinds or {}
    spec = [(c, kinds.get(c, kind(c))) for c in cols]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + with_body + " " + rounded_select(spec, digits, rel) + (f" WHERE {where}" if where else "")


def fixture(name: str):
    return FIXTURES[name]
