"""Keyed upsert of bar / feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("symbol", "open_time")


def upsert(existing: DataFrame, new: DataFrame, keys=KEYS, in_place: bool = False) -> DataFrame:
    """Union of keys and of columns; per cell the new non-NULL value wins and the
    old value stays where the new one is NULL or absent.  Idempotent.

    One full outer equi-join on the keys; Catalyst/AQE choose the strategy.

    ``in_place`` is for frames that are both hash-partitioned by one of the keys: a join would deal the rows again, by
    all keys; their union keeps the partitions, so wide new rows are not shuffled (``_matched``).
    """
    keys = list(keys)
    cols = list(dict.fromkeys([c for c in existing.columns if c not in keys]
                              + [c for c in new.columns if c not in keys]))
    o = existing.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in existing.columns if c not in keys])
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys])
    j = _matched(o, n, keys) if in_place else o.join(n, keys, "full_outer")
    out = []
    for c in cols:
        parts = ([F.col(f"_n_{c}")] if c in new.columns else []) + \
                ([F.col(f"_o_{c}")] if c in existing.columns else [])
        out.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(c))
    return j.select(*keys, *out)


def _matched(o: DataFrame, n: DataFrame, keys: list[str]) -> DataFrame:
    """The full outer join of two frames as windows over their union: the old rows of a key go to each of its new
    rows, and stay by themselves where it has none.  A key with a NULL matches nothing."""
    cells = {"_old": [c for c in o.columns if c not in keys], "_new": [c for c in n.columns if c not in keys]}

    def side(df: DataFrame, name: str, number: int) -> DataFrame:
        here = {k: F.struct(F.lit(True).alias("_is"), *v) if k == name else F.lit(None) for k, v in cells.items()}
        return df.select(*keys, F.lit(number).alias("_side"), *[here[k].alias(k) for k in cells])

    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    w = Window.partitionBy(*keys).orderBy("_side")
    olds = F.collect_list(F.when(known, F.col("_old"))).over(w.rangeBetween(Window.unboundedPreceding, -1))
    news = F.count(F.when(known, F.col("_new"))).over(w.rangeBetween(1, Window.unboundedFollowing))
    rows = (side(o, "_old", 0).union(side(n, "_new", 1))
            .select(*keys, "_old", "_new", olds.alias("_olds"), news.alias("_news")).filter(F.col("_news") == 0))
    each = F.when(F.size("_olds") > 0, F.col("_olds")).otherwise(F.array("_old"))
    return (rows.select(*keys, F.explode(each).alias("_old"), "_new")
            .select(*keys, *[F.col(f"{k}.{c}").alias(c) for k, v in cells.items() for c in v]))
