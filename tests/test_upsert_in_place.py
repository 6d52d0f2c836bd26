"""The upsert of frames that are dealt by symbol: the join's rows, without dealing them again."""
import datetime as dt
import re
from collections import Counter

import __spark_entry__ as E
from tickframe.operators.upsert import upsert
from tickframe.plans.data_queries import upsert_inputs
from tickframe.sources.fixtures import bars_s


def _exchanges(df):
    """The exchanges that ran, without those that were read again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [x for x in plan.splitlines() if re.search(r"[ -]Exchange ", x) and "ReusedExchange" not in x]


def _day(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_in_place_equals_join(spark):
    """Repeated keys, keys with NULLs, NULL cells and keys of one side only."""
    old = [(s, _day(n), float(n or 0) + v, None if n == 3 else v) for s in ("a", "b", None) for n in (None, 1, 2, 3) for v in (0.25, 0.5)]
    new = [(s, _day(n), None if n == 2 else v, v * 10) for s in ("b", "c", None) for n in (None, 2, 3, 4) for v in (0.125, 0.75, 1.0)]
    o = spark.createDataFrame(old, "symbol string, open_time timestamp_ntz, close double, volume double").repartition("symbol")
    n = spark.createDataFrame(new, "symbol string, open_time timestamp_ntz, close double, rsi double").repartition("symbol")
    joined, placed = upsert(o, n), upsert(o, n, in_place=True)
    assert placed.columns == joined.columns and placed.dtypes == joined.dtypes
    assert Counter(placed.collect()) == Counter(joined.collect())
    assert len(_exchanges(placed)) == 2                              # those of the two repartitions


def _sf(spark, tmp_path):
    """Line items of two suppliers, 650 and 230 days on both sides of 1998, some days with several rows."""
    rows = [(i, i % 7, s, r, float(1 + (i * 13 + r) % 9), float(100 + (i * i * 31 + s + 17 * r) % 900), dt.datetime(1996, 9, 1) + dt.timedelta(days=i))
            for s, days in ((1, 650), (2, 230)) for i in range(days) for r in range(1 + i % 3)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_upsert_bars_deals_rows_twice(spark, tmp_path):
    """One exchange deals the line items by bar and one the bars by symbol; old rows and update read both, and neither
    the old bars nor the rows with their features are dealt again."""
    sf = _sf(spark, tmp_path)
    df = E.queries()["upsert_bars"](spark, sf)
    moved = _exchanges(df)
    assert len(moved) == 2, moved
    assert not any("open_time" in x for x in moved)                  # not by (symbol, open_time) after the features
    assert Counter(bars_s(spark, sf, combine=False).collect()) == Counter(bars_s(spark, sf).collect())
    old, new = upsert_inputs(spark, sf)
    rows = upsert(old, new, in_place=True)
    assert Counter(rows.collect()) == Counter(upsert(old, new).collect())
    found = {(r.symbol, r.open_time): r for r in rows.collect()}
    assert len(found) == 650 + 230
    assert found["S1", dt.datetime(1996, 9, 1)].rsi_14 is None       # before the last 600: the old bar
    assert found["S1", dt.datetime(1998, 1, 1)].rsi_14 is not None
