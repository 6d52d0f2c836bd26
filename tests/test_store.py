"""The stored, enriched table: updates go on from its states and equal a full recomputation."""
import datetime as dt

import numpy as np
import pytest

from tickframe.functions.windows import Parts
from tickframe.operators import features as feat
from tickframe.operators.parts import ENRICH
from tickframe.plans.catalog import finish
from tickframe.schemas import BAR_COLS
from tickframe.streaming import bars as st
from tickframe.streaming.store import BarStore

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double"


def _bars(symbol, n, seed, start=0):
    c = np.random.default_rng(seed).normal(0, 1, start + n).cumsum() + 100
    return [(symbol, T0 + dt.timedelta(hours=8 * i), float(c[i]), float(c[i] + 1), float(c[i] - 1), float(c[i] + 0.5), 10.0 + i % 7)
            for i in range(start, start + n)]


def _rows(df):
    return sorted(map(str, finish(df.select("symbol", "open_time", *BAR_COLS, "rsi_14", "macd_signal", "adx", "sma_200", "dist_sma_mom"), 6).collect()))


def test_updates_equal_full_recomputation(spark, tmp_path):
    """Appended bars, a corrected cell, a new symbol and a back-fill, with several parts a series."""
    store = BarStore(spark, str(tmp_path / "store"), period="month", slices=3, parts=Parts(rows=220, back=ENRICH.back, fwd=ENRICH.fwd))
    a, b, c = _bars("A", 400, 1), _bars("B", 300, 2), _bars("C", 90, 3)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    store.update(frame(a[30:320] + b[:250]))
    first = {(e.period, e.slice): e.commit for e in store.entries()}
    fixed = [(*a[330][:5], a[330][5] + 2, None)]     # a new close; the NULL volume keeps the stored one
    store.update(frame(a[320:]))
    second = {(e.period, e.slice): e.commit for e in store.entries()}
    kept = [k for k in first if first[k] == second.get(k)]
    assert kept and max(k[0] for k in kept) < dt.date(2024, 5, 1)       # appended bars rewrite the last months of one slice
    store.update(frame(fixed + b[250:] + c))
    store.update(frame(a[:30]))                       # before everything that is stored of A
    a[330] = (*a[330][:5], fixed[0][5], a[330][6])
    want = feat.enrich_live_all(frame(a + b + c), min_bars=None, parts=None)
    assert _rows(store.read()) == _rows(want)
    assert store.version() == 4 and sum(e.n_rows for e in store.entries()) == 790


def test_a_failed_or_repeated_run_changes_nothing(spark, tmp_path):
    store = BarStore(spark, str(tmp_path / "store"), slices=2)
    rows = spark.createDataFrame(_bars("A", 60, 5), SCHEMA)
    assert store.update(rows, "s", 3) == 1
    assert store.update(rows.limit(1), "s", 3) == 1 and store.last_batch("s") == 3 and store.last_batch("t") == -1
    held = _rows(store.read())
    rows.limit(5).write.parquet(f"{store.path}/data/commit=orphan/period=2024-01-01/slice=0")   # files of a run that died
    assert _rows(store.read()) == held
    with pytest.raises(RuntimeError):
        store._publish(1, store.entries(), None, None)      # another writer was first
    assert store.update(rows.limit(0)) == 1
    assert _rows(BarStore(spark, str(tmp_path / "none")).read()) == []


def _land(spark, landing, bars):
    payload = lambda t, c: (f'[[{int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)},"{c}","{c + 1}","{c - 1}","{c}","5",'  # noqa: E731
                            f'{int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) + 1},"0",1,"0","0","0"]]')
    spark.createDataFrame([(s, payload(t, c)) for s, t, c in bars], "symbol string, payload string").coalesce(1).write.mode("append").json(landing)


def test_keyed_dedup_keeps_first_arrivals_however_late(spark, tmp_path):
    """The state holds two days; a bar 100 days late is kept once, a re-sent one of 100 days ago is dropped."""
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    steps = [[("A", day(0), 10.0), ("B", day(0), 20.0)], [("A", day(1), 11.0), ("A", day(0), 99.0)], [("A", day(150), 12.0), ("B", day(1), 21.0)],
             [("A", day(50), 13.0), ("A", day(0), 98.0), ("A", day(50), 97.0)], [("A", day(50), 96.0), ("A", day(149), 14.0), ("B", day(1), 95.0)]]
    for k, bars in enumerate(steps):
        _land(spark, landing, bars)
        got = st.stream_dedup(spark, landing, out, keep_days=2)
    found = sorted((r.symbol, r.open_time, r.close) for r in got.collect())
    assert found == [("A", day(0), 10.0), ("A", day(1), 11.0), ("A", day(50), 13.0), ("A", day(149), 14.0), ("A", day(150), 12.0),
                     ("B", day(0), 20.0), ("B", day(1), 21.0)]
    states = spark.read.format("statestore").load(st.default_checkpoint(spark, "dedup", out))
    assert max(len(r.seen) for r in states.selectExpr("value.groupState.seen AS seen").collect()) <= 2
