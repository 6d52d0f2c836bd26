import numpy as np
import pandas as pd
import pytest

from conftest import bars_df, series_df
from tickframe.functions import windows as wf
from tickframe.operators import features as feat
from tickframe.operators import indicators as ind
from tickframe.operators.ewm import ewm, with_ewm


def _col(df, name):
    return [r[name] for r in df.orderBy("open_time").collect()]


def _close(a, b, tol=1e-9):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if y is None or (isinstance(y, float) and np.isnan(y)):
            assert x is None
        else:
            assert x is not None and abs(x - y) <= tol * max(1, abs(y)), (a, b)


def test_ewm_literals(spark):
    df = series_df(spark, [None, 1, None, None, 3, 4])
    _close(_col(with_ewm(df, [ewm("x", "y", span=3, adjust=False)]), "y"), [None, 1, 1, 1, 2.6, 3.3])
    _close(_col(with_ewm(df, [ewm("x", "y", alpha=0.5, adjust=False, min_periods=2)]), "y"),
           [None, None, None, None, 2.6, 3.3])
    df = series_df(spark, [0, 1, 2, 3])
    _close(_col(with_ewm(df, [ewm("x", "y", com=13, adjust=True, min_periods=2)]), "y"),
           [None, 0.518519, 1.049360, 1.592491], tol=1e-6)


@pytest.mark.parametrize("n,pnull", [(2000, 0.0), (1500, 0.05), (40, 0.3)])
def test_ewm_matches_pandas(spark, n, pnull):
    rng = np.random.default_rng(n)
    x = rng.normal(0, 1, n).cumsum() + 100
    x[rng.random(n) < pnull] = np.nan
    df = series_df(spark, [None if np.isnan(v) else v for v in x])
    specs = [ewm("x", "a", com=13, adjust=True, min_periods=14), ewm("x", "b", span=12, adjust=False),
             ewm("x", "c", alpha=1 / 14, adjust=False, min_periods=14), ewm("x", "d", span=9, adjust=True)]
    out = with_ewm(df, specs).orderBy("open_time").toPandas()
    s = pd.Series(x)
    ref = {"a": s.ewm(com=13, adjust=True, min_periods=14).mean(), "b": s.ewm(span=12, adjust=False).mean(),
           "c": s.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean(), "d": s.ewm(span=9, adjust=True).mean()}
    for k, r in ref.items():
        got = out[k].to_numpy(dtype=float)
        assert (np.isnan(got) == np.isnan(r.to_numpy())).all()
        m = ~np.isnan(got)
        assert np.allclose(got[m], r.to_numpy()[m], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("pnull", [0.0, 0.1])
def test_ewm_any_alpha(spark, pnull):
    """Decays slower and faster than the default block serves, in one call."""
    rng = np.random.default_rng(11)
    x = rng.normal(0, 1, 4000).cumsum() + 100
    x[rng.random(4000) < pnull] = np.nan
    df = series_df(spark, [None if np.isnan(v) else v for v in x])
    s = pd.Series(x)
    for adjust in (True, False):
        alphas = {"a": 2 / 51, "b": 1 / 400, "c": 1 / 14, "d": 0.9, "e": 0.9999, "f": 1.0}
        out = with_ewm(df, [ewm("x", k, alpha=a, adjust=adjust) for k, a in alphas.items()]).orderBy("open_time").toPandas()
        for k, a in alphas.items():
            assert np.allclose(out[k].to_numpy(dtype=float), s.ewm(alpha=a, adjust=adjust).mean(), rtol=1e-9, equal_nan=True), (k, adjust)


def test_indicator_periods(spark):
    """Periods other than the default ones equal pandas."""
    rng = np.random.default_rng(12)
    c = rng.normal(0, 1, 1500).cumsum() + 200
    df = bars_df(spark, [(v, v + 1, v - 1, v, 10) for v in c])
    out = ind.macd(ind.rsi(df, 21, out="rsi"), 12, 50, 9)
    out = wf.positioned(ind.adx(out, 28)).withColumn("mean_300", wf.rolling_mean("close", 300)).orderBy("open_time").toPandas()
    s = pd.Series(c)
    d = s.diff()
    gain, loss = d.clip(lower=0).fillna(0), (-d).clip(lower=0).fillna(0)
    rs = gain.ewm(com=20, min_periods=21).mean() / loss.ewm(com=20, min_periods=21).mean()
    macd = s.ewm(span=12, adjust=False).mean() - s.ewm(span=50, adjust=False).mean()
    tr = pd.concat([pd.Series(2.0, s.index), (s + 1 - s.shift()).abs(), (s - 1 - s.shift()).abs()], axis=1).max(axis=1)
    want = {"rsi": 100 - 100 / (1 + rs), "macd_signal": macd.ewm(span=9, adjust=False).mean(),
            "atr": tr.ewm(alpha=1 / 28, adjust=False, min_periods=28).mean(), "mean_300": s.rolling(300).mean()}
    for k, w in want.items():
        assert np.allclose(out[k].to_numpy(dtype=float), w, rtol=1e-8, atol=1e-8, equal_nan=True), k


def test_rolling_sum_full_window(spark):
    df = wf.positioned(series_df(spark, [1, 2, None, 4, 5]))
    _close(_col(df.withColumn("y", wf.rolling_sum("x", 2)), "y"), [None, 3, None, None, 9])


def test_forward_label_rising_highs(spark):
    rows = [(i, i, i, i, 1) for i in range(10)]
    df = feat.forward_max_label(bars_df(spark, rows), pct=0.0, horizon=5)
    # look-ahead defined only on row 4; first 4 and last 5 rows are 0
    assert _col(df, "target") == [0, 0, 0, 0, 1, 0, 0, 0, 0, 0]


def test_rsi_constant_and_rising(spark):
    flat = ind.rsi(bars_df(spark, [(5, 5, 5, 5, 1)] * 30))
    assert all(v is None for v in _col(flat, "rsi_14"))
    up = ind.rsi(bars_df(spark, [(i, i, i, i, 1) for i in range(30)]))
    vals = _col(up, "rsi_14")
    assert vals[:13] == [None] * 13 and all(v == 100.0 for v in vals[13:])


def test_bollinger_constant(spark):
    df = ind.bollinger(bars_df(spark, [(5, 5, 5, 5, 1)] * 25))
    r = df.orderBy("open_time").collect()[-1]
    assert r["bb_mid"] == r["bb_upper"] == r["bb_lower"] == 5.0


def test_cmf_flat_bar(spark):
    rows = [(1, 2, 1, 1.5, 10)] * 25
    rows[22] = (3, 3, 3, 3, 10)            # flat bar
    fill = _col(ind.cmf(bars_df(spark, rows)), "cmf_20")
    nofill = _col(ind.cmf(bars_df(spark, rows), fill_flat=False), "cmf_20")
    assert fill[19] == 0.0 and fill[24] is not None
    assert nofill[19] == 0.0 and nofill[22] is None and nofill[24] is None


def test_min_history_boundary(spark):
    a = bars_df(spark, [(1, 1, 1, 1, 1)] * 249, "a").unionByName(bars_df(spark, [(1, 1, 1, 1, 1)] * 250, "b"))
    kept = feat.min_history(a.repartition("symbol"), 250).select("symbol").distinct().collect()
    assert [r.symbol for r in kept] == ["b"]


def test_rsi_bounds_and_bands_order(spark):
    from conftest import SF_SMALL
    from tickframe.sources.fixtures import bars_d
    df = feat.enrich_research(bars_d(spark, SF_SMALL))
    bad = df.filter("rsi_14 < 0 OR rsi_14 > 100 OR bb_lower > bb_mid + 1e-9 OR bb_mid > bb_upper + 1e-9").count()
    assert bad == 0
