"""Series in parts: the same rows as whole series, seeds across NULL runs, and no window over a series."""
import re

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL, series_df

from tickframe.functions import windows as wf
from tickframe.operators import features as feat
from tickframe.operators import parts as pt
from tickframe.operators.ewm import ewm
from tickframe.plans.catalog import finish
from tickframe.sources.fixtures import bars_d

SHORT = wf.Parts(rows=300, back=pt.ENRICH.back, fwd=pt.ENRICH.fwd)


def _rows(df):
    return sorted(map(str, finish(df, 6).collect()))


@pytest.mark.parametrize("enrich", [feat.enrich_research, feat.enrich_live_all])
def test_parts_equal_whole_series(spark, enrich):
    b = bars_d(spark, SF_SMALL)          # 1,360-1,408 bars per symbol: five parts of 300 rows
    whole = _rows(enrich(b, parts=None))
    assert _rows(enrich(b, parts=SHORT)) == whole and len(whole) > 4000
    assert _rows(enrich(b)) == whole


@pytest.mark.parametrize("adjust", [True, False])
def test_ewm_parts_match_pandas(spark, adjust):
    """Any decay; NULL runs across part edges, longer than a part, at the start and at the end of a series."""
    rng = np.random.default_rng(7)
    a = rng.normal(0, 1, 900).cumsum() + 50
    a[rng.random(900) < 0.05] = np.nan
    a[90:130] = np.nan
    a[250:520] = np.nan
    b = rng.normal(0, 1, 430).cumsum()
    b[:230] = np.nan
    b[400:] = np.nan
    df = series_df(spark, [None if np.isnan(v) else float(v) for v in a], "a").unionByName(
        series_df(spark, [None if np.isnan(v) else float(v) for v in b], "b")).unionByName(series_df(spark, [None] * 150, "c"))
    alphas = {"slow": (1e-4, 0), "mid": (1 / 14, 14), "fast": (0.9, 3), "last": (1.0, 0)}
    specs = [ewm("x", k, alpha=v, adjust=adjust, min_periods=m) for k, (v, m) in alphas.items()]
    out = pt.with_ewm_parts(df, specs, wf.Parts(rows=100, back=1)).toPandas().sort_values(["symbol", "open_time"])
    for symbol, x in (("a", a), ("b", b), ("c", np.full(150, np.nan))):
        got = out[out.symbol == symbol]
        for k, (v, m) in alphas.items():
            want = pd.Series(x).ewm(alpha=v, adjust=adjust, min_periods=m).mean()
            assert np.allclose(got[k].to_numpy(dtype=float), want, rtol=1e-9, atol=1e-9, equal_nan=True), (symbol, k)


def test_composed_maps_equal_one_pass():
    """A state before a part and the part's own map give the state after it."""
    s = ewm("x", "y", alpha=0.2, adjust=False)
    # carried value 10 with full weight; a part of 4 rows from row 100 on whose only observation is 20 at row 101
    y, w, n = pt.compose(s, (10.0, 0.0, 5), [20.0, -2 * -np.log(0.8), 1, 101, 20.0, 0.0], 100, 4)
    old = 0.8 ** 2
    assert np.isclose(y, (old * 10 + 0.2 * 20) / (old + 0.2)) and n == 6
    assert pt.compose(s, (10.0, 0.0, 5), [None, None, 0, None, None, None], 100, 4)[:1] == (10.0,)
    assert pt.compose(s, None, [3.0, -1.0, 2, 0, 1.0, 0.0], 0, 4) == (3.0, -1.0, 2)


def test_parts_follow_the_parameters(spark):
    """A window that looks past the copies raises; so do copies longer than a part."""
    x = np.random.default_rng(8).normal(0, 1, 700).cumsum() + 50
    parts = wf.Parts(rows=320, back=299)
    df = pt.parted(pt.numbered(series_df(spark, list(x))), parts)
    with wf.in_parts(parts):
        out = pt.own_rows(df.withColumn("m", wf.rolling_mean("x", 300))).orderBy("open_time").toPandas()
        with pytest.raises(ValueError):
            wf.rolling_mean("x", 301)
        with pytest.raises(ValueError):
            wf.lead("x", 1)
        with pytest.raises(ValueError):
            wf.running()
    assert np.allclose(out["m"], pd.Series(x).rolling(300).mean(), rtol=1e-9, equal_nan=True)
    with pytest.raises(ValueError):
        pt.parted(df, wf.Parts(rows=100, back=101))


def test_no_window_over_a_series(spark):
    """Windows over bars are dealt by (symbol, part) or (symbol, month); only the table of months has one per symbol."""
    plan = feat.enrich_research(bars_d(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    whole = [w for w in re.findall(r"Window \[([^\n]*)\n", plan) if not re.search(r"windowspecdefinition\(symbol#\d+, (_part|_bk)#", w)]
    assert whole and all("_cnt" in w for w in whole)
    assert "EvalPython" not in plan
