"""Series of a bounded number of rows: one stretch of EWMs, long means from short sums, one pass of the bars."""
import pytest
from pyspark.sql import functions as F

from conftest import series_df

from tickframe.functions.windows import positioned, rolling_mean, series_upto, with_rolling_mean
from tickframe.operators.ewm import ewm, with_ewm

GAPS = [None, None] + [float(i * 37 % 101) if i % 7 and i % 11 else None for i in range(300)]


@pytest.mark.parametrize("spec", [dict(span=12, adjust=False), dict(span=14, adjust=False, min_periods=5),
                                  dict(com=13, adjust=True, min_periods=14), dict(alpha=1.0, adjust=False)])
def test_one_stretch_agrees_with_pandas(spark, spec):
    import pandas as pd
    with series_upto(len(GAPS)):
        got = [r.y for r in with_ewm(series_df(spark, GAPS), [ewm("x", "y", **spec)]).orderBy("open_time").collect()]
    want = pd.Series(GAPS, dtype=float).ewm(**spec, min_periods=0).mean() if "min_periods" not in spec else pd.Series(GAPS, dtype=float).ewm(**spec).mean()
    for a, b in zip(got, want):
        assert (a is None and b != b) or a == pytest.approx(b, rel=1e-10)


def test_a_longer_series_than_told_is_an_error(spark):
    with series_upto(100), pytest.raises(Exception, match="more than 100 rows"):
        with_ewm(series_df(spark, [1.0] * 101), [ewm("x", "y", span=12, adjust=False)]).collect()


def test_one_stretch_needs_half_the_windows(spark):
    def windows(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Window [")
    specs = [ewm("x", "y", span=12, adjust=False), ewm("x", "z", com=13, adjust=True)]
    df = series_df(spark, GAPS)
    with series_upto(len(GAPS)):
        short = windows(with_ewm(df, specs))
    assert 2 * (short - 1) <= windows(with_ewm(df, specs)) - 1     # one numbers the rows


def test_long_mean_from_short_sums(spark):
    values = [float(i * 61 % 997) if i != 300 else None for i in range(620)]
    df = positioned(series_df(spark, values))
    rows = with_rolling_mean(df.withColumn("plain", rolling_mean("x", 200)), "x", 200, "m").collect()
    assert sum(r.plain is not None for r in rows) == 101 + 120
    for r in rows:
        assert (r.m is None) == (r.plain is None) and (r.m is None or r.m == pytest.approx(r.plain, rel=1e-12))


def test_a_cycle_aggregates_the_bars_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from tickframe.plans import position_queries as pq
    read = []
    bars = pq.bars_s
    monkeypatch.setattr(pq, "bars_s", lambda *a: read.append(1) or bars(*a))
    assert pq.q_wallet_after_cycle(spark, SF_SMALL).agg(F.count("*")).first()[0] > 0
    assert len(read) == 1
