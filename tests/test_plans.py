"""Plan shape: one shuffle on the series key for a whole enrichment, no Python in batch."""
import re

from conftest import SF_SMALL

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_one_series_shuffle(spark):
    """The rows are dealt by (symbol, part) once; the branch of the maps reads the same exchange."""
    df = E.queries()["enrich_research"](spark, SF_SMALL)
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, _part#\d+L?", plan)) == 1
    assert len(re.findall(r"Sort \[symbol[^\]]*_part", plan)) <= 2      # all windows of a part share one order
    assert "EvalPython" not in plan


def test_no_python_in_batch_feature_plans(spark):
    for name in ["enrich_live", "top_signals", "upsert_bars", "chrono_split"]:
        assert "EvalPython" not in _plan(E.queries()[name](spark, SF_SMALL)), name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["symbol", "open_time"]
