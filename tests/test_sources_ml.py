import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickframe.schemas import BARS, MODEL_FEATURES
from tickframe.sources import files


def test_read_or_empty(spark, tmp_path):
    df = files.read_or_empty(spark, str(tmp_path / "absent"), BARS)
    assert df.count() == 0 and df.schema == BARS


def test_empty_glob_raises(spark, tmp_path):
    with pytest.raises(Exception):
        files.scan_bars_csv(spark, str(tmp_path / "nothing" / "*_4h.csv")).count()


def test_versioned_runs(spark, tmp_path):
    base = str(tmp_path / "runs")
    nxt = files.next_run_version(files.run_versions(spark, base), prefix="run_version=").first()[0]
    assert nxt == 1
    df = spark.range(3)
    files.write_versioned(df, base, nxt)
    files.write_versioned(df, base, 2)
    assert files.next_run_version(files.run_versions(spark, base), prefix="run_version=").first()[0] == 3
    assert spark.read.parquet(f"{base}/run_version=2").count() == 3


def test_artifacts_round_trip(spark, tmp_path):
    from tickframe.operators import dataset as ds
    from tickframe.operators import features as feat
    from tickframe.operators import ml
    from tickframe.operators import signals as sg
    from tickframe.sources.fixtures import bars_d
    df = ds.drop_incomplete(feat.enrich_research(bars_d(spark, SF_SMALL)))
    model = ml.train_gbt(df, MODEL_FEATURES, "target", maxIter=3)
    ml.save_artifacts(spark, model, str(tmp_path / "art"))
    m2, cols, thr = ml.load_artifacts(spark, str(tmp_path / "art"))
    assert cols == MODEL_FEATURES and thr == 0.49
    a = sg.score(df, model).select("prob_buy").collect()
    b = sg.score(df, m2).select("prob_buy").collect()
    assert a == b and all(0 <= r.prob_buy <= 1 for r in a)
    os.makedirs(tmp_path / "bad", exist_ok=True)
    with pytest.raises(Exception):
        ml.load_artifacts(spark, str(tmp_path / "bad"))


def test_registered_gbt_trains_the_reference_rounds(spark, monkeypatch):
    from tickframe.operators import ml
    from tickframe.plans import stream_queries
    seen, train = {}, ml.train_gbt

    def short(*args, **overrides):
        seen.update({**ml.REFERENCE_GBT, **overrides})
        return train(*args, **{**overrides, "maxIter": 1})

    monkeypatch.setattr(ml, "train_gbt", short)
    assert stream_queries.q_train_gbt(spark, SF_SMALL).columns[-1] == "pred"
    assert seen == ml.REFERENCE_GBT
