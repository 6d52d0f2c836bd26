"""File layouts, header scans, order statistics, counters, wallets and compiled ensembles."""
import datetime as dt

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tickframe.operators import dataset as ds
from tickframe.operators import features as feat
from tickframe.operators import ml
from tickframe.operators import positions as po
from tickframe.operators import signals as sg
from tickframe.operators import tree_scorer as ts
from tickframe.operators import wallets as wl
from tickframe.plans.stub import stub_probability
from tickframe.schemas import BAR_COLS, MODEL_FEATURES
from tickframe.sources import files
from tickframe.sources.fixtures import bars_d, bars_s

T0 = dt.datetime(2024, 1, 1)


def _bars(spark, n, symbol="A"):
    return spark.range(n).select(F.lit(symbol).alias("symbol"), (F.lit(T0.isoformat(sep=" ")).cast("timestamp_ntz")
                                 + F.make_interval(hours=F.col("id").cast("int"))).alias("open_time"),
                                 *[(F.col("id") + k).cast("double").alias(c) for k, c in enumerate(BAR_COLS)])


def test_hot_symbol_is_written_by_many_tasks(spark, tmp_path):
    b = _bars(spark, 20_000).union(_bars(spark, 50, "B")).orderBy(F.rand(1))
    path = str(tmp_path / "bars")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_bars(b, path, by_symbol=False, file_rows=2_000)
        files.write_bars(b, path + "-s")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2_000
    got = files.in_file_order(spark, path).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(20_050)) and got == sorted(got, key=lambda r: (r.symbol, r.open_time))
    hot = spark.read.parquet(path + "-s").filter("symbol = 'A'").select(F.input_file_name()).distinct().count()
    assert hot > 1 and files.read_bars(spark, path + "-s").count() == 20_050


def test_file_order_is_checked(spark, tmp_path):
    _bars(spark, 100).orderBy(F.desc("open_time")).coalesce(1).write.parquet(str(tmp_path / "back"))
    with pytest.raises(Exception, match="out of order"):
        files.in_file_order(spark, str(tmp_path / "back")).collect()
    _bars(spark, 100).coalesce(1).write.parquet(str(tmp_path / "twice"))
    _bars(spark, 100).coalesce(1).write.mode("append").parquet(str(tmp_path / "twice"))
    with pytest.raises(Exception, match="out of order"):
        files.in_file_order(spark, str(tmp_path / "twice")).collect()


def test_header_scan(spark, tmp_path):
    put = lambda name, text: (tmp_path / name).write_text(text)
    put("analise_v2_AA_4h.csv", "open_time,close,target\n2024-01-01T00:00:00,1.5,1\n")
    put("BB_4h.csv", "open_time,target,volume,close\n2024-01-01 04:00:00,0,7,2.5\n2024-01-01 08:00:00,,8,3.5\n")
    put("CC_4h.csv", "close,open_time\n4.5,2024-01-01 00:00:00\n")
    put("DD_4h.csv", "open_time,close\n")
    df = files.scan_by_header(spark, str(tmp_path / "*_4h.csv"), ["close", "target", "adx"])
    assert df.columns == ["symbol", "open_time", "close", "target", "adx"]
    assert sorted((r.symbol, r.close, r.target, r.adx) for r in df.collect()) == [
        ("AA", 1.5, 1.0, None), ("BB", 2.5, 0.0, None), ("BB", 3.5, None, None), ("CC", 4.5, None, None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "volume" not in "".join(part.split("\n")[0] for part in plan.split("ReadSchema:")[1:])       # pruned scans
    put("EE_4h.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError):
        files.scan_by_header(spark, str(tmp_path / "*_4h.csv"), ["close"])


@pytest.mark.parametrize("exact,ranks", [(6, (2, 41, 47)), (50_000, (17, 48))])
def test_order_statistic(spark, exact, ranks):
    """Ranks found by sketches down to a few rows: ties in time, keys that share their first bytes, a skewed range."""
    rng = np.random.default_rng(3)
    rows = [(T0 + dt.timedelta(seconds=int(s)), f"{'common-prefix-' * (k % 3)}{k}") for k, s in enumerate(rng.geometric(0.1, 40) ** 3)]
    rows += [(T0 + dt.timedelta(days=5), k) for k in ("", "a", "a\0", "ab", "abcdefgh", "abcdefg", "ä", "z")]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string").coalesce(1).cache()
    want = sorted(rows, key=lambda r: (r[0], r[1].encode()))
    for rank in ranks:
        assert tuple(ds.order_statistic(df, "t", "k", rank, exact)) == want[rank - 1]
    assert ds.order_statistic(df, "t", "k", 0) is None and ds.order_statistic(df, "t", "k", 49) is None
    df.unpersist()


def test_split_has_no_window(spark):
    df = feat.enrich_live_all(bars_d(spark, SF_SMALL), min_bars=None, parts=None).select("symbol", "open_time", "close")
    base = df._jdf.queryExecution().optimizedPlan().toString().count("Window")
    split = ds.chrono_split(df)
    assert split._jdf.queryExecution().optimizedPlan().toString().count("Window") == base
    n = df.count()
    assert split.agg(F.sum("is_train")).first()[0] == int(n * 0.8)
    assert ds.chrono_split(df.limit(0)).count() == 0


def test_lookup_reads_one_bucket(spark, tmp_path):
    files.write_bucketed(bars_s(spark, SF_SMALL), "bars_lookup_test", str(tmp_path / "b"), 8)
    df = sg.lookup(spark.table("bars_lookup_test"), "s3", stub_probability)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 8" in plan
    assert df.count() == 1
    spark.sql("DROP TABLE bars_lookup_test")


def test_wallets_are_written_only_if_changed(spark, tmp_path):
    path = str(tmp_path / "w")
    rows = [(1, 10.0, "A", 1.0, 2.0, 3.0), (1, 10.0, "B", 1.5, 2.0, 3.0), (2, 5.0, None, None, None, None)]
    df = spark.createDataFrame(rows, wl.SCHEMA)
    assert wl.save_wallets(df, path) == 1
    assert wl.save_wallets(df.orderBy(F.desc("symbol")), path) == 1
    assert wl.save_wallets(spark.createDataFrame([(2, 6.0, None, None, None, None)], wl.SCHEMA), path) == 2
    got = {(r.wallet_id, r.symbol): (r.cash_usdt, r.written) for r in wl.read_wallets(spark, path).collect()}
    assert got == {(1, "A"): (10.0, 1), (1, "B"): (10.0, 1), (2, None): (6.0, 2)}
    assert wl.save_wallets(df.limit(0), path) == 2
    parsed = po.wallet_positions(wl.wallet_documents(wl.read_wallets(spark, path)), keep=("wallet_id",)).collect()
    assert sorted((r.wallet_id, r.cash_usdt, r.symbol or "") for r in parsed) == [(1, 10.0, "A"), (1, 10.0, "B"), (2, 6.0, "")]


def test_allocation_takes_the_first_in_list_order(spark):
    cand = spark.createDataFrame([(f"S{k}", 4090 + k, 0.9, 2.0) for k in range(12)], "symbol string, pos int, prob_buy double, buy_price double")
    for cash in (45.0, spark.createDataFrame([(45.0,)], "cash_usdt double")):
        got = po.buy_allocation(cand, cash).collect()
        assert sorted(r.symbol for r in got) == ["S0", "S1", "S2", "S3"] and {r.value for r in got} == {11.25}
        assert po.wallet_cash(po.buy_allocation(cand, cash), cash).first()[0] == 0.0
    assert po.buy_allocation(cand, 9.0).count() == 0 and po.buy_allocation(cand.limit(0), 90.0).count() == 0
    assert po.wallet_cash(po.buy_allocation(cand, 9.0), 9.0).first()[0] == 9.0


def test_update_counts_in_the_job_that_writes(spark, tmp_path):
    recent = _bars(spark, 4).union(_bars(spark, 3, "B")).union(_bars(spark, 9, "Z"))
    got = ds.update_counted(spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "symbol string"), _bars(spark, 300), recent,
                            lambda rows: rows.write.parquet(str(tmp_path / "w")))
    assert got == {"total": 3, "updated": 2, "skipped": 1, "new": 1, "too_few": 1}
    assert spark.read.parquet(str(tmp_path / "w")).count() == 7


def test_compiled_ensemble_equals_the_model(spark):
    """Column, SQL text and Spark ML agree; rows with NULL features are skipped by both."""
    df = feat.enrich_research(bars_d(spark, SF_SMALL), parts=None).select("symbol", "open_time", "target", *MODEL_FEATURES).cache()
    model = ml.train_gbt(ds.drop_incomplete(df), MODEL_FEATURES, "target", maxIter=5)
    e = ts.Ensemble.from_dict(ts.from_model(model, MODEL_FEATURES).to_dict())
    a = {(r.symbol, r.open_time): r.prob_buy for r in sg.score(df, model).collect()}
    b = {(r.symbol, r.open_time): r.prob_buy for r in sg.score(df, ts.probability(e)).collect()}
    pdf = df.toPandas()
    found = duckdb.sql(f"SELECT symbol, open_time, {ts.probability_sql(e)} AS p FROM pdf").fetchall()
    c = {(s, t): p for s, t, p in found if p is not None and not np.isnan(p)}
    complete = pdf.dropna(subset=MODEL_FEATURES)
    assert len(a) == len(b) == len(complete) < len(pdf)
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)
    assert all(abs(c[k] - a[k]) < 1e-12 for k in a)
    none = ts.Ensemble(["close"], [], [])
    assert {r.prob_buy for r in sg.score(df, ts.probability(none)).collect()} == {0.5}
    df.unpersist()
