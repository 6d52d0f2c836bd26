import datetime as dt

from pyspark.sql import functions as F

from tickframe.operators import dataset as ds


def test_dedup_keeps_first_page(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "symbol string, open_time timestamp_ntz, close double"
    p0 = spark.createDataFrame([("s", t, 1.0)], schema)
    p1 = spark.createDataFrame([("s", t, 2.0), ("s", t + dt.timedelta(hours=1), 3.0)], schema)
    got = sorted((r.open_time, r.close) for r in ds.dedup_bars([p0, p1]).collect())
    assert got == [(t, 1.0), (t + dt.timedelta(hours=1), 3.0)]


def test_chrono_split_matches_brute_force(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(s, t + dt.timedelta(hours=h)) for h in range(37) for s in ("a", "b", "c") if (h + ord(s)) % 4]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz")
    got = {(r.symbol, r.open_time): r.is_train for r in ds.chrono_split(df).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    cut = int(len(order) * 0.8)
    want = {r: int(i < cut) for i, r in enumerate(order)}
    assert got == want


def test_maturation_and_range(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("s", t + dt.timedelta(days=d)) for d in range(0, 120, 10)]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz")
    kept = [r.open_time for r in ds.maturation(df).orderBy("open_time").collect()]
    assert kept[0] == t + dt.timedelta(days=90)
    rng = ds.date_range(df, "2024-01-11", "2024-01-31")
    assert rng.count() == 3


def test_symbol_from_file_name(spark):
    from tickframe.functions.text import symbol_from_file_name
    df = spark.createDataFrame([("/x/analise_v2_BTCUSDT_4h.csv",), ("ETHUSDT_4h.csv",), ("plain",)], "p string")
    assert [r.s for r in df.select(symbol_from_file_name("p").alias("s")).collect()] == ["BTCUSDT", "ETHUSDT", "plain"]


def test_legacy_csv_scan(spark, tmp_path):
    import pandas as pd
    from tickframe.sources.files import scan_bars_csv
    for name in ("analise_v2_AUSDT_4h.csv", "BUSDT_4h.csv"):
        pd.DataFrame({"open_time": ["2024-01-01 00:00:00"], "open": [1.0], "high": [2.0], "low": [0.5],
                      "close": [1.5], "volume": [9.0]}).to_csv(tmp_path / name, index=False)
    got = sorted(r.symbol for r in scan_bars_csv(spark, str(tmp_path / "*_4h.csv")).collect())
    assert got == ["AUSDT", "BUSDT"]


def test_maturation_skew_safe_equal(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(s, t + dt.timedelta(days=d + o)) for s, o in (("a", 0), ("b", 17)) for d in range(0, 200, 3)]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz")
    a = sorted(map(tuple, ds.maturation(df).collect()))
    b = sorted(map(tuple, ds.maturation(df, skew_safe=True).select("symbol", "open_time").collect()))
    assert a == b and len(a) > 0
