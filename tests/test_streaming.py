"""Streaming jobs (availableNow) against their batch definitions."""
import datetime as dt
import json
import os
import uuid

from tickframe.session import checkpoint_dir
from tickframe.streaming import bars as st

EPOCH = dt.datetime(1970, 1, 1)


def _payload(rows):
    out = []
    for t, o, h, l, c, v in rows:
        ms = int((t - EPOCH).total_seconds() * 1000)
        out.append([str(ms), str(o), str(h), str(l), str(c), str(v), str(ms + 3599999), "0", "1", "0", "0", "0"])
    return json.dumps(out)


def test_stream_upsert_new_values_win(spark):
    base = os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")
    landing, staging = base + "/landing", base + "/staging"
    t0 = dt.datetime(2024, 1, 1)
    existing = spark.createDataFrame(
        [("X", t0, 1.0, 2.0, 0.5, 1.5, 10.0), ("X", t0 + dt.timedelta(hours=1), 1.5, 2.5, 1.0, 2.0, None)],
        "symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double")
    page1 = [(t0 + dt.timedelta(hours=1), 1.5, 2.6, 1.0, 2.2, 7.0), (t0 + dt.timedelta(hours=2), 2.2, 3.0, 2.0, 2.9, 5.0)]
    page2 = [(t0 + dt.timedelta(hours=2), 2.2, 3.0, 2.0, 2.9, 5.0)]      # re-sent bar
    spark.createDataFrame([("X", _payload(page1))], "symbol string, payload string").write.json(landing, mode="append")
    spark.createDataFrame([("X", _payload(page2)), ("X", "[]")], "symbol string, payload string") \
        .write.json(landing, mode="append")
    out = {r.open_time: (r.close, r.volume) for r in st.stream_upsert(spark, existing, landing, staging).collect()}
    assert out == {t0: (1.5, 10.0), t0 + dt.timedelta(hours=1): (2.2, 7.0), t0 + dt.timedelta(hours=2): (2.9, 5.0)}


def test_late_and_changed_bars(spark):
    """A back-fill far behind the newest bar is kept, a re-sent bar takes its newest value, and only touched symbols are written."""
    base = os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")
    landing, staging, table = base + "/landing", base + "/staging", base + "/table"
    t0 = dt.datetime(2024, 1, 1)
    day = dt.timedelta(days=1)
    pages = [[(t0 + 200 * day, 1, 1, 1, 9.0, 1)], [(t0 + 201 * day, 1, 1, 1, 5.0, 1)], [(t0 + 200 * day, 1, 1, 1, 4.0, 2)], [(t0, 1, 1, 1, 3.0, 1)]]
    for page in pages:
        spark.createDataFrame([("X", _payload(page))], "symbol string, payload string").coalesce(1).write.json(landing, mode="append")
    columns = "symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double"
    existing = spark.createDataFrame([("X", t0 - day, 1.0, 1.0, 1.0, 1.0, 1.0), ("Y", t0, 2.0, 2.0, 2.0, 2.0, 2.0)], columns)
    existing.write.partitionBy("symbol").parquet(table)
    first = {r.open_time: r.close for r in st.stream_dedup(spark, landing, base + "/first").collect()}
    assert first == {t0 + 200 * day: 9.0, t0 + 201 * day: 5.0, t0: 3.0}
    old = spark.read.parquet(table).select(*existing.columns)
    updated = st.stream_upsert(spark, old, landing, staging)
    names = {f for _, _, fs in os.walk(table + "/symbol=Y") for f in fs}
    st.write_back(spark, updated, spark.read.parquet(staging), table, lambda df: df.withColumn("close", df["close"] + 0))
    assert names == {f for _, _, fs in os.walk(table + "/symbol=Y") for f in fs}
    back = {(r.symbol, r.open_time): (r.close, r.volume) for r in spark.read.parquet(table).collect()}
    assert back == {("X", t0 - day): (1.0, 1.0), ("X", t0): (3.0, 1.0), ("X", t0 + 200 * day): (4.0, 2.0), ("X", t0 + 201 * day): (5.0, 1.0),
                    ("Y", t0): (2.0, 2.0)}


def test_monitor_watches_a_position_bought_again(spark, tmp_path):
    import datetime as dt
    day = lambda d: dt.datetime(2024, 1, d)
    schema = ("symbol string, open_time timestamp_ntz, close double, high double, prob_buy double, roc double, "
              "buy_time timestamp_ntz, buy_price double, qty double, peak_price double")
    bar = lambda d, close, bought, buy: ("s", day(d), close, close, 0.9, None, day(bought), buy, 1.0, None)
    landing = str(tmp_path / "feed")
    for rows in ([bar(2, 100.0, 1, 100.0), bar(3, 84.0, 1, 100.0), bar(4, 80.0, 1, 100.0)],
                 [bar(6, 50.0, 1, 100.0), bar(6, 81.0, 5, 80.0)], [bar(8, 70.0, 5, 80.0), bar(7, 88.5, 5, 80.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    got = st.stream_exits(spark, landing, str(tmp_path / "out"), str(tmp_path / "ckpt")).collect()
    assert sorted((r.buy_price, r.exit_time, r.exit_reason, r.peak_price) for r in got) == [
        (80.0, day(7), "TAKE_PROFIT", 88.5), (100.0, day(3), "STOP_LOSS", 100.0)]
