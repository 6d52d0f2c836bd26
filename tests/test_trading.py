import datetime as dt

from pyspark.sql import functions as F

from tickframe.operators import positions as po
from tickframe.operators import signals as sg
from tickframe.operators import trades as tr
from tickframe.operators.upsert import upsert

T0 = dt.datetime(2024, 1, 1)


def _t(i):
    return T0 + dt.timedelta(hours=4 * i)


def test_upsert_literal_and_idempotent(spark):
    schema = "symbol string, open_time timestamp_ntz, v double"
    old = spark.createDataFrame([("s", _t(1), 1.0), ("s", _t(2), None), ("s", _t(3), 3.0)], schema)
    new = spark.createDataFrame([("s", _t(2), 9.0), ("s", _t(4), 8.0), ("s", _t(3), None)], schema)
    once = upsert(old, new)
    got = {r.open_time: r.v for r in once.collect()}
    assert got == {_t(1): 1.0, _t(2): 9.0, _t(3): 3.0, _t(4): 8.0}
    twice = {r.open_time: r.v for r in upsert(once, new).collect()}
    assert twice == got


def test_signal_pivot_duplicates(spark):
    df = spark.createDataFrame([(_t(0), "a", 0), (_t(0), "a", 1), (_t(0), "b", 1)],
                               "open_time timestamp_ntz, symbol string, signal int")
    ee = {(r.symbol): (r.mean_signal, r.entry, r.exit) for r in sg.entries_exits(df).collect()}
    assert ee["a"] == (0.5, True, False)
    wide = sg.pivot_wide(df, "signal", ["a", "b", "c"]).collect()[0]
    assert wide["a"] == 0.5 and wide["c"] is None


def test_ledger_stop_and_reentry(spark):
    closes = [100, 90, 84, 80, 88]
    rows = [("s", _t(i), float(c), True, False) for i, c in enumerate(closes)]
    flags = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close double, entry boolean, exit boolean")
    led = tr.trade_ledger(flags).orderBy("trade_no").collect()
    assert [(r.entry_price, r.exit_price, r.exit_reason) for r in led] == [(100.0, 84.0, "STOP"), (80.0, 88.0, "OPEN")]
    first = tr.first_trade_per_segment(flags).collect()
    assert [(r.entry_price, r.exit_reason) for r in first] == [(100.0, "STOP")]


def test_ledger_signal_exit(spark):
    rows = [("s", _t(0), 10.0, True, False), ("s", _t(1), 11.0, True, False), ("s", _t(2), 12.0, False, True),
            ("s", _t(3), 13.0, True, False)]
    flags = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close double, entry boolean, exit boolean")
    led = tr.trade_ledger(flags).orderBy("trade_no").collect()
    assert [(r.entry_price, r.exit_price, r.exit_reason) for r in led] == [(10.0, 12.0, "SIGNAL"), (13.0, 13.0, "OPEN")]
    assert abs(led[0].ret - (12 - 10 - 0.001 * 22) / 10) < 1e-12


def _decide(spark, close, roc, prob, peak=130.0, high=None):
    pos = spark.createDataFrame([("s", 100.0, 1.0, peak)], "symbol string, buy_price double, qty double, peak_price double")
    latest = spark.createDataFrame([("s", close, prob, roc)], "symbol string, close double, prob_buy double, roc double")
    raw = spark.createDataFrame([("s", high if high is not None else close, close)], "symbol string, high double, close double")
    return po.exit_decisions(pos, latest, raw, 0.49).collect()[0].exit_reason


def test_exit_rules(spark):
    assert _decide(spark, 115.0, 0.07, 0.9) == "TRAILING_ROCKET"
    assert _decide(spark, 115.0, 0.01, 0.9) == "TAKE_PROFIT"
    assert _decide(spark, 115.0, 0.07, 0.1) == "SIGNAL_OFF"
    assert _decide(spark, 85.0, 0.07, 0.9) == "STOP_LOSS"
    assert _decide(spark, 105.0, 0.01, 0.9) is None


def test_allocation_first_k_in_list_order(spark):
    cand = spark.createDataFrame([("c", 3, 0.9, 1.0), ("a", 1, 0.6, 2.0), ("b", 2, 0.7, 4.0)],
                                 "symbol string, pos int, prob_buy double, buy_price double")
    got = po.buy_allocation(cand, 25.0).orderBy("symbol").collect()
    assert [(r.symbol, r.value, r.qty) for r in got] == [("a", 12.5, 6.25), ("b", 12.5, 3.125)]
    assert po.buy_allocation(cand, 9.0).count() == 0


def test_best_candidate_tie_list_order(spark):
    df = spark.createDataFrame([("x", 2, 0.5), ("y", 1, 0.5), ("z", 3, 0.0)], "symbol string, pos int, prob_buy double")
    assert sg.best_candidate(df).collect()[0].symbol == "y"


def test_wallet_round_trip(spark):
    pos = spark.createDataFrame([("BIOUSDT", 0.1617, 618.43, 0.1617)],
                                "symbol string, buy_price double, qty double, peak_price double")
    back = po.wallet_positions(po.wallet_json(pos, 0.0)).collect()[0]
    assert (back.symbol, back.buy_price, back.qty, back.cash_usdt) == ("BIOUSDT", 0.1617, 618.43, 0.0)


def test_equity_curve_brute_force(spark):
    import datetime as dt2
    closes = [100, 104, 90, 84, 80, 88, 95, 91, 99, 120, 118, 70, 75]
    sig = [1, 1, 1, 1, 1, 1, 0, 1, 1, 1, 0, 1, 1]
    t0 = dt2.datetime(2024, 1, 28)          # crosses a month boundary
    rows = [("s", t0 + dt2.timedelta(days=i), float(c), s == 1, s == 0) for i, (c, s) in enumerate(zip(closes, sig))]
    flags = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close double, entry boolean, exit boolean")
    led = tr.trade_ledger(flags)
    got = {r.open_time: r.equity for r in tr.equity_curve(flags, led).collect()}
    # brute force
    f = 0.001
    cash, held, e = 200.0, False, None
    want = {}
    for (_, t, c, en, ex) in rows:
        if held and (c <= e * 0.85 or ex):
            cash *= (c / e) * (1 - f) / (1 + f)
            held = False
            want[t] = cash
            continue
        if not held and en:
            held, e = True, c
        want[t] = cash * (c / e / (1 + f)) if held else cash
    assert set(got) == set(want)
    for t in want:
        assert abs(got[t] - want[t]) < 1e-9 * max(1, want[t]), (t, got[t], want[t])
    dd = tr.equity_drawdown(tr.equity_curve(flags, led)).collect()[0]
    vals = [want[t] for t in sorted(want)]
    peak, mdd = vals[0], 0.0
    for v in vals:
        peak = max(peak, v)
        mdd = min(mdd, v / peak - 1)
    assert abs(dd.max_drawdown - mdd) < 1e-12 and abs(dd.final_equity - vals[-1]) < 1e-9


def test_ledger_month_chunks_equal_segment_fold(spark):
    """Force the bounded month-chunk path (segments longer than 3 rows) and compare."""
    import datetime as dt2
    import random
    rnd = random.Random(3)
    rows = []
    t0 = dt2.datetime(2023, 12, 20)
    for sym in ("a", "b"):
        price = 100.0
        for i in range(220):
            price *= 1 + rnd.uniform(-0.09, 0.08)
            sig = 0 if rnd.random() < 0.04 else 1
            rows.append((sym, t0 + dt2.timedelta(days=i), price, sig == 1, sig == 0))
    flags = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close double, entry boolean, exit boolean")
    a = sorted(map(tuple, tr.trade_ledger(flags).collect()))
    b = sorted(map(tuple, tr.trade_ledger(flags, max_segment_rows=3).collect()))
    assert a == b and len(a) > 10
