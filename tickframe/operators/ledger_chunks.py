"""Trade ledger with bounded groups: no task folds more than one symbol-month.

The stop / re-entry state machine is sequential, but its state crossing a
month boundary is small: flat, or holding at an entry price ``e``.

1. Per (symbol, segment, month) -- a bounded group -- a summary is computed:
   the outcome at the month's end when the month starts flat, and, for a
   position carried in at ``e``, where it leaves: at the first *record low*
   (running minimum) at or below ``e * (1 - stop)``, or at the segment's exit
   bar; after that the month continues as if flat from the next row, whose
   end outcome is precomputed by a backward pass (next stop per row by a
   sparse-table search).
2. Per segment, the month summaries (one row per month) are chained in time
   order: a tiny sequential pass over months, not over bars.
3. Per month again, the fold runs from its known incoming state and emits the
   trades that exit in that month (an OPEN trade at the end of the segment).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.functions.windows import KEY, TIME

# entry times inside summaries travel as epoch nanoseconds (long)
SUMMARY_SCHEMA = ("symbol string, seg long, mth date, first_i long, flat_kind int, flat_e double, "
                  "flat_et long, rec_val array<double>, rec_kind array<int>, rec_e array<double>, "
                  "rec_et array<long>, x_present boolean, x_i long, last_in_seg boolean")
INCOMING_SCHEMA = "symbol string, seg long, mth date, in_kind int, in_e double, in_et long"
TRADES_SCHEMA = ("symbol string, entry_time timestamp_ntz, entry_price double, exit_time timestamp_ntz, "
                 "exit_price double, exit_reason string")


def _next_stop(c: np.ndarray, lim: float) -> np.ndarray:
    """For every row r: first t > r with c[t] <= lim * c[r], else -1 (sparse table + binary lifting)."""
    n = len(c)
    levels = [c.copy()]
    k = 1
    while (1 << k) <= n:
        prev = levels[-1]
        half = 1 << (k - 1)
        cur = prev.copy()
        cur[: n - half] = np.minimum(prev[: n - half], prev[half:])
        levels.append(cur)
        k += 1
    theta = c * lim
    pos = np.arange(1, n + 1)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        ok = pos + step <= n
        idx = np.minimum(pos, n - 1)
        jump = ok & (levels[k][idx] > theta)
        pos = np.where(jump, pos + step, pos)
    found = (pos < n) & (c[np.minimum(pos, n - 1)] <= theta)
    return np.where(found, pos, -1)


def _flat_outcomes(c, entry, exit_, times, lim):
    """End-of-month outcome when flat before row s, for every s (backward pass).
    kind 0 = flat, 1 = holding (e, et)."""
    n = len(c)
    nxt = _next_stop(c, lim)
    x = int(np.argmax(exit_)) if exit_.any() else -1
    next_entry = np.full(n + 1, -1)
    for r in range(n - 1, -1, -1):
        next_entry[r] = r if entry[r] else next_entry[r + 1]
    kind = np.zeros(n + 2, dtype=np.int32)
    e = np.zeros(n + 2)
    et = np.zeros(n + 2, dtype=np.int64)
    tns = times.astype("datetime64[ns]").astype(np.int64)
    for s in range(n - 1, -1, -1):
        q = next_entry[s]
        if q < 0:
            continue
        t = nxt[q]
        if x > q and (t < 0 or x < t):
            t = x
        if t < 0:
            kind[s], e[s], et[s] = 1, c[q], tns[q]
        else:
            kind[s], e[s], et[s] = kind[t + 1], e[t + 1], et[t + 1]
    return kind, e, et, x


def _summarize(stop: float):
    lim = 1.0 - stop

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        c = pdf["close"].to_numpy(dtype=float)
        entry = pdf["entry"].to_numpy(dtype=bool)
        ex = pdf["exit"].to_numpy(dtype=bool)
        times = pdf[TIME].to_numpy()
        kind, e, et, x = _flat_outcomes(c, entry, ex, times, lim)
        run_min = np.minimum.accumulate(c)
        is_rec = np.r_[True, c[1:] < run_min[:-1]]
        rec = np.flatnonzero(is_rec)
        return pd.DataFrame([{
            "symbol": pdf["symbol"].iloc[0], "seg": pdf["seg"].iloc[0], "mth": pdf["mth"].iloc[0],
            "first_i": int(pdf["_i"].iloc[0]), "flat_kind": int(kind[0]), "flat_e": float(e[0]),
            "flat_et": int(et[0]), "rec_val": c[rec].tolist(), "rec_kind": kind[rec + 1].tolist(),
            "rec_e": e[rec + 1].tolist(), "rec_et": et[rec + 1].tolist(), "x_present": x >= 0,
            "x_i": int(pdf["_i"].iloc[x]) if x >= 0 else -1, "last_in_seg": bool(pdf["_last"].iloc[0])}])
    return fn


def _chain(stop: float):
    lim = 1.0 - stop

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first_i")
        kind, e, et = 0, 0.0, 0
        out = []
        for r in pdf.itertuples(index=False):
            out.append((r.symbol, r.seg, r.mth, int(kind), float(e) if kind else None, int(et) if kind else None))
            if kind == 0:
                kind, e, et = r.flat_kind, r.flat_e, r.flat_et
                continue
            j = next((k for k, v in enumerate(r.rec_val) if v <= e * lim), None)
            if j is not None:                        # stop at a record low
                kind, e, et = r.rec_kind[j], r.rec_e[j], r.rec_et[j]
            elif r.x_present:                        # signal exit at the segment's exit bar
                kind, e, et = 0, 0.0, 0
        return pd.DataFrame(out, columns=["symbol", "seg", "mth", "in_kind", "in_e", "in_et"])
    return fn


def _emit(stop: float):
    lim = 1.0 - stop

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        c = pdf["close"].to_numpy(dtype=float)
        entry = pdf["entry"].to_numpy(dtype=bool)
        ex = pdf["exit"].to_numpy(dtype=bool)
        times = pdf[TIME].to_numpy()
        held = bool(pdf["in_kind"].iloc[0] == 1)
        e = pdf["in_e"].iloc[0]
        et = pd.Timestamp(int(pdf["in_et"].iloc[0])) if held else None
        out = []
        for r in range(len(c)):
            if held:
                if c[r] <= e * lim:
                    out.append((et, e, times[r], c[r], "STOP"))
                    held = False
                elif ex[r]:
                    out.append((et, e, times[r], c[r], "SIGNAL"))
                    held = False
            elif entry[r]:
                held, e, et = True, c[r], times[r]
        if held and bool(pdf["_last"].iloc[0]):
            out.append((et, e, times[-1], c[-1], "OPEN"))
        res = pd.DataFrame(out, columns=["entry_time", "entry_price", "exit_time", "exit_price", "exit_reason"])
        res["entry_time"] = pd.to_datetime(res["entry_time"])
        res["exit_time"] = pd.to_datetime(res["exit_time"])
        res.insert(0, "symbol", pdf["symbol"].iloc[0])
        return res
    return fn


def ledger_trades(rows: DataFrame, stop: float, key: str = KEY) -> DataFrame:
    """Trades from segmented rows (key, open_time, close, entry, exit, _i, seg)."""
    r = rows.select(F.col(key).alias("symbol"), "seg", "_i", TIME, "close", "entry", "exit")
    r = r.withColumn("mth", F.trunc(F.to_date(TIME), "month"))
    lastmth = r.groupBy("symbol", "seg").agg(F.max("mth").alias("_lbk"))
    r = (r.join(lastmth, ["symbol", "seg"]).withColumn("_last", F.col("mth") == F.col("_lbk")).drop("_lbk")
          .repartition("symbol", "seg", "mth"))
    summ = r.groupBy("symbol", "seg", "mth").applyInPandas(_summarize(stop), SUMMARY_SCHEMA)
    incoming = summ.groupBy("symbol", "seg").applyInPandas(_chain(stop), INCOMING_SCHEMA)
    withstate = r.join(incoming, ["symbol", "seg", "mth"])
    out = withstate.groupBy("symbol", "seg", "mth").applyInPandas(_emit(stop), TRADES_SCHEMA)
    return out.withColumnRenamed("symbol", key) if key != "symbol" else out
