"""Signal runs, trade ledger, trade statistics and equity per symbol.

Rules of the ledger (per symbol, flat at start): buy at the close of an entry
bar; leave at the close of the first later bar whose close is at or below
entry * (1 - stop) (``STOP``, tested first) or that carries the exit flag
(``SIGNAL``); after a stop, re-enter at the next entry bar; a trade still open
at the last bar is ``OPEN`` at the last close.  Return per trade:
(exit - entry - fee * (entry + exit)) / entry.

The ledger is built from *segments*: the bars after one exit-flag bar up to
and including the next one.  Segments are independent, so the ledger is a
grouped map over (symbol, segment); the first trade of each segment alone is
a pure join + ``min`` aggregate (``first_trade_per_segment``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.windows import KEY, TIME

_UNB = Window.unboundedPreceding

STOP_PCT = 0.15   # fixed values of the reference backtest
FEE = 0.001
START_CASH = 200.0


def _monthly(df: DataFrame, key: str, time: str) -> DataFrame:
    """Hash-partition by (key, month).  Both the per-month aggregate and the row
    branch read this one exchange (Spark reuses it), so the upstream plan runs
    once, and no task holds more than one symbol-month."""
    return df.withColumn("_bk", F.trunc(F.to_date(time), "month")).repartition(key, "_bk")


def signal_runs(df: DataFrame, signal: str = "signal", key: str = KEY, time: str = TIME) -> DataFrame:
    """Gaps-and-islands: ``run_id`` increases by one each time the signal changes.
    Month-local windows plus prefix sums on the month table (skew-safe)."""
    m = _monthly(df, key, time)
    wm = Window.partitionBy(key, "_bk").orderBy(time)
    tot = m.groupBy(key, "_bk").agg(F.min_by(signal, time).alias("_first"), F.max_by(signal, time).alias("_last"),
                                    F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(key).orderBy("_bk")
    tot = tot.withColumn("_prev", F.lag("_last").over(wk))
    inner = m.withColumn("_chg", F.coalesce(F.col(signal) != F.lag(signal).over(wm), F.lit(True)).cast("int"))
    inner_tot = inner.groupBy(key, "_bk").agg(F.sum("_chg").alias("_c_in"))   # first row counted as a change
    tot = tot.join(inner_tot, [key, "_bk"])
    first_chg = F.coalesce(F.col("_first") != F.col("_prev"), F.lit(True)).cast("int")
    tot = tot.withColumn("_c", F.col("_c_in") - F.lit(1) + first_chg)
    tot = tot.select(key, "_bk", "_prev", F.coalesce(F.sum("_c").over(wk.rowsBetween(_UNB, -1)), F.lit(0)).alias("_pc"))
    r = inner.join(tot, [key, "_bk"])
    first_row = F.row_number().over(wm) == 1
    chg = F.when(first_row, F.coalesce(F.col(signal) != F.col("_prev"), F.lit(True)).cast("int")).otherwise(F.col("_chg"))
    r = r.withColumn("_chg2", chg)
    run = F.col("_pc") + F.sum("_chg2").over(wm.rowsBetween(_UNB, 0))
    return r.withColumn("run_id", run.cast("int")).drop("_bk", "_chg", "_chg2", "_prev", "_pc")


def segments(flags: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """Number rows (``_i``, 1-based) and segments (``seg``: exit-flag rows seen
    before); month-local windows plus prefix sums on the month table."""
    m = _monthly(flags.select(key, time, "close", F.col("entry").cast("boolean").alias("entry"),
                              F.col("exit").cast("boolean").alias("exit")), key, time)
    tot = m.groupBy(key, "_bk").agg(F.sum(F.col("exit").cast("int")).alias("_ne"), F.count(F.lit(1)).alias("_nr"))
    wk = Window.partitionBy(key).orderBy("_bk").rowsBetween(_UNB, -1)
    pre = tot.select(key, "_bk", F.coalesce(F.sum("_ne").over(wk), F.lit(0)).alias("_pe"),
                     F.coalesce(F.sum("_nr").over(wk), F.lit(0)).alias("_pr"))
    wm = Window.partitionBy(key, "_bk").orderBy(time)
    r = m.join(pre, [key, "_bk"])
    exits_before = F.coalesce(F.sum(F.col("exit").cast("int")).over(wm.rowsBetween(_UNB, -1)), F.lit(0))
    return (r.withColumn("_i", (F.col("_pr") + F.row_number().over(wm)).cast("long"))
             .withColumn("seg", (F.col("_pe") + exits_before).cast("long"))
             .drop("_bk", "_pe", "_pr"))


LEDGER_SCHEMA = ("symbol string, entry_time timestamp_ntz, entry_price double, "
                 "exit_time timestamp_ntz, exit_price double, exit_reason string")


def _fold_segment(stop: float):
    """State machine over the rows of one segment (small numpy helper)."""
    import pandas as pd

    def fold(pdf):
        pdf = pdf.sort_values("_i")
        close = pdf["close"].to_numpy(dtype=float)
        entry = pdf["entry"].to_numpy(dtype=bool)
        ext = pdf["exit"].to_numpy(dtype=bool)
        times = pdf[TIME].to_numpy()
        out = []
        held, e, et = False, 0.0, None
        lim = 1.0 - stop
        for r in range(len(close)):
            if held:
                if close[r] <= e * lim:
                    out.append((et, e, times[r], close[r], "STOP"))
                    held = False
                elif ext[r]:
                    out.append((et, e, times[r], close[r], "SIGNAL"))
                    held = False
            elif entry[r]:
                held, e, et = True, close[r], times[r]
        if held:
            out.append((et, e, times[-1], close[-1], "OPEN"))
        res = pd.DataFrame(out, columns=["entry_time", "entry_price", "exit_time", "exit_price", "exit_reason"])
        res.insert(0, "symbol", pdf["symbol"].iloc[0] if len(pdf) else None)
        return res
    return fold


MAX_SEGMENT_ROWS = 200_000   # longest segment folded as one group; longer ones go month by month


def trade_ledger(flags: DataFrame, stop: float = STOP_PCT, fee: float = FEE, key: str = KEY,
                 max_segment_rows: int = MAX_SEGMENT_ROWS) -> DataFrame:
    """Trade ledger from (key, open_time, close, entry, exit) rows.

    Segments (split at exit-flag rows) are independent.  A segment of at most
    ``max_segment_rows`` rows is folded as one group from its first entry row;
    a longer one runs as bounded symbol-month groups chained by summaries
    (``ledger_chunks``), so no group grows with the data.
    """
    from tickframe.session import cut_lineage
    from tickframe.operators.ledger_chunks import ledger_trades
    # the narrow flags are read by two branches (short / long segments): write them
    # once to the shared checkpoint folder so the upstream (enrichment, scoring) runs once
    flags = cut_lineage(flags.select(key, TIME, "close", "entry", "exit"))
    rows = segments(flags, key)
    # segment length and first entry as windows over (key, segment): one pass, no self-join
    seg = Window.partitionBy(key, "seg")
    rows = (rows.withColumn("_len", F.count(F.lit(1)).over(seg))
                .withColumn("_p0", F.min(F.when(F.col("entry"), F.col("_i"))).over(seg))
                .filter(F.col("_i") >= F.col("_p0")).drop("_p0"))
    short = rows.filter(F.col("_len") <= max_segment_rows)
    out = (short.select(F.col(key).alias("symbol"), "seg", "_i", TIME, "close", "entry", "exit")
                .groupBy("symbol", "seg").applyInPandas(_fold_segment(stop), LEDGER_SCHEMA))
    if key != "symbol":
        out = out.withColumnRenamed("symbol", key)
    # long segments: bounded month groups chained through small summaries
    out = out.unionByName(ledger_trades(rows.filter(F.col("_len") > max_segment_rows), stop, key))
    w = Window.partitionBy(key).orderBy("entry_time")
    e, x = F.col("entry_price"), F.col("exit_price")
    return out.select(key, F.row_number().over(w).alias("trade_no"), "entry_time", "entry_price",
                      "exit_time", "exit_price", "exit_reason",
                      ((x - e - F.lit(fee) * (e + x)) / e).alias("ret"))


def first_trade_per_segment(flags: DataFrame, stop: float = STOP_PCT, fee: float = FEE,
                            key: str = KEY) -> DataFrame:
    """First trade of every segment, no re-entry: windows over (key, segment) only."""
    rows = segments(flags, key)
    seg = Window.partitionBy(key, "seg")
    i = F.col("_i")
    rows = rows.withColumn("_p0", F.min(F.when(F.col("entry"), i)).over(seg)).filter(F.col("_p0").isNotNull())
    rows = (rows.withColumn("entry_price", F.max(F.when(i == F.col("_p0"), F.col("close"))).over(seg))
                .withColumn("entry_time", F.max(F.when(i == F.col("_p0"), F.col(TIME))).over(seg)))
    hit = (i > F.col("_p0")) & (F.col("close") <= F.col("entry_price") * F.lit(1.0 - stop))
    rows = (rows.withColumn("_t", F.min(F.when(hit, i)).over(seg))
                .withColumn("_x", F.max(F.when(F.col("exit"), i)).over(seg))
                .withColumn("_last", F.max(i).over(seg)))
    ex = F.coalesce("_t", "_x", "_last")
    reason = (F.when(F.col("_t").isNotNull(), F.lit("STOP"))
               .when(F.col("_x").isNotNull(), F.lit("SIGNAL")).otherwise(F.lit("OPEN")))
    out = rows.filter(i == ex).select(key, "entry_time", "entry_price", F.col(TIME).alias("exit_time"),
                                      F.col("close").alias("exit_price"), reason.alias("exit_reason"))
    e, x = F.col("entry_price"), F.col("exit_price")
    return out.withColumn("ret", (x - e - F.lit(fee) * (e + x)) / e)


def trade_stats(ledger: DataFrame, fee: float = FEE) -> DataFrame:
    """Portfolio-style statistics over closed trades (OPEN ones only counted)."""
    closed = F.col("exit_reason") != "OPEN"
    r = F.when(closed, F.col("ret"))
    win, loss = F.when(closed & (F.col("ret") > 0), F.col("ret")), F.when(closed & (F.col("ret") < 0), F.col("ret"))
    fees = F.when(closed, F.lit(fee) * (F.col("entry_price") + F.col("exit_price")) / F.col("entry_price"))
    return ledger.agg(
        F.count_if(closed).alias("trades"), F.count_if(~closed).alias("open_trades"),
        (F.count(win) / F.count(r)).alias("win_rate"), F.max(r).alias("best"), F.min(r).alias("worst"),
        F.avg(win).alias("avg_win"), F.avg(loss).alias("avg_loss"),
        (F.sum(win) / F.abs(F.sum(loss))).alias("profit_factor"), F.avg(r).alias("expectancy"),
        F.sum(fees).alias("fees_paid"))


def trade_multiplier(fee: float = FEE):
    """Cash multiplier of one closed trade bought and sold with all cash."""
    return (F.col("exit_price") / F.col("entry_price")) * F.lit((1.0 - fee) / (1.0 + fee))


def compounded_return(ledger: DataFrame, start_cash: float = START_CASH, fee: float = FEE,
                      key: str = KEY) -> DataFrame:
    """Per symbol: closed trades compounded from ``start_cash`` (own cash per symbol)."""
    closed = ledger.filter(F.col("exit_reason") != "OPEN")
    g = closed.groupBy(key).agg(F.count(F.lit(1)).alias("n_trades"),
                                F.product(trade_multiplier(fee)).alias("_m"))
    return g.select(key, "n_trades", (F.lit(start_cash) * F.col("_m")).alias("final_equity"),
                    (F.col("_m") - F.lit(1.0)).alias("total_return"))


def equity_curve(flags: DataFrame, ledger: DataFrame, start_cash: float = START_CASH, fee: float = FEE,
                 key: str = KEY, time: str = TIME) -> DataFrame:
    """Mark-to-market equity per bar: closed trades compounded, an open position
    valued at close / entry / (1 + fee).  Equi-joins with the ledger, then
    month-local running windows plus prefixes from the month table."""
    bars = flags.select(key, time, "close")
    ent = ledger.select(key, F.col("entry_time").alias(time), F.struct(
        F.col("entry_price").alias("e"),
        F.when(F.col("exit_reason") != "OPEN", F.col("exit_time")).alias("x")).alias("_tr"))
    ext = (ledger.filter(F.col("exit_reason") != "OPEN")
                 .select(key, F.col("exit_time").alias(time), F.log(trade_multiplier(fee)).alias("_lm")))
    m = _monthly(bars.join(ent, [key, time], "left").join(ext, [key, time], "left"), key, time)
    wk = Window.partitionBy(key).orderBy("_bk").rowsBetween(_UNB, -1)
    tot = m.groupBy(key, "_bk").agg(F.max_by("_tr", F.when(F.col("_tr").isNotNull(), F.col(time))).alias("_lt"),
                                    F.sum("_lm").alias("_s"))
    pre = tot.select(key, "_bk", F.last("_lt", True).over(wk).alias("_ptr"),
                     F.coalesce(F.sum("_s").over(wk), F.lit(0.0)).alias("_ps"))
    wm = Window.partitionBy(key, "_bk").orderBy(time).rowsBetween(_UNB, 0)
    df = m.join(pre, [key, "_bk"])
    df = (df.withColumn("_cur", F.coalesce(F.last("_tr", True).over(wm), F.col("_ptr")))
            .withColumn("_p", F.exp(F.col("_ps") + F.coalesce(F.sum("_lm").over(wm), F.lit(0.0)))))
    # held from the entry bar up to (not including) the exit bar; OPEN trades have no exit
    in_pos = F.col("_cur").isNotNull() & (F.col("_cur.x").isNull() | (F.col(time) < F.col("_cur.x")))
    df = df.withColumn("equity", F.lit(start_cash) * F.col("_p") *
                       F.when(in_pos, F.col("close") / F.col("_cur.e") / F.lit(1.0 + fee)).otherwise(F.lit(1.0)))
    return df.select(key, time, "equity", "_bk")


def equity_drawdown(curve: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """Per symbol: final equity and maximum drawdown of the equity curve
    (running peak = month-local running max and the earlier months' maxima)."""
    if "_bk" not in curve.columns:
        curve = curve.withColumn("_bk", F.trunc(F.to_date(time), "month"))
    wk = Window.partitionBy(key).orderBy("_bk").rowsBetween(_UNB, -1)
    pre = (curve.groupBy(key, "_bk").agg(F.max("equity").alias("_mx"))
                .select(key, "_bk", F.max("_mx").over(wk).alias("_pmx")))
    wm = Window.partitionBy(key, "_bk").orderBy(time).rowsBetween(_UNB, 0)
    peak = F.greatest(F.col("_pmx"), F.max("equity").over(wm))
    dd = curve.join(pre, [key, "_bk"]).withColumn("dd", F.col("equity") / peak - F.lit(1.0))
    return dd.groupBy(key).agg(F.max_by("equity", time).alias("final_equity"), F.min("dd").alias("max_drawdown"))
