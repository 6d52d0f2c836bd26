"""Registered queries: scoring (stub scorer), signals, reports, backtest ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import dataset as ds
from tickframe.operators import features as feat
from tickframe.operators import signals as sg
from tickframe.operators import trades as tr
from tickframe.plans.catalog import finish, finish_sql, register
from tickframe.plans.stub import STUB_SQL, stub_probability
from tickframe.plans.oracle_enrich import live_sql, research_sql
from tickframe.schemas import BAR_COLS, LIVE_FEATURES, MODEL_FEATURES, RESEARCH_FEATURES
from tickframe.sources.fixtures import BARS_D_SQL, BARS_S_SQL, bars_d, bars_s, table

K = ["symbol", "open_time"]
D = 6   # probabilities and returns: 6 decimals
THR = 0.49
STOP = repr(1.0 - tr.STOP_PCT)
NN_R = " AND ".join(f"{c} IS NOT NULL" for c in K + BAR_COLS + RESEARCH_FEATURES)
NN_L = " AND ".join(f"{c} IS NOT NULL" for c in K + BAR_COLS + LIVE_FEATURES)


# ---- research signals on daily bars -------------------------------------

def research_signals(spark, sf):
    df = ds.drop_incomplete(feat.enrich_research(bars_d(spark, sf)))
    return sg.signal_flag(sg.score(df, stub_probability), THR)


def live_signals(spark, sf):
    df = feat.enrich_live(bars_d(spark, sf))
    return sg.signal_flag(sg.score(df, stub_probability), THR)


_SIG = (f"sig AS (SELECT *, {STUB_SQL} AS prob_buy, "
        f"CAST({STUB_SQL} >= {THR} AS INTEGER) AS signal FROM enr WHERE {NN_R})")
R_SIG = research_sql(BARS_D_SQL) + ", " + _SIG


@register("signal_flag", finish_sql(R_SIG, "sig", K + ["prob_buy", "signal"], D))
def q_signal_flag(spark, sf):
    return finish(research_signals(spark, sf), D, K + ["prob_buy", "signal"])


@register("align_features", finish_sql(live_sql(BARS_D_SQL) + ", al AS (SELECT *, CAST(0 AS DOUBLE) AS target "
                                       f"FROM enl WHERE {NN_L})", "al", K + MODEL_FEATURES + ["target"], D,
                                       kinds={"target": "double"}))
def q_align_features(spark, sf):
    df = sg.align_features(feat.enrich_live(bars_d(spark, sf)), MODEL_FEATURES + ["target"])
    return finish(df, D)


# ---- live signals on the supplier bars: latest complete row per symbol ----

_LAST300 = (f"SELECT * FROM ({BARS_S_SQL}) "
            "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 300")
_LATEST = (f"lat AS (SELECT *, {STUB_SQL} AS prob_buy FROM enl WHERE {NN_L} "
           "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1), "
           "univ AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, CAST(s_suppkey AS INTEGER) AS pos FROM supplier)")
L_LATEST = live_sql(_LAST300, 250) + ", " + _LATEST


def symbol_universe(spark, sf):
    """The symbol list with its fixed order ``pos`` (from the supplier table)."""
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
        F.col("s_suppkey").cast("int").alias("pos"))


def scored_latest(spark, sf):
    df = feat.enrich_live(ds.last_n_bars(bars_s(spark, sf), 300), parts=None, longest=300)
    return sg.score(ds.latest_bar(df), stub_probability)


@register("score_latest", finish_sql(L_LATEST, "lat", K + ["close", "prob_buy"], D))
def q_score_latest(spark, sf):
    return finish(scored_latest(spark, sf), D, K + ["close", "prob_buy"])


_TOP_SQL = (", tops AS (SELECT CAST(row_number() OVER (ORDER BY prob_buy DESC, pos) AS INTEGER) AS rank, symbol, prob_buy, "
            f"CASE WHEN prob_buy >= {THR} THEN 'BUY' ELSE 'NEUTRAL/SELL' END AS signal, "
            "count(*) OVER () AS n_analyzed FROM lat JOIN univ USING (symbol)) ")


@register("top_signals", finish_sql(L_LATEST + _TOP_SQL, "tops", ["rank", "symbol", "prob_buy", "signal", "n_analyzed"], D,
                                    kinds={"signal": "other", "n_analyzed": "other", "rank": "int"},
                                    where="rank <= 20"))
def q_top_signals(spark, sf):
    return finish(sg.top_signals(scored_latest(spark, sf), symbol_universe(spark, sf), 20, THR), D)


_CONSULT_COLS = ["symbol", "open_time", "close", "prob_buy", "signal", "stop_price", "target_price",
                 "rsi_14", "adx", "bb_width", "stoch_k", "trend"]
_CONSULT_SQL = (", con AS (SELECT symbol, open_time, close, prob_buy, "
                f"CASE WHEN prob_buy >= {THR} THEN 'BUY' ELSE 'NEUTRAL/SELL' END AS signal, "
                f"close * {1.0 - 0.15!r} AS stop_price, CASE WHEN prob_buy >= {THR} THEN close * {1.0 + 0.10!r} END AS target_price, "
                "rsi_14, adx, bb_width, stoch_k, CASE WHEN close > sma_200 THEN 'ABOVE' ELSE 'BELOW' END AS trend "
                "FROM lat WHERE symbol = upper('s7'))")


@register("consult", finish_sql(L_LATEST + _CONSULT_SQL, "con", _CONSULT_COLS, D,
                                kinds={"signal": "other", "trend": "other"}))
def q_consult(spark, sf):
    return finish(sg.consult(scored_latest(spark, sf), "s7", THR), D)


@register("best_candidate", finish_sql(L_LATEST + ", best AS (SELECT symbol, prob_buy FROM lat JOIN univ USING (symbol) "
                                       "WHERE prob_buy > 0 ORDER BY prob_buy DESC, pos LIMIT 1)", "best",
                                       ["symbol", "prob_buy"], D))
def q_best_candidate(spark, sf):
    cand = scored_latest(spark, sf).join(symbol_universe(spark, sf), "symbol")
    return finish(sg.best_candidate(cand), D)


# ---- evaluation on the last 20 % ------------------------------------------

_TEST = (f", tst AS (SELECT target, CAST(prob_buy >= {THR} AS INTEGER) AS pred FROM "
         "(SELECT *, row_number() OVER (ORDER BY open_time, symbol) AS rn, count(*) OVER () AS n FROM sig) "
         "WHERE rn > floor(0.8 * n))")
_REPORT = (", cm AS (SELECT k AS class, "
           "sum(CASE WHEN target = k AND pred = k THEN 1 ELSE 0 END) AS tp, "
           "sum(CASE WHEN target <> k AND pred = k THEN 1 ELSE 0 END) AS fp, "
           "sum(CASE WHEN target = k AND pred <> k THEN 1 ELSE 0 END) AS fn "
           "FROM tst, (SELECT 0 AS k UNION ALL SELECT 1) ks GROUP BY k), "
           "per AS (SELECT CAST(class AS VARCHAR) AS class, "
           "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, "
           "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, CAST(tp + fn AS BIGINT) AS support FROM cm), "
           "per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) "
           "ELSE 0.0 END AS f1 FROM per), "
           "rep AS (SELECT * FROM per2 UNION ALL "
           "SELECT 'macro avg', avg(precision), avg(recall), CAST(sum(support) AS BIGINT), avg(f1) FROM per2 UNION ALL "
           "SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
           "CAST(sum(support) AS BIGINT), sum(f1 * support) / sum(support) FROM per2)")


def _test_rows(spark, sf):
    df = research_signals(spark, sf)
    split = ds.chrono_split(df)
    return split.filter(F.col("is_train") == 0).withColumn("pred", F.col("signal"))


@register("classification_report", finish_sql(R_SIG + _TEST + _REPORT, "rep",
                                              ["class", "precision", "recall", "f1", "support"], D,
                                              kinds={"class": "other", "support": "other"}))
def q_classification_report(spark, sf):
    rep = sg.classification_report(_test_rows(spark, sf))
    return finish(rep.withColumn("support", F.col("support").cast("bigint")), D)


@register("accuracy", finish_sql(R_SIG + _TEST + ", acc AS (SELECT avg(CAST(target = pred AS DOUBLE)) AS accuracy, "
                                 "count(*) AS n FROM tst)", "acc", ["accuracy", "n"], D, kinds={"n": "other"}))
def q_accuracy(spark, sf):
    return finish(sg.accuracy(_test_rows(spark, sf)), D)


# ---- entries / exits, pivots, runs -----------------------------------------

def _ee_sql():
    lv = live_sql(BARS_D_SQL)
    both = (f"both_ AS ((WITH RECURSIVE {R_SIG} SELECT symbol, open_time, signal FROM sig) UNION ALL "
            f"(WITH RECURSIVE {lv} SELECT symbol, open_time, CAST({STUB_SQL} >= {THR} AS INTEGER) AS signal "
            f"FROM enl WHERE {NN_L})), "
            "ee AS (SELECT open_time, symbol, avg(signal) AS mean_signal, coalesce(avg(signal) <> 0, false) AS entry, "
            "coalesce(avg(signal) = 0, false) AS exit FROM both_ GROUP BY open_time, symbol)")
    return finish_sql(both, "ee", ["open_time", "symbol", "mean_signal", "entry", "exit"], D,
                      kinds={"entry": "other", "exit": "other"}, recursive=False)


@register("entries_exits", _ee_sql())
def q_entries_exits(spark, sf):
    both = research_signals(spark, sf).select(*K, "signal").unionByName(live_signals(spark, sf).select(*K, "signal"))
    return finish(sg.entries_exits(both), D)


def _pivot_sql(value):
    cols = ", ".join(f"avg(CASE WHEN symbol = '{s}' THEN {value} END) AS {s}" for s in ("A", "N", "R"))
    return finish_sql(R_SIG + f", pv AS (SELECT open_time, {cols} FROM sig GROUP BY open_time)", "pv",
                      ["open_time", "A", "N", "R"], D)


@register("pivot_signal", _pivot_sql("signal"))
def q_pivot_signal(spark, sf):
    return finish(sg.pivot_wide(research_signals(spark, sf), "signal", ["A", "N", "R"]), D)


@register("pivot_close", _pivot_sql("close"))
def q_pivot_close(spark, sf):
    return finish(sg.pivot_wide(research_signals(spark, sf), "close", ["A", "N", "R"]), D)


_RUNS = (", runs AS (SELECT symbol, open_time, signal, CAST(sum(chg) OVER (PARTITION BY symbol ORDER BY open_time "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS run_id FROM "
         "(SELECT *, CASE WHEN signal = lag(signal) OVER (PARTITION BY symbol ORDER BY open_time) THEN 0 ELSE 1 END AS chg "
         "FROM sig))")


@register("signal_runs", finish_sql(R_SIG + _RUNS, "runs", K + ["signal", "run_id"], D, kinds={"run_id": "int"}))
def q_signal_runs(spark, sf):
    return tr.signal_runs(research_signals(spark, sf)).select(*K, "signal", "run_id")


# ---- trade ledger ----------------------------------------------------------

def flags(spark, sf):
    s = research_signals(spark, sf)
    return s.select(*K, "close", (F.col("signal") != 0).alias("entry"), (F.col("signal") == 0).alias("exit"))


_FL = (", fl AS (SELECT symbol, open_time, close, signal <> 0 AS entry, signal = 0 AS exit, "
       "row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS i FROM sig)")
_LEDGER = (", lr AS (SELECT symbol, i, entry AS in_pos, CASE WHEN entry THEN close END AS e, "
           "CASE WHEN entry THEN open_time END AS et, CAST(NULL AS VARCHAR) AS reason, "
           "CAST(NULL AS DOUBLE) AS ce, CAST(NULL AS TIMESTAMP) AS cet FROM fl WHERE i = 1 "
           "UNION ALL SELECT f.symbol, f.i, "
           f"CASE WHEN l.in_pos AND (f.close <= l.e * {STOP} OR f.exit) THEN false WHEN l.in_pos THEN true ELSE f.entry END, "
           f"CASE WHEN l.in_pos AND (f.close <= l.e * {STOP} OR f.exit) THEN NULL WHEN l.in_pos THEN l.e "
           "WHEN f.entry THEN f.close END, "
           f"CASE WHEN l.in_pos AND (f.close <= l.e * {STOP} OR f.exit) THEN NULL WHEN l.in_pos THEN l.et "
           "WHEN f.entry THEN f.open_time END, "
           f"CASE WHEN l.in_pos AND f.close <= l.e * {STOP} THEN 'STOP' WHEN l.in_pos AND f.exit THEN 'SIGNAL' END, "
           f"CASE WHEN l.in_pos AND (f.close <= l.e * {STOP} OR f.exit) THEN l.e END, "
           f"CASE WHEN l.in_pos AND (f.close <= l.e * {STOP} OR f.exit) THEN l.et END "
           "FROM lr l JOIN fl f ON f.symbol = l.symbol AND f.i = l.i + 1), "
           "lastrow AS (SELECT symbol, max(i) AS mi FROM fl GROUP BY symbol), "
           "tl AS (SELECT l.symbol, l.cet AS entry_time, l.ce AS entry_price, f.open_time AS exit_time, "
           "f.close AS exit_price, l.reason AS exit_reason FROM lr l JOIN fl f ON f.symbol = l.symbol AND f.i = l.i "
           "WHERE l.reason IS NOT NULL UNION ALL "
           "SELECT l.symbol, l.et, l.e, f.open_time, f.close, 'OPEN' FROM lr l JOIN fl f ON f.symbol = l.symbol "
           "AND f.i = l.i JOIN lastrow m ON m.symbol = l.symbol AND m.mi = l.i WHERE l.in_pos), "
           "ledger AS (SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY entry_time) AS INTEGER) AS trade_no, "
           "entry_time, entry_price, exit_time, exit_price, exit_reason, "
           f"(exit_price - entry_price - {tr.FEE!r} * (entry_price + exit_price)) / entry_price AS ret FROM tl)")
LEDGER_SQL = R_SIG + _FL + _LEDGER
LEDGER_COLS = ["symbol", "trade_no", "entry_time", "entry_price", "exit_time", "exit_price", "exit_reason", "ret"]


def ledger(spark, sf):
    return tr.trade_ledger(flags(spark, sf))


@register("trade_ledger", finish_sql(LEDGER_SQL, "ledger", LEDGER_COLS, D,
                                     kinds={"exit_reason": "other", "trade_no": "int"}))
def q_trade_ledger(spark, sf):
    return finish(ledger(spark, sf), D)


_FIRST = (", segs AS (SELECT *, coalesce(sum(CAST(exit AS INTEGER)) OVER (PARTITION BY symbol ORDER BY open_time "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM fl), "
          "p0 AS (SELECT symbol, seg, min(i) AS p FROM segs WHERE entry GROUP BY symbol, seg), "
          "ent AS (SELECT p0.symbol, p0.seg, p0.p, s.close AS entry_price, s.open_time AS entry_time FROM p0 "
          "JOIN segs s ON s.symbol = p0.symbol AND s.i = p0.p), "
          f"hit AS (SELECT e.symbol, e.seg, min(s.i) AS t FROM ent e JOIN segs s ON s.symbol = e.symbol AND s.seg = e.seg "
          f"AND s.i > e.p AND s.close <= e.entry_price * {STOP} GROUP BY e.symbol, e.seg), "
          "se AS (SELECT symbol, seg, max(i) AS last_i, max(CASE WHEN exit THEN i END) AS x_i FROM segs GROUP BY symbol, seg), "
          "fx AS (SELECT e.symbol, e.entry_time, e.entry_price, coalesce(h.t, se.x_i, se.last_i) AS exit_i, "
          "CASE WHEN h.t IS NOT NULL THEN 'STOP' WHEN se.x_i IS NOT NULL THEN 'SIGNAL' ELSE 'OPEN' END AS exit_reason "
          "FROM ent e LEFT JOIN hit h ON h.symbol = e.symbol AND h.seg = e.seg JOIN se ON se.symbol = e.symbol AND se.seg = e.seg), "
          "first_tr AS (SELECT fx.symbol, entry_time, entry_price, s.open_time AS exit_time, s.close AS exit_price, exit_reason, "
          f"(s.close - entry_price - {tr.FEE!r} * (entry_price + s.close)) / entry_price AS ret "
          "FROM fx JOIN segs s ON s.symbol = fx.symbol AND s.i = fx.exit_i)")
_FIRST_COLS = ["symbol", "entry_time", "entry_price", "exit_time", "exit_price", "exit_reason", "ret"]


@register("first_stop_exit", finish_sql(R_SIG + _FL + _FIRST, "first_tr", _FIRST_COLS, D, kinds={"exit_reason": "other"}))
def q_first_stop_exit(spark, sf):
    return finish(tr.first_trade_per_segment(flags(spark, sf)), D, _FIRST_COLS)


_STATS = (", cl AS (SELECT *, exit_reason <> 'OPEN' AS closed FROM ledger), st AS (SELECT "
          "count(*) FILTER (WHERE closed) AS trades, count(*) FILTER (WHERE NOT closed) AS open_trades, "
          "count(*) FILTER (WHERE closed AND ret > 0) / count(*) FILTER (WHERE closed) AS win_rate, "
          "max(ret) FILTER (WHERE closed) AS best, min(ret) FILTER (WHERE closed) AS worst, "
          "avg(ret) FILTER (WHERE closed AND ret > 0) AS avg_win, avg(ret) FILTER (WHERE closed AND ret < 0) AS avg_loss, "
          "sum(ret) FILTER (WHERE closed AND ret > 0) / abs(sum(ret) FILTER (WHERE closed AND ret < 0)) AS profit_factor, "
          "avg(ret) FILTER (WHERE closed) AS expectancy, "
          f"sum({tr.FEE!r} * (entry_price + exit_price) / entry_price) FILTER (WHERE closed) AS fees_paid FROM cl)")
_STATS_COLS = ["trades", "open_trades", "win_rate", "best", "worst", "avg_win", "avg_loss", "profit_factor",
               "expectancy", "fees_paid"]


@register("trade_stats", finish_sql(LEDGER_SQL + _STATS, "st", _STATS_COLS, D,
                                    kinds={"trades": "other", "open_trades": "other"}))
def q_trade_stats(spark, sf):
    return finish(tr.trade_stats(ledger(spark, sf)), D)


# Compounding over prices that jump as the fixture's do leaves every range: both queries below use a damped close.
DAMPED = "(100000.0 + close / 4.0)"
CALM_SQL = R_SIG + _FL.replace("SELECT symbol, open_time, close,", f"SELECT symbol, open_time, {DAMPED} AS close,") + _LEDGER


def calm_flags(spark, sf):
    return flags(spark, sf).withColumn("close", F.lit(100000.0) + F.col("close") / F.lit(4.0))


_MULT = f"(exit_price / entry_price) * {(1.0 - tr.FEE) / (1.0 + tr.FEE)!r}"
_COMP = (f", comp AS (SELECT symbol, count(*) AS n_trades, {tr.START_CASH!r} * product({_MULT}) AS final_equity, "
         f"product({_MULT}) - 1.0 AS total_return FROM ledger WHERE exit_reason <> 'OPEN' GROUP BY symbol)")


@register("compounded_return", finish_sql(CALM_SQL + _COMP, "comp", ["symbol", "n_trades", "final_equity", "total_return"],
                                          D, kinds={"n_trades": "other"}))
def q_compounded_return(spark, sf):
    return finish(tr.compounded_return(tr.trade_ledger(calm_flags(spark, sf))), D)


_EQ = (", cl2 AS (SELECT symbol, exit_time, exp(sum(ln(" + _MULT + ")) OVER (PARTITION BY symbol ORDER BY exit_time "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS cum_m FROM ledger WHERE exit_reason <> 'OPEN'), "
       "cur AS (SELECT symbol, entry_time, entry_price, CASE WHEN exit_reason <> 'OPEN' THEN exit_time END AS x_t FROM ledger), "
       "eq0 AS (SELECT f.symbol, f.open_time, f.close, c.entry_time, c.entry_price, c.x_t FROM fl f "
       "ASOF LEFT JOIN cur c ON c.symbol = f.symbol AND f.open_time >= c.entry_time), "
       "eq1 AS (SELECT e.*, coalesce(m.cum_m, 1.0) AS p FROM eq0 e ASOF LEFT JOIN cl2 m "
       "ON m.symbol = e.symbol AND e.open_time >= m.exit_time), "
       f"eq AS (SELECT symbol, open_time, {tr.START_CASH!r} * p * CASE WHEN entry_time IS NOT NULL AND "
       f"(x_t IS NULL OR open_time < x_t) THEN close / entry_price / {1.0 + tr.FEE!r} ELSE 1.0 END AS equity FROM eq1), "
       "dd AS (SELECT symbol, arg_max(equity, open_time) AS final_equity, "
       "min(equity / mx - 1.0) AS max_drawdown FROM (SELECT *, max(equity) OVER (PARTITION BY symbol ORDER BY open_time "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mx FROM eq) GROUP BY symbol)")


@register("equity_drawdown", finish_sql(CALM_SQL + _EQ, "dd", ["symbol", "final_equity", "max_drawdown"], D))
def q_equity_drawdown(spark, sf):
    from tickframe.session import cut_lineage
    fl = cut_lineage(calm_flags(spark, sf))      # read by the ledger and by the curve: compute once
    return finish(tr.equity_drawdown(tr.equity_curve(fl, tr.trade_ledger(fl))), D)
