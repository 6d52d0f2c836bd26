"""Registered queries: paper-trading cycle over supplier bars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import dataset as ds
from tickframe.operators import features as feat
from tickframe.operators import positions as po
from tickframe.operators import signals as sg
from tickframe.plans.catalog import finish, finish_sql, register
from tickframe.plans.stub import STUB_SQL, stub_probability
from tickframe.plans.oracle_enrich import live_sql
from tickframe.plans.sqlkit import div
from tickframe.plans.trading_queries import symbol_universe
from tickframe.session import cut_lineage
from tickframe.schemas import BAR_COLS, LIVE_FEATURES
from tickframe.sources.fixtures import BARS_S_SQL, bars_s, table

K = ["symbol", "open_time"]
D = 6
THR = 0.49
CASH = 25.0          # wallet cash before the cycle (test parameter)
BUY_VALUE = 30.0     # each test position was bought for this much: the cash buys fewer symbols than there are candidates
NN_L = " AND ".join(f"{c} IS NOT NULL" for c in K + BAR_COLS + LIVE_FEATURES)
W = "PARTITION BY symbol ORDER BY open_time"

_LAST300 = (f"SELECT * FROM ({BARS_S_SQL}) "
            "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 300")
_BASE = live_sql(_LAST300, 250) + (
    f", comp AS (SELECT * FROM enl WHERE {NN_L}), "
    f"rocs AS (SELECT *, CASE WHEN row_number() OVER ({W}) >= 4 THEN "
    f"{div('close', f'lag(close, 2) OVER ({W})')} - 1.0 END AS roc FROM comp), "
    f"lat AS (SELECT *, {STUB_SQL} AS prob_buy FROM rocs "
    "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1), "
    "rawl AS (SELECT symbol, high AS raw_high, close AS raw_close FROM bars "
    "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1), "
    f"posn AS (SELECT b.symbol, b.close AS buy_price, {BUY_VALUE!r} / b.close AS qty, b.close AS peak_price, "
    "b.open_time AS buy_time FROM bars b JOIN supplier s ON 'S' || CAST(s.s_suppkey AS VARCHAR) = b.symbol "
    "WHERE s.s_acctbal < 0 QUALIFY row_number() OVER (PARTITION BY b.symbol ORDER BY b.open_time DESC) = 11), "
    "univ AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, CAST(s_suppkey AS INTEGER) AS pos FROM supplier), "
    "dec0 AS (SELECT p.symbol, p.buy_price, p.qty, coalesce(greatest(coalesce(p.peak_price, p.buy_price), r.raw_high), "
    "p.peak_price) AS peak_price, l.close, l.roc, l.prob_buy, r.raw_close FROM posn p LEFT JOIN lat l ON l.symbol = p.symbol "
    "LEFT JOIN rawl r ON r.symbol = p.symbol), "
    f"dec1 AS (SELECT *, CASE WHEN close IS NULL THEN NULL WHEN close <= buy_price * {1.0 - po.SL_PCT!r} THEN 'STOP_LOSS' "
    f"WHEN CAST(prob_buy >= {THR} AS INTEGER) = 0 THEN 'SIGNAL_OFF' "
    f"WHEN coalesce(roc >= {po.ROC_THRESH!r}, false) THEN (CASE WHEN close <= peak_price * {1.0 - po.TRAIL_PCT!r} "
    f"THEN 'TRAILING_ROCKET' END) WHEN close >= buy_price * {1.0 + po.TP_PCT!r} THEN 'TAKE_PROFIT' END AS exit_reason FROM dec0), "
    "dec AS (SELECT symbol, buy_price, qty, peak_price, close, roc, prob_buy, exit_reason, "
    "CASE WHEN exit_reason IS NOT NULL THEN raw_close END AS sell_price, "
    "CASE WHEN exit_reason IS NOT NULL THEN qty * raw_close END AS proceeds, "
    "CASE WHEN exit_reason IS NOT NULL THEN (raw_close / buy_price - 1.0) * 100.0 END AS pnl_pct FROM dec1), "
    f"cash AS (SELECT {CASH!r} + coalesce(sum(proceeds), 0.0) AS c FROM dec), "
    "kept AS (SELECT symbol, buy_price, qty, peak_price FROM dec WHERE exit_reason IS NULL), "
    f"cand AS (SELECT u.symbol, u.pos, l.prob_buy, l.close AS buy_price FROM univ u JOIN lat l ON l.symbol = u.symbol "
    f"WHERE l.prob_buy >= {THR} AND u.symbol NOT IN (SELECT symbol FROM kept)), "
    "nch AS (SELECT least(floor(c / 10.0), (SELECT count(*) FROM cand)) AS n, c FROM cash), "
    "alloc AS (SELECT ch.symbol, ch.buy_price, (nch.c / nch.n) / ch.buy_price AS qty, ch.buy_price AS peak_price, "
    "nch.c / nch.n AS value FROM (SELECT *, row_number() OVER (ORDER BY pos) AS rn FROM cand) ch, nch "
    "WHERE nch.c >= 10.0 AND ch.rn <= floor(nch.c / 10.0)), "
    "wal AS (SELECT k.*, (SELECT c FROM cash) - (SELECT coalesce(sum(value), 0.0) FROM alloc) AS cash_usdt FROM "
    "(SELECT * FROM kept UNION ALL SELECT symbol, buy_price, qty, peak_price FROM alloc) k)")


LAST = 300   # the cycle reads this many bars of a symbol


def recent(spark, sf):
    return ds.last_n_bars(bars_s(spark, sf), LAST)


def market(spark, sf, b=None):
    """(latest complete scored row with roc, latest raw bar) per symbol, from the recent bars ``b``."""
    b = recent(spark, sf) if b is None else b
    comp = feat.enrich_live(b, parts=None, longest=LAST)
    latest = sg.score(ds.latest_bar(po.rocket_roc(comp)), stub_probability)
    return latest, ds.latest_bar(b)


def positions(spark, sf, b=None):
    b = bars_s(spark, sf) if b is None else b
    held = table(spark, sf, "supplier").filter(F.col("s_acctbal") < 0).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"))
    w = Window.partitionBy("symbol").orderBy(F.col("open_time").desc())
    buy = (ds.last_n_bars(b, 11).join(held, "symbol").withColumn("_rn", F.row_number().over(w))
             .filter(F.col("_rn") == 11))
    return buy.select("symbol", F.col("close").alias("buy_price"), (F.lit(BUY_VALUE) / F.col("close")).alias("qty"),
                      F.col("close").alias("peak_price"), F.col("open_time").alias("buy_time"))


def decided(spark, sf):
    """(exit decisions, scored latest rows).  The recent bars and the scored rows are read by several branches of the
    plan: each is computed once."""
    b = cut_lineage(recent(spark, sf))
    latest, raw = market(spark, sf, b)
    latest = cut_lineage(latest.select("symbol", "close", "prob_buy", "roc"))
    return po.exit_decisions(positions(spark, sf, b).drop("buy_time"), latest, raw, THR), latest


def decisions(spark, sf):
    return decided(spark, sf)[0]


_DEC_COLS = ["symbol", "buy_price", "qty", "peak_price", "close", "roc", "prob_buy", "exit_reason",
             "sell_price", "proceeds", "pnl_pct"]


@register("exit_decisions", finish_sql(_BASE, "dec", _DEC_COLS, D, kinds={"exit_reason": "other"}))
def q_exit_decisions(spark, sf):
    return finish(decisions(spark, sf), D)


@register("cash_after_exits", finish_sql(_BASE + ", ce AS (SELECT c AS cash_usdt FROM cash)", "ce", ["cash_usdt"], D))
def q_cash_after_exits(spark, sf):
    return finish(po.cash_after_exits(decisions(spark, sf), CASH), D)


def _candidates(spark, sf, dec, latest):
    return po.buy_candidates(symbol_universe(spark, sf), po.kept_positions(dec), latest, THR)


@register("buy_candidates", finish_sql(_BASE, "cand", ["symbol", "pos", "prob_buy", "buy_price"], D,
                                       kinds={"pos": "int"}))
def q_buy_candidates(spark, sf):
    return finish(_candidates(spark, sf, *decided(spark, sf)), D)


def _cycle(spark, sf):
    dec, latest = decided(spark, sf)
    dec = cut_lineage(dec)                     # read by several branches of the plan: computed once
    cash = po.cash_after_exits(dec, CASH)      # one row, read inside the plan
    alloc = po.buy_allocation(cut_lineage(_candidates(spark, sf, dec, latest)), cash)
    return dec, cash, alloc


@register("buy_allocation", finish_sql(_BASE, "alloc", ["symbol", "buy_price", "qty", "peak_price", "value"], D))
def q_buy_allocation(spark, sf):
    return finish(_cycle(spark, sf)[2], D)


@register("wallet_after_cycle", finish_sql(_BASE, "wal", ["symbol", "buy_price", "qty", "peak_price", "cash_usdt"], D))
def q_wallet_after_cycle(spark, sf):
    dec, cash, alloc = _cycle(spark, sf)
    return finish(po.wallet_after_cycle(po.kept_positions(dec), alloc, cash), D)


@register("wallet_json", None)
def q_wallet_json(spark, sf):
    dec, cash, alloc = _cycle(spark, sf)
    wal = po.wallet_after_cycle(po.kept_positions(dec), alloc, cash)
    return po.wallet_json(wal, po.wallet_cash(alloc, cash))


@register("wallet_positions", finish_sql(_BASE, "posn", ["symbol", "buy_price", "qty", "peak_price"], D))
def q_wallet_positions(spark, sf):
    doc = po.wallet_json(positions(spark, sf), CASH)
    rows = po.wallet_positions(doc).filter(F.col("symbol").isNotNull())
    return finish(rows.select("symbol", "buy_price", "qty", "peak_price"), D)


_ROC_SQL = (live_sql(_LAST300, 250) + f", comp AS (SELECT * FROM enl WHERE {NN_L}), "
            f"rocs AS (SELECT symbol, open_time, CASE WHEN row_number() OVER ({W}) >= 4 THEN "
            f"{div('close', f'lag(close, 2) OVER ({W})')} - 1.0 END AS roc FROM comp)")


@register("rocket_roc", finish_sql(_ROC_SQL, "rocs", K + ["roc"], D))
def q_rocket_roc(spark, sf):
    comp = feat.enrich_live(recent(spark, sf), parts=None, longest=LAST)
    return finish(po.rocket_roc(comp).select(*K, "roc"), D)


_PEAK_SQL = (f"WITH bs AS ({BARS_S_SQL}), posn AS (SELECT b.symbol, b.close AS buy_price, b.open_time AS buy_time "
             "FROM bs b JOIN supplier s ON 'S' || CAST(s.s_suppkey AS VARCHAR) = b.symbol WHERE s.s_acctbal < 0 "
             "QUALIFY row_number() OVER (PARTITION BY b.symbol ORDER BY b.open_time DESC) = 11), "
             "pk AS (SELECT b.symbol, b.open_time, greatest(p.buy_price, max(b.high) OVER (PARTITION BY b.symbol "
             "ORDER BY b.open_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS peak_price "
             "FROM bs b JOIN posn p ON p.symbol = b.symbol WHERE b.open_time >= p.buy_time) "
             "SELECT symbol, open_time, (CASE WHEN abs(peak_price) < 1e14 THEN CAST(floor(peak_price * 1000000.0 + 0.5) "
             "AS DOUBLE) / 1000000.0 ELSE peak_price END) AS peak_price FROM pk")


@register("running_peak", _PEAK_SQL)
def q_running_peak(spark, sf):
    return finish(po.running_peak(bars_s(spark, sf), positions(spark, sf)), D)
