"""Registered queries: file layouts, stored tables, look-ups and counters that write and read again."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import functions as F

from tickframe.operators import dataset as ds
from tickframe.operators import features as feat
from tickframe.operators import signals as sg
from tickframe.operators import wallets as wl
from tickframe.operators.tree_scorer import Ensemble, probability, probability_sql
from tickframe.plans import position_queries as pq
from tickframe.plans import trading_queries as tq
from tickframe.plans.catalog import DIGITS, finish, finish_sql, register
from tickframe.plans.oracle_enrich import live_sql, research_sql
from tickframe.plans.sqlkit import rnd
from tickframe.plans.stub import stub_probability
from tickframe.schemas import BAR_COLS
from tickframe.session import checkpoint_dir
from tickframe.sources import files
from tickframe.sources.fixtures import BARS_D_SQL, BARS_H_SQL, BARS_S_SQL, bars_d, bars_h, bars_s

K = ["symbol", "open_time"]
D4, D6 = DIGITS["bars_s"], DIGITS["bars_h"]


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _bars_sql(bars, digits, more=""):
    return f"WITH bars AS ({bars}) SELECT symbol, open_time, " + ", ".join(f"{rnd(c, digits)} AS {c}" for c in BAR_COLS) + f"{more} FROM bars"


# ---- files --------------------------------------------------------------------

@register("scan_symbol_files", _bars_sql(BARS_H_SQL, D6))
def q_scan_symbol_files(spark, sf):
    """Legacy files, one CSV per symbol; the symbol comes from the file name."""
    folder = _scratch(spark, "symbol-files")
    files.write_symbol_files(bars_h(spark, sf), folder)
    return finish(files.scan_bars_csv(spark, f"{folder}/*_4h.csv"), D6)


_WANTED = ["close", "volume", "rsi_14", "macd", "di_plus"]
_KIND = "length(symbol) % 3"


@register("scan_mixed_files", finish_sql(
    live_sql(BARS_H_SQL, 0) + f", mx AS (SELECT symbol, open_time, close, CASE WHEN {_KIND} <> 1 THEN volume END AS volume, "
    f"CASE WHEN {_KIND} = 1 THEN rsi_14 END AS rsi_14, CASE WHEN {_KIND} = 2 THEN macd END AS macd, CAST(NULL AS DOUBLE) AS di_plus FROM enl)",
    "mx", K + _WANTED, D6))
def q_scan_mixed_files(spark, sf):
    """Per-symbol files with three column sets, scanned by header; one wanted column is in no file."""
    folder = _scratch(spark, "mixed-files")
    e = feat.enrich_live_all(bars_h(spark, sf), min_bars=None)
    for kind, columns in enumerate((BAR_COLS, ["close", "rsi_14", "high"], ["macd", "open", "volume", "close", "sma_200"])):
        files.write_symbol_files(e.filter(F.expr(f"{_KIND} = {kind}")).select(*K, *columns), folder)
    return finish(files.scan_by_header(spark, f"{folder}/*_4h.csv", _WANTED), D6)


@register("bar_file_order", f"WITH bars AS ({BARS_S_SQL}) SELECT symbol, open_time, {rnd('close', D4)} AS close, "
                            "row_number() OVER (ORDER BY symbol, open_time) - 1 AS pos FROM bars")
def q_bar_file_order(spark, sf):
    """The range-partitioned sink read back in file order, with files of few rows."""
    path = _scratch(spark, "bar-files")
    files.write_bars(bars_s(spark, sf), path, by_symbol=False, file_rows=5_000)
    return finish(files.in_file_order(spark, path), D4, [*K, "close", "pos"])


# ---- look-up of one symbol ------------------------------------------------------

@register("consult_lookup", finish_sql(tq.L_LATEST + tq._CONSULT_SQL, "con", tq._CONSULT_COLS, tq.D, kinds={"signal": "other", "trend": "other"}))
def q_consult_lookup(spark, sf):
    """One symbol's opinion from a bucketed bar table: the scan reads one bucket."""
    name = f"bars_{uuid.uuid4().hex}"
    files.write_bucketed(bars_s(spark, sf), name, _scratch(spark, name), 16)
    return finish(sg.lookup(spark.table(name), "s7", stub_probability, tq.THR), tq.D)


# ---- trained model as an expression ---------------------------------------------

def ensemble() -> Ensemble:
    """Twelve boosting rounds of ``ml.train_gbt``, trained on the complete research rows of the daily bars."""
    with open(os.path.join(os.path.dirname(__file__), "trained_ensemble.json")) as f:
        return Ensemble.from_dict(json.load(f))


@register("score_ensemble", finish_sql(
    research_sql(BARS_D_SQL) + f", sc0 AS (SELECT *, {probability_sql(ensemble())} AS prob_buy FROM enr), "
    f"sc AS (SELECT *, CAST(prob_buy >= {tq.THR} AS INTEGER) AS signal FROM sc0 WHERE prob_buy IS NOT NULL)",
    "sc", K + ["prob_buy", "signal"], tq.D))
def q_score_ensemble(spark, sf):
    """All research rows scored by the trained ensemble; rows with a NULL feature (warm-up) are skipped."""
    scored = sg.score(feat.enrich_research(bars_d(spark, sf), min_bars=None), probability(ensemble()))
    return finish(sg.signal_flag(scored, tq.THR), tq.D, K + ["prob_buy", "signal"])


# ---- counters -------------------------------------------------------------------

_CUT = "TIMESTAMP '1998-01-01'"
_UPDATES = (f"WITH bars AS ({BARS_S_SQL}), u AS (SELECT DISTINCT symbol FROM (SELECT symbol FROM bars UNION ALL SELECT 'X' || symbol FROM bars)), "
            "k AS (SELECT *, CAST(substr(symbol, 2) AS INTEGER) % 5 AS g FROM bars), "
            f"old AS (SELECT symbol, count(*) AS n FROM k WHERE open_time < {_CUT} AND g <> 1 GROUP BY symbol), "
            f"new AS (SELECT symbol, count(*) AS n FROM k WHERE open_time >= {_CUT} AND g <> 2 GROUP BY symbol), "
            "p AS (SELECT u.symbol, old.n AS o, new.n AS r FROM u LEFT JOIN old ON old.symbol = u.symbol LEFT JOIN new ON new.symbol = u.symbol) "
            "SELECT count(*) AS total, count(*) FILTER (WHERE r > 0) AS updated, count(*) FILTER (WHERE r IS NULL) AS skipped, "
            "count(*) FILTER (WHERE r > 0 AND o IS NULL) AS new, count(*) FILTER (WHERE r > 0 AND coalesce(o, 0) + r < 250) AS too_few, "
            f"(SELECT count(*) FROM k WHERE open_time >= {_CUT} AND g <> 2) AS written FROM p")


@register("update_counters", _UPDATES)
def q_update_counters(spark, sf):
    """Recent bars of a universe are written and counted in the same job: symbols without recent bars are skipped, some
    are new, some have too few bars, and half of the universe has no bars at all."""
    b = bars_s(spark, sf).withColumn("g", F.substring("symbol", 2, 9).cast("int") % 5)
    late = F.col("open_time") >= F.lit("1998-01-01").cast("timestamp_ntz")
    universe = b.select("symbol").union(b.select(F.concat(F.lit("X"), "symbol")))
    path = _scratch(spark, "updates")
    n = ds.update_counted(universe, b.filter(~late & (F.col("g") != 1)), b.filter(late & (F.col("g") != 2)).drop("g"),
                          lambda rows: rows.write.parquet(path))
    return spark.read.parquet(path).agg(*[F.lit(n[c]).cast("long").alias(c) for c in ("total", "updated", "skipped", "new", "too_few")],
                                        F.count("*").alias("written"))


# ---- wallets --------------------------------------------------------------------

_WALLET_COLS = ["wallet_id", "written", "cash_usdt", "symbol", "buy_price", "qty", "peak_price"]
_WID = "CAST(substr(symbol, 2) AS INTEGER) % 7"
_WALLETS = (pq._BASE + f", w0 AS (SELECT CAST({_WID} AS BIGINT) AS wallet_id, * FROM posn), "
            "w1 AS (SELECT wallet_id, CASE WHEN wallet_id < 3 THEN 2 ELSE 1 END AS written, 100.0 * wallet_id AS cash_usdt, symbol, buy_price, "
            "CASE WHEN wallet_id < 3 THEN qty * 2.0 ELSE qty END AS qty, peak_price FROM w0 "
            "UNION ALL SELECT 99, 1, 5.0, NULL, NULL, NULL, NULL)")


@register("wallet_sink", finish_sql(_WALLETS, "w1", _WALLET_COLS, 6, kinds={"wallet_id": "other", "written": "int", "symbol": "other"}))
def q_wallet_sink(spark, sf):
    """Wallets saved three times: all, then with three of them changed, then as stored but in another order (which
    writes nothing).  The stored documents are parsed back."""
    path = _scratch(spark, "wallets")
    held = pq.positions(spark, sf).select(F.expr(_WID).cast("long").alias("wallet_id"), "symbol", "buy_price", "qty", "peak_price")
    empty = spark.range(1).select(F.lit(99).cast("long").alias("wallet_id"), F.lit(5.0).alias("cash_usdt"), F.lit(None).cast("string").alias("symbol"),
                                  *[F.lit(None).cast("double").alias(c) for c in ("buy_price", "qty", "peak_price")])
    first = held.withColumn("cash_usdt", F.lit(100.0) * F.col("wallet_id")).unionByName(empty)
    wl.save_wallets(first, path)
    second = first.withColumn("qty", F.when(F.col("wallet_id") < 3, F.col("qty") * 2).otherwise(F.col("qty")))
    version = wl.save_wallets(second, path)
    if wl.save_wallets(wl.read_wallets(spark, path).orderBy(F.desc("qty")), path) != version:
        raise RuntimeError("unchanged wallets were written")
    stored = wl.read_wallets(spark, path)
    docs = wl.wallet_documents(stored)
    rows = pq.po.wallet_positions(docs, keep=("wallet_id",))
    return finish(rows.join(stored.select("wallet_id", "written").distinct(), "wallet_id"), 6, _WALLET_COLS)
