"""Registered queries: streaming jobs (run to completion with availableNow) and ML."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import dataset as ds
from tickframe.operators import features as feat
from tickframe.operators import ml
from tickframe.operators import positions as po
from tickframe.operators import signals as sg
from tickframe.plans import position_queries as pq
from tickframe.plans.catalog import DIGITS, finish, finish_sql, register
from tickframe.plans.source_queries import kline_payloads
from tickframe.plans.oracle_enrich import live_sql
from tickframe.plans.sqlkit import rnd
from tickframe.plans.stub import STUB_SQL, stub_probability
from tickframe.schemas import BAR_COLS, LIVE_FEATURES, MODEL_FEATURES
from tickframe.session import checkpoint_dir, cut_lineage
from tickframe.sources.fixtures import BARS_H_SQL, bars_d, bars_h
from tickframe.streaming import bars as st
from tickframe.streaming.store import BarStore

K = ["symbol", "open_time"]
D6 = DIGITS["bars_h"]


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _day(text):
    return F.lit(text).cast("date")


#: Landed pages: days up to 2024-01-20 without the first week, days from 2024-01-15 on (re-sent overlap), one re-sent
#: day, and the first week as a back-fill.
PAGES = [lambda d: (d > _day("2024-01-07")) & (d <= _day("2024-01-20")), lambda d: d >= _day("2024-01-15"),
         lambda d: d == _day("2024-01-18"), lambda d: d <= _day("2024-01-07")]


def _land_payloads(spark, sf, landing, pages):
    p = kline_payloads(spark, sf).filter(F.col("d").isNotNull())
    for page in pages:
        p.filter(page(F.col("d"))).select("symbol", "payload").write.mode("append").json(landing)


_BARS_H_OUT = (f"WITH bars AS ({BARS_H_SQL}) SELECT symbol, open_time, "
               + ", ".join(f"{rnd(c, D6)} AS {c}" for c in BAR_COLS) + " FROM bars")


@register("stream_dedup", _BARS_H_OUT)
def q_stream_dedup(spark, sf):
    """Two runs over the landed pages; the back-fill of the second is older than the keyed state."""
    landing, out = _scratch(spark, "landing"), _scratch(spark, "dedup")
    _land_payloads(spark, sf, landing, PAGES[:3])
    st.stream_dedup(spark, landing, out, keep_days=2)
    _land_payloads(spark, sf, landing, PAGES[2:])
    return finish(st.stream_dedup(spark, landing, out, keep_days=2).select(*K, *BAR_COLS), D6)


@register("stream_upsert", finish_sql(live_sql(BARS_H_SQL, 0), "enl", K + BAR_COLS + LIVE_FEATURES, D6, kinds={"volume_spike": "int"}))
def q_stream_upsert(spark, sf):
    """Pages land in two runs, the second a back-fill of the first week; the stored, enriched table is read again."""
    landing = _scratch(spark, "landing")
    store = BarStore(spark, _scratch(spark, "store"), period="week", slices=4)
    store.update(bars_h(spark, sf).filter((F.col("open_time") >= F.lit("2024-01-08").cast("timestamp_ntz"))
                                          & (F.col("open_time") < F.lit("2024-01-18").cast("timestamp_ntz"))))
    for pages in (PAGES[1:3], [PAGES[0], PAGES[3]]):
        _land_payloads(spark, sf, landing, pages)
        st.stream_update(spark, landing, store)
    return finish(store.read(), D6)


# ---- streaming position monitor ---------------------------------------------

def exit_feed(spark, sf):
    """Scored complete bars of held symbols after their purchase bar."""
    comp = feat.enrich_live(pq.recent(spark, sf), parts=None, longest=pq.LAST)
    scored = sg.score(po.rocket_roc(comp), stub_probability)
    pos = pq.positions(spark, sf)
    feed = scored.join(pos, "symbol").filter(F.col("open_time") > F.col("buy_time"))
    return feed.select("symbol", "open_time", "close", "high", "prob_buy", "roc", "buy_time", "buy_price", "qty", "peak_price")


_EXIT_SQL = (pq._BASE.replace("WITH RECURSIVE ", "") + ", "
             "feed0 AS (SELECT r.symbol, r.open_time, r.close, r.high, "
             f"{STUB_SQL} AS prob_buy, r.roc, p.buy_price, p.qty, p.peak_price FROM rocs r JOIN posn p "
             "ON p.symbol = r.symbol WHERE r.open_time > p.buy_time), "
             "feed AS (SELECT *, greatest(peak_price, max(high) OVER (PARTITION BY symbol ORDER BY open_time "
             "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS peak FROM feed0), "
             f"rs AS (SELECT *, CASE WHEN close <= buy_price * {1.0 - po.SL_PCT!r} THEN 'STOP_LOSS' "
             "WHEN prob_buy < 0.49 THEN 'SIGNAL_OFF' "
             f"WHEN roc >= {po.ROC_THRESH!r} THEN (CASE WHEN close <= peak * {1.0 - po.TRAIL_PCT!r} THEN 'TRAILING_ROCKET' END) "
             f"WHEN close >= buy_price * {1.0 + po.TP_PCT!r} THEN 'TAKE_PROFIT' END AS exit_reason FROM feed), "
             "fx AS (SELECT symbol, buy_price, qty, peak AS peak_price, open_time AS exit_time, close, exit_reason "
             "FROM rs WHERE exit_reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time) = 1)")


@register("stream_exits", finish_sql(_EXIT_SQL, "fx", ["symbol", "buy_price", "qty", "peak_price", "exit_time",
                                                       "close", "exit_reason"], 6,
                                     kinds={"exit_time": "other", "exit_reason": "other"}))
def q_stream_exits(spark, sf):
    feed = exit_feed(spark, sf)
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy("open_time"))
    feed = feed.withColumn("_r", rank).persist()
    landing = _scratch(spark, "exit-feed")
    for lo, hi in ((1, 4), (5, 7), (8, 1 << 30)):      # three landed files, in time order
        (feed.filter((F.col("_r") >= lo) & (F.col("_r") <= hi)).drop("_r")
             .coalesce(1).write.mode("append").parquet(landing))
    out = st.stream_exits(spark, landing, _scratch(spark, "exits"))
    return finish(out, 6)


# ---- model training (rows-only check) ---------------------------------------

@register("train_gbt", None)
def q_train_gbt(spark, sf):
    """Chronological 80/20 split of the complete research rows, Spark ML GBT
    with the reference hyper-parameters (650 boosting rounds, each a few Spark
    jobs), scored on the test rows."""
    df = cut_lineage(ds.drop_incomplete(feat.enrich_research(bars_d(spark, sf))))   # read by the split, the training and the test
    split = ds.chrono_split(df)
    model = ml.train_gbt(split.filter(F.col("is_train") == 1), MODEL_FEATURES, "target")
    test = split.filter(F.col("is_train") == 0)
    scored = sg.signal_flag(sg.score(test, model), 0.49, out="pred")
    return scored.select(*K, F.col("target").cast("int"), "prob_buy", F.col("pred").cast("int"))
