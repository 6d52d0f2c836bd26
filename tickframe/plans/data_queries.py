"""Registered queries: dataset selection, set operations, upsert, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import dataset as ds
from tickframe.operators import features as feat
from tickframe.operators.upsert import upsert
from tickframe.plans.catalog import DIGITS, finish, finish_sql, register
from tickframe.plans.oracle_enrich import live_sql, research_sql
from tickframe.plans.sqlkit import rnd
from tickframe.schemas import BAR_COLS, LIVE_FEATURES, MODEL_FEATURES, RESEARCH_FEATURES
from tickframe.sources.fixtures import BARS_D_SQL, BARS_H_SQL, BARS_S_SQL, bars_d, bars_h, bars_s, table

K = ["symbol", "open_time"]
D4, D6 = DIGITS["bars_d"], DIGITS["bars_h"]
ALL_R = BAR_COLS + RESEARCH_FEATURES
NOTNULL_R = " AND ".join(f"{c} IS NOT NULL" for c in K + ALL_R)


def _research_complete(spark, sf):
    return ds.drop_incomplete(feat.enrich_research(bars_d(spark, sf)))


@register("drop_incomplete", finish_sql(research_sql(BARS_D_SQL), "enr", K + ALL_R, D4, where=NOTNULL_R))
def q_drop_incomplete(spark, sf):
    return finish(_research_complete(spark, sf), D4)


_MAT = (f"mat AS (SELECT * FROM (SELECT *, min(open_time) OVER (PARTITION BY symbol) AS first_t "
        f"FROM enr WHERE {NOTNULL_R}) WHERE open_time >= first_t + INTERVAL 90 DAY)")
_MAT_COLS = K + ["close", "target"]


@register("maturation", finish_sql(research_sql(BARS_D_SQL) + ", " + _MAT, "mat", _MAT_COLS, D4))
def q_maturation(spark, sf):
    return finish(ds.maturation(_research_complete(spark, sf)).select(*_MAT_COLS), D4)


@register("date_range", finish_sql(research_sql(BARS_D_SQL) + ", " + _MAT, "mat", _MAT_COLS, D4,
                                   where="open_time >= TIMESTAMP '1996-01-01' AND open_time <= TIMESTAMP '1997-12-31'"))
def q_date_range(spark, sf):
    df = ds.date_range(ds.maturation(_research_complete(spark, sf)), "1996-01-01", "1997-12-31")
    return finish(df.select(*_MAT_COLS), D4)


_SPLIT = ("split AS (SELECT symbol, open_time, CAST(row_number() OVER (ORDER BY open_time, symbol) "
          f"<= floor(0.8 * count(*) OVER ()) AS INTEGER) AS is_train FROM enr WHERE {NOTNULL_R})")


@register("chrono_split", finish_sql(research_sql(BARS_D_SQL) + ", " + _SPLIT, "split",
                                     K + ["is_train"], D4, kinds={"is_train": "int"}))
def q_chrono_split(spark, sf):
    return ds.chrono_split(_research_complete(spark, sf).select(*K)).select(*K, F.col("is_train").cast("int"))


_TRAIN_COLS = K + MODEL_FEATURES + ["target"]


@register("train_scan", finish_sql(research_sql(BARS_D_SQL), "enr", _TRAIN_COLS, D4,
                                   where=" AND ".join(f"{c} IS NOT NULL" for c in _TRAIN_COLS)))
def q_train_scan(spark, sf):
    wanted = _TRAIN_COLS + ["quote_volume"]          # absent columns are skipped
    df = ds.select_present(feat.enrich_research(bars_d(spark, sf)), wanted)
    return finish(ds.drop_incomplete(df), D4)


_UNION_COLS = ["rsi_14", "adx", "dist_sma_norm_by_atr", "target", "tr"]


def _union_sql():
    r = (f"(WITH RECURSIVE {research_sql(BARS_H_SQL, 0)} SELECT symbol, open_time, 'research' AS dialect, "
         f"rsi_14, adx, dist_sma_norm_by_atr, target, CAST(NULL AS DOUBLE) AS tr FROM enr)")
    l_ = (f"(WITH RECURSIVE {live_sql(BARS_H_SQL, 0)} SELECT symbol, open_time, 'live' AS dialect, "
          f"rsi_14, adx, dist_sma_norm_by_atr, CAST(NULL AS INTEGER) AS target, tr FROM enl)")
    body = f"u AS ({r} UNION ALL {l_})"
    return finish_sql(body, "u", K + ["dialect"] + _UNION_COLS, D6, kinds={"dialect": "other"}, recursive=False)


@register("union_dialects", _union_sql())
def q_union_dialects(spark, sf):
    b = bars_h(spark, sf)
    r = feat.enrich_research(b, min_bars=0).select(*K, F.lit("research").alias("dialect"),
                                                  "rsi_14", "adx", "dist_sma_norm_by_atr", "target")
    l_ = feat.enrich_live_all(b, min_bars=0).select(*K, F.lit("live").alias("dialect"),
                                                   "rsi_14", "adx", "dist_sma_norm_by_atr", "tr")
    return finish(ds.union_by_name([r, l_]), D6, K + ["dialect"] + _UNION_COLS)


_DEDUP_SQL = (f"WITH bars AS ({BARS_H_SQL}), pages AS ("
              "SELECT *, 0 AS page FROM bars WHERE open_time < TIMESTAMP '2024-01-20' UNION ALL "
              "SELECT symbol, open_time, open, high, low, close + 1.0 AS close, volume, 1 AS page FROM bars "
              "WHERE open_time >= TIMESTAMP '2024-01-15'), "
              "d AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY symbol, open_time ORDER BY page) = 1) "
              f"SELECT symbol, open_time, {', '.join(rnd(c, D6) + ' AS ' + c for c in BAR_COLS)} FROM d")


@register("dedup_bars", _DEDUP_SQL)
def q_dedup_bars(spark, sf):
    b = bars_h(spark, sf)
    p0 = b.filter(F.col("open_time") < F.lit("2024-01-20").cast("timestamp_ntz"))
    p1 = (b.filter(F.col("open_time") >= F.lit("2024-01-15").cast("timestamp_ntz"))
           .withColumn("close", F.col("close") + F.lit(1.0)))
    return finish(ds.dedup_bars([p0, p1]), D6)


def _bars_q(src_sql, tail, digits):
    return (f"WITH bars AS ({src_sql}) SELECT symbol, open_time, "
            f"{', '.join(rnd(c, digits) + ' AS ' + c for c in BAR_COLS)} FROM bars {tail}")


@register("latest_bar", _bars_q(BARS_H_SQL, "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1", D6))
def q_latest_bar(spark, sf):
    return finish(ds.latest_bar(bars_h(spark, sf)), D6, K + BAR_COLS)


@register("last_n_bars", _bars_q(BARS_H_SQL, "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 300", D6))
def q_last_n_bars(spark, sf):
    return finish(ds.last_n_bars(bars_h(spark, sf), 300), D6, K + BAR_COLS)


@register("min_history", _bars_q(BARS_H_SQL, "QUALIFY count(*) OVER (PARTITION BY symbol) >= 250", D6))
def q_min_history(spark, sf):
    return finish(feat.min_history(bars_h(spark, sf), 250), D6, K + BAR_COLS)


_FIRSTN_SQL = (f"WITH bars AS ({BARS_S_SQL}), syms AS (SELECT DISTINCT symbol FROM bars ORDER BY symbol LIMIT 690) "
               f"SELECT symbol, open_time, {rnd('close', D4)} AS close FROM bars WHERE symbol IN (SELECT symbol FROM syms)")


@register("first_n_symbols", _FIRSTN_SQL)
def q_first_n_symbols(spark, sf):
    return finish(ds.first_n_symbols(bars_s(spark, sf), 690).select(*K, "close"), D4)


def _universe(spark, sf):
    """The suppliers' symbols, and as many that have no bars."""
    key = F.col("s_suppkey").cast("string")
    s = table(spark, sf, "supplier")
    return s.select(F.concat(F.lit("S"), key).alias("symbol")).union(s.select(F.concat(F.lit("X"), key)))


_UNIV_SQL = ("SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol FROM supplier "
             "UNION ALL SELECT 'X' || CAST(s_suppkey AS VARCHAR) FROM supplier")
#: Of every fifth supplier the bars up to here only: fewer than the least history.
_FEW, _FEW_SQL = "1993-01-01", "CAST(substr(symbol, 2) AS INTEGER) % 5 <> 1 OR open_time < TIMESTAMP '1993-01-01'"


def _some_short(spark, sf):
    short = F.substring("symbol", 2, 9).cast("int") % 5 == 1
    return bars_s(spark, sf).filter(~short | (F.col("open_time") < F.lit(_FEW).cast("timestamp_ntz")))


@register("available_symbols", f"WITH bars AS ({BARS_S_SQL}), u AS ({_UNIV_SQL}) "
                               "SELECT symbol FROM u WHERE symbol IN (SELECT symbol FROM bars)")
def q_available_symbols(spark, sf):
    return ds.available_symbols(_universe(spark, sf), bars_s(spark, sf))


@register("ingest_audit", f"WITH bars AS (SELECT * FROM ({BARS_S_SQL}) WHERE {_FEW_SQL}), u AS (SELECT DISTINCT symbol FROM ({_UNIV_SQL})), "
                          "c AS (SELECT symbol, count(*) AS n_bars FROM bars GROUP BY symbol), "
                          "p AS (SELECT u.symbol, c.n_bars FROM u LEFT JOIN c ON c.symbol = u.symbol) "
                          "SELECT count(*) AS total, count(*) FILTER (WHERE n_bars >= 250) AS processed, "
                          "count(*) FILTER (WHERE n_bars IS NULL) AS missing, "
                          "count(*) FILTER (WHERE n_bars < 250) AS too_few FROM p")
def q_ingest_audit(spark, sf):
    return ds.ingest_audit(_universe(spark, sf), _some_short(spark, sf), 250)


# ---- upsert: existing bars (flat-bar volume unknown) + live update of the last 600 bars

_LAST600 = (f"SELECT * FROM ({BARS_S_SQL}) "
            "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 600")
_UPD_COLS = BAR_COLS + LIVE_FEATURES


def _upsert_sql():
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in K + _UPD_COLS)
    upd = (f"(WITH RECURSIVE {live_sql(_LAST600, 0)} SELECT * FROM enl WHERE {notnull})")
    old = (f"(SELECT symbol, open_time, open, high, low, close, "
           f"CASE WHEN high = low THEN NULL ELSE volume END AS volume FROM ({BARS_S_SQL}) "
           "WHERE open_time < TIMESTAMP '1998-01-01')")
    merged = ", ".join([f"coalesce(n.{c}, o.{c}) AS {c}" for c in BAR_COLS]
                       + [f"n.{c} AS {c}" for c in LIVE_FEATURES])
    body = (f"up AS (SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.open_time, o.open_time) AS open_time, "
            f"{merged} FROM {old} o FULL OUTER JOIN {upd} n ON n.symbol = o.symbol AND n.open_time = o.open_time)")
    return finish_sql(body, "up", K + _UPD_COLS, D4, kinds={"volume_spike": "int"}, recursive=False)


def upsert_inputs(spark, sf):
    """Both hash-partitioned by symbol and read from one exchange of the bars: the condition of ``old`` counts as
    non-deterministic, so it is not moved below that exchange."""
    b = bars_s(spark, sf, combine=False).repartition("symbol")
    before = F.col("open_time") < F.lit("1998-01-01").cast("timestamp_ntz")
    old = (b.filter(F.when(F.spark_partition_id() >= 0, before))
            .withColumn("volume", F.when(F.col("high") != F.col("low"), F.col("volume"))))
    new = feat.enrich_live(ds.last_n_bars(b, 600), min_bars=None, parts=None, longest=600)
    return old, new


@register("upsert_bars", _upsert_sql())
def q_upsert_bars(spark, sf):
    old, new = upsert_inputs(spark, sf)
    return finish(upsert(old, new, in_place=True), D4, K + _UPD_COLS)
