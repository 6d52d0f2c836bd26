"""Registered queries: rolling / EWM / indicator / feature / enrichment operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions import windows as wf
from tickframe.operators import features as feat
from tickframe.operators import indicators as ind
from tickframe.operators.ewm import ewm, with_ewm
from tickframe.operators.parts import ENRICH, with_ewm_parts
from tickframe.plans.catalog import DIGITS, finish, finish_sql, register
from tickframe.plans.oracle_enrich import live_sql, research_sql
from tickframe.plans.sqlkit import W, ewm_recursive, full, lag, rnd
from tickframe.schemas import BAR_COLS, LIVE_FEATURES, RESEARCH_FEATURES
from tickframe.sources.fixtures import BARS_D_SQL, BARS_H_SQL, bars_d, bars_h

K = ["symbol", "open_time"]
D4, D6 = DIGITS["bars_d"], DIGITS["bars_h"]
SHORT_PARTS = wf.Parts(rows=300, back=ENRICH.back, fwd=ENRICH.fwd)


def _research_q(name, cols, fixture="bars_d", min_bars=0):
    bars_sql = BARS_D_SQL if fixture == "bars_d" else BARS_H_SQL
    digits = D4 if fixture == "bars_d" else D6
    return finish_sql(research_sql(bars_sql, min_bars), "enr", K + cols, digits)


def _live_q(cols, fixture="bars_d", min_bars=0, fill_flat=True, where=""):
    bars_sql = BARS_D_SQL if fixture == "bars_d" else BARS_H_SQL
    digits = D4 if fixture == "bars_d" else D6
    return finish_sql(live_sql(bars_sql, min_bars, fill_flat), "enl", K + cols, digits,
                      kinds={"volume_spike": "int"}, where=where)


# ---- flagship -------------------------------------------------------------

@register("enrich_research", _research_q(None, BAR_COLS + RESEARCH_FEATURES, min_bars=250))
def q_enrich_research(spark, sf):
    return finish(feat.enrich_research(bars_d(spark, sf)), D4)


@register("enrich_research_blocked", _research_q(None, BAR_COLS + RESEARCH_FEATURES, min_bars=250))
def q_enrich_research_blocked(spark, sf):
    """The flagship in parts so short that every series has several: seeds and copies are at work."""
    return finish(feat.enrich_research(bars_d(spark, sf), parts=SHORT_PARTS), D4)


@register("enrich_live_blocked", _live_q(LIVE_FEATURES, min_bars=0))
def q_enrich_live_blocked(spark, sf):
    return finish(feat.enrich_live_all(bars_d(spark, sf), min_bars=0, parts=SHORT_PARTS), D4).select(*K, *LIVE_FEATURES)


# ---- rolling and lag ------------------------------------------------------

_ROLL_SQL = ("WITH bars AS (" + BARS_D_SQL + ") SELECT symbol, open_time, "
             f"{rnd(full('min', 'low', 14), 4)} AS low_min_14, "
             f"{rnd(full('max', 'high', 14), 4)} AS high_max_14, "
             f"{rnd(full('avg', 'close', 3), 4)} AS close_mean_3, "
             f"{rnd(full('avg', 'close', 20), 4)} AS close_mean_20, "
             f"{rnd(full('avg', 'volume', 30), 4)} AS volume_mean_30, "
             f"{rnd(full('sum', 'volume', 20), 4)} AS volume_sum_20, "
             f"{rnd(full('stddev_samp', 'close', 20), 4)} AS close_std_20 FROM bars")


@register("rolling_stats", _ROLL_SQL)
def q_rolling_stats(spark, sf):
    b = wf.positioned(bars_d(spark, sf).repartition("symbol"))
    return finish(b.select(*K, wf.rolling_min("low", 14).alias("low_min_14"),
                           wf.rolling_max("high", 14).alias("high_max_14"),
                           wf.rolling_mean("close", 3).alias("close_mean_3"),
                           wf.rolling_mean("close", 20).alias("close_mean_20"),
                           wf.rolling_mean("volume", 30).alias("volume_mean_30"),
                           wf.rolling_sum("volume", 20).alias("volume_sum_20"),
                           wf.rolling_std("close", 20).alias("close_std_20")), D4)


_LAG_SQL = ("WITH bars AS (" + BARS_D_SQL + ") SELECT symbol, open_time, "
            f"{rnd(lag('close'), 4)} AS close_lag_1, {rnd('close - ' + lag('close'), 4)} AS close_diff_1, "
            f"{rnd('close - ' + lag('close', 3), 4)} AS close_diff_3, "
            f"{rnd(f'lead(close, 5) OVER ({W})', 4)} AS close_lead_5 FROM bars")


@register("lag_diff", _LAG_SQL)
def q_lag_diff(spark, sf):
    b = wf.positioned(bars_d(spark, sf).repartition("symbol"))
    return finish(b.select(*K, wf.lag("close").alias("close_lag_1"), wf.diff("close").alias("close_diff_1"),
                           wf.diff("close", 3).alias("close_diff_3"),
                           wf.lead("close", 5).alias("close_lead_5")), D4)


@register("sma", _research_q(None, ["sma_200"]))
def q_sma(spark, sf):
    return finish(ind.sma(bars_d(spark, sf).repartition("symbol"), 200).select(*K, "sma_200"), D4)


@register("bollinger", _research_q(None, ["bb_mid", "bb_upper", "bb_lower"]))
def q_bollinger(spark, sf):
    return finish(ind.bollinger(bars_d(spark, sf).repartition("symbol"))
                  .select(*K, "bb_mid", "bb_upper", "bb_lower"), D4)


@register("stochastic", _research_q(None, ["stoch_k", "stoch_d"]))
def q_stochastic(spark, sf):
    return finish(ind.stochastic(bars_d(spark, sf).repartition("symbol")).select(*K, "stoch_k", "stoch_d"), D4)


# ---- EWM ------------------------------------------------------------------

def _ewm_sql(specs):
    body = ("bars AS (" + BARS_D_SQL + "), "
            f"b AS (SELECT symbol, open_time, close, row_number() OVER ({W}) - 1 AS i FROM bars), "
            + ewm_recursive("e", "b", specs, keep=["open_time"]))
    return finish_sql(body, "e", K + [s[1] for s in specs], D4)


_EWM_ADJ = [("close", "ewm_com13", 1 / 14, True, 14), ("close", "ewm_span9", 0.2, True, 0)]
_EWM_REC = [("close", "ema_9", 0.2, False, 0), ("close", "ema_12", 2 / 13, False, 0),
            ("close", "ema_26", 2 / 27, False, 0), ("close", "ewm_a14", 1 / 14, False, 14)]


@register("ewm_adjusted", _ewm_sql(_EWM_ADJ))
def q_ewm_adjusted(spark, sf):
    b = bars_d(spark, sf).repartition("symbol")
    df = with_ewm(b, [ewm("close", "ewm_com13", com=13, adjust=True, min_periods=14),
                      ewm("close", "ewm_span9", span=9, adjust=True)])
    return finish(df.select(*K, "ewm_com13", "ewm_span9"), D4)


@register("ewm_recursive", _ewm_sql(_EWM_REC))
def q_ewm_recursive(spark, sf):
    b = bars_d(spark, sf).repartition("symbol")
    df = with_ewm(b, [ewm("close", "ema_9", span=9, adjust=False), ewm("close", "ema_12", span=12, adjust=False),
                      ewm("close", "ema_26", span=26, adjust=False),
                      ewm("close", "ewm_a14", alpha=1 / 14, adjust=False, min_periods=14)])
    return finish(df.select(*K, "ema_9", "ema_12", "ema_26", "ewm_a14"), D4)


_EWM_PERIODS = [("close", "ema_50", 2 / 51, False, 0), ("close", "wilder_28", 1 / 28, False, 28),
                ("close", "ewm_com20", 1 / 21, True, 21), ("close", "ema_fast", 0.9, False, 0)]


@register("ewm_periods", _ewm_sql(_EWM_PERIODS))
def q_ewm_periods(spark, sf):
    """Slow and fast decays, which need longer and shorter blocks than the default."""
    b = bars_d(spark, sf).repartition("symbol")
    df = with_ewm(b, [ewm("close", "ema_50", span=50, adjust=False),
                      ewm("close", "wilder_28", alpha=1 / 28, adjust=False, min_periods=28),
                      ewm("close", "ewm_com20", com=20, adjust=True, min_periods=21),
                      ewm("close", "ema_fast", alpha=0.9, adjust=False)])
    return finish(df.select(*K, *[s[1] for s in _EWM_PERIODS]), D4)


@register("rsi", _research_q(None, ["rsi_14"]))
def q_rsi(spark, sf):
    return finish(ind.rsi(bars_d(spark, sf).repartition("symbol")).select(*K, "rsi_14"), D4)


@register("macd", _research_q(None, ["macd", "macd_signal", "macd_hist"]))
def q_macd(spark, sf):
    return finish(ind.macd(bars_d(spark, sf).repartition("symbol")).select(*K, "macd", "macd_signal", "macd_hist"), D4)


@register("macd_cross", _research_q(None, ["macd_cross"]))
def q_macd_cross(spark, sf):
    df = ind.macd_cross_event(ind.macd(bars_d(spark, sf).repartition("symbol")))
    return finish(df.select(*K, "macd_cross"), D4)


@register("adx_research", _research_q(None, ["di_plus", "di_minus", "adx", "atr"]))
def q_adx_research(spark, sf):
    df = ind.adx(bars_d(spark, sf).repartition("symbol"), dialect="research")
    return finish(df.select(*K, "di_plus", "di_minus", "adx", "atr"), D4)


_LIVE_ADX = ["tr", "dm_plus", "dm_minus", "di_plus", "di_minus", "dx", "adx", "atr"]


@register("adx_live", _live_q(_LIVE_ADX))
def q_adx_live(spark, sf):
    df = ind.adx(bars_d(spark, sf).repartition("symbol"), dialect="live")
    return finish(df.select(*K, *_LIVE_ADX), D4)


# ---- features and label ---------------------------------------------------

_STRAT = ["bb_width", "dist_sma_norm_by_atr", "dist_sma_mom", "bb_pos", "adx_trending", "volume_spike"]


@register("strategy_features", _research_q(None, _STRAT, min_bars=250))
def q_strategy_features(spark, sf):
    return finish(feat.enrich_research(bars_d(spark, sf)).select(*K, *_STRAT), D4)


_CTX = ["dist_sma_200_pct", "macd_cross", "day_of_week", "hour_of_day"]


@register("context_features", _research_q(None, _CTX, fixture="bars_h"))
def q_context_features(spark, sf):
    df = feat.enrich_research(bars_h(spark, sf), min_bars=0)
    return finish(df.select(*K, *_CTX), D6)


_LABEL_SQL = ("WITH bars AS (" + BARS_D_SQL + "), l AS (SELECT symbol, open_time, "
              f"row_number() OVER ({W}) AS rn, "
              f"count(high) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS fc, "
              f"max(high) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS fh, close FROM bars) "
              "SELECT symbol, open_time, "
              "CAST(CASE WHEN rn >= 5 AND fc = 5 AND fh >= close * 1.03 THEN 1 ELSE 0 END AS INTEGER) AS target, "
              "CAST(CASE WHEN rn >= 5 AND fc = 5 AND fh >= close * 2.0 THEN 1 ELSE 0 END AS INTEGER) AS target_100 "
              "FROM l")


@register("forward_max_label", _LABEL_SQL)
def q_forward_max_label(spark, sf):
    b = bars_d(spark, sf).repartition("symbol")
    df = feat.forward_max_label(b, 0.03, 5, "target")
    df = feat.forward_max_label(df, 1.0, 5, "target_100")
    return df.select(*K, F.col("target").cast("int"), F.col("target_100").cast("int"))


@register("cmf", _research_q(None, ["cmf_20"], fixture="bars_h"))
def q_cmf(spark, sf):
    return finish(ind.cmf(bars_h(spark, sf).repartition("symbol")).select(*K, "cmf_20"), D6)


@register("cmf_nofill", _live_q(["cmf_20"], fixture="bars_h", fill_flat=False))
def q_cmf_nofill(spark, sf):
    return finish(ind.cmf(bars_h(spark, sf).repartition("symbol"), fill_flat=False).select(*K, "cmf_20"), D6)


@register("live_features", _live_q(LIVE_FEATURES))
def q_live_features(spark, sf):
    return finish(feat.enrich_live_all(bars_d(spark, sf), min_bars=0), D4).select(*K, *LIVE_FEATURES)


_LIVE_NOTNULL = " AND ".join(f"{c} IS NOT NULL" for c in BAR_COLS + LIVE_FEATURES)


@register("enrich_live", _live_q(BAR_COLS + LIVE_FEATURES, min_bars=250, where=_LIVE_NOTNULL))
def q_enrich_live(spark, sf):
    return finish(feat.enrich_live(bars_d(spark, sf)), D4)
