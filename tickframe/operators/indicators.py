"""Technical indicators over bar series, in two explicit dialects.

``research``: the dialect the enrichment job writes for training.
``live``: the dialect the signal / trading jobs compute on fresh bars.
They disagree on ADX (sign of the down move, smoothing, epsilon, row-0 true
range) and on several derived features; both are kept exactly, selected by a
``dialect`` argument, never mixed.

Each function is DataFrame -> DataFrame and adds columns; all windows share one
partitioning and order (``functions.windows``), so one hash exchange serves all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.functions.expr import flag, ieee_div
from tickframe.functions.windows import (
    OWN, current_parts, diff, lag, positioned, rolling_max, rolling_mean, rolling_min, rolling_std, rolling_sum,
    with_rolling_mean,
)
from tickframe.operators.ewm import ewm, with_ewm
from tickframe.operators.parts import staged_ewms

DIALECTS = ("research", "live")
EPS = 1e-10  # fixed value: the research ADX adds it to both divisors


def _check(dialect: str) -> None:
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")


class Indicator:
    """An indicator as phases: ``prep`` adds EWM inputs, ``stage1`` EWMs,
    ``mid`` derives second-stage inputs, ``stage2`` EWMs, ``post`` finishes.

    ``fused(df, [...])`` runs the phases of several indicators together so all
    their first-stage EWMs share one set of window operators (and the second
    stage another) -- the plan grows with the number of stages, not indicators.
    """

    def __init__(self, prep=None, stage1=(), mid=None, stage2=(), post=None, temp=()):
        self.prep, self.stage1, self.mid, self.stage2, self.post = prep, list(stage1), mid, list(stage2), post
        self.temp = list(temp)


def fused(df: DataFrame, indicators: list[Indicator], initial: DataFrame | None = None, states: bool = False) -> DataFrame:
    """All indicators in two EWM stages, on a frame of parts (there with ``initial`` seeds and EWM ``states`` as
    in ``parts.staged_ewms``) or on whole series."""
    def prepare(d):
        for x in indicators:
            d = x.prep(d) if x.prep else d
        return d

    def middle(d):
        for x in indicators:
            d = x.mid(d) if x.mid else d
        return d

    stages = [(prepare, [e for x in indicators for e in x.stage1]), (middle, [e for x in indicators for e in x.stage2])]
    if OWN in df.columns:
        df = staged_ewms(df, stages, current_parts(), initial=initial, states=states)
    else:
        df = positioned(df)
        for before, specs in stages:
            df = with_ewm(before(df), specs)
    for x in indicators:
        if x.post:
            df = x.post(df)
    return df.drop(*[c for x in indicators for c in x.temp])


def rsi_ind(period: int = 14, src: str = "close", out: str = "rsi_14") -> Indicator:
    """Wilder-style RSI with adjusted EWM (com = period-1, min_periods = period).
    Row 0 gain/loss are 0, not NULL; only-gains -> 100; flat -> NULL."""
    def prep(df):
        d = diff(src)
        df = df.withColumn("_gain", F.when(F.coalesce(d > 0, F.lit(False)), d).otherwise(F.lit(0.0)))
        return df.withColumn("_loss", F.when(F.coalesce(d < 0, F.lit(False)), -d).otherwise(F.lit(0.0)))

    def post(df):
        rs = ieee_div(F.col("_ag"), F.col("_al"))
        return df.withColumn(out, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs))
    return Indicator(prep, [ewm("_gain", "_ag", com=period - 1, adjust=True, min_periods=period),
                            ewm("_loss", "_al", com=period - 1, adjust=True, min_periods=period)],
                     post=post, temp=["_gain", "_loss", "_ag", "_al"])


def macd_ind(fast: int = 12, slow: int = 26, signal: int = 9) -> Indicator:
    def mid(df):
        return df.withColumn("macd", F.col("_ema_fast") - F.col("_ema_slow"))

    def post(df):
        return df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return Indicator(None, [ewm("close", "_ema_fast", span=fast, adjust=False),
                            ewm("close", "_ema_slow", span=slow, adjust=False)],
                     mid, [ewm("macd", "macd_signal", span=signal, adjust=False)], post,
                     temp=["_ema_fast", "_ema_slow"])


def adx_ind(window: int = 14, dialect: str = "research") -> Indicator:
    """ADX with DI+/DI- and ATR.

    research: TR row 0 = high-low (max skips NULL); down move = low - prev low
    (signed as written); +DM needs up > down and up > 0; EWM alpha=1/window,
    min_periods=window; epsilon in the divisors.  Adds di_plus, di_minus, adx, atr.

    live: TR NULL on row 0; down move = prev low - low; no > 0 guard; EWM
    span=window, no min_periods; IEEE division.  Adds tr, dm_plus, dm_minus,
    di_plus, di_minus, dx, adx, atr.
    """
    _check(dialect)
    h, l = F.col("high"), F.col("low")
    pc = lag("close")
    tr = F.greatest(h - l, F.abs(h - pc), F.abs(l - pc))
    if dialect == "research":
        sm = dict(alpha=1.0 / window, adjust=False, min_periods=window)

        def prep(df):
            up, dn = diff("high"), diff("low")
            return (df.withColumn("_tr", tr)
                      .withColumn("_dmp", F.when(F.coalesce((up > dn) & (up > 0), F.lit(False)), up).otherwise(F.lit(0.0)))
                      .withColumn("_dmm", F.when(F.coalesce((dn > up) & (dn > 0), F.lit(False)), dn).otherwise(F.lit(0.0))))

        def mid(df):
            df = (df.withColumn("di_plus", F.lit(100.0) * (F.col("_dmps") / (F.col("_atr") + F.lit(EPS))))
                    .withColumn("di_minus", F.lit(100.0) * (F.col("_dmms") / (F.col("_atr") + F.lit(EPS)))))
            return df.withColumn("_dx", F.lit(100.0) * (F.abs(F.col("di_plus") - F.col("di_minus"))
                                                        / (F.col("di_plus") + F.col("di_minus") + F.lit(EPS))))

        def post(df):
            return df if "atr" in df.columns else df.withColumn("atr", F.col("_atr"))
        return Indicator(prep, [ewm("_tr", "_atr", **sm), ewm("_dmp", "_dmps", **sm), ewm("_dmm", "_dmms", **sm)],
                         mid, [ewm("_dx", "adx", **sm)], post,
                         temp=["_tr", "_dmp", "_dmm", "_atr", "_dmps", "_dmms", "_dx"])
    sm = dict(span=window, adjust=False)

    def prep_live(df):
        up = h - lag("high")
        down = lag("low") - l
        return (df.withColumn("tr", F.when(pc.isNotNull(), tr))
                  .withColumn("dm_plus", F.when(F.coalesce(up > down, F.lit(False)), up).otherwise(F.lit(0.0)))
                  .withColumn("dm_minus", F.when(F.coalesce(down > up, F.lit(False)), down).otherwise(F.lit(0.0))))

    def mid_live(df):
        df = (df.withColumn("di_plus", ieee_div(F.col("_trs_dmp"), F.col("_trs")) * F.lit(100.0))
                .withColumn("di_minus", ieee_div(F.col("_trs_dmm"), F.col("_trs")) * F.lit(100.0)))
        return df.withColumn("dx", ieee_div(F.abs(F.col("di_plus") - F.col("di_minus")),
                                            F.col("di_plus") + F.col("di_minus")) * F.lit(100.0))

    def post_live(df):
        return df.withColumn("atr", F.col("_trs"))
    return Indicator(prep_live, [ewm("tr", "_trs", **sm), ewm("dm_plus", "_trs_dmp", **sm),
                                 ewm("dm_minus", "_trs_dmm", **sm)],
                     mid_live, [ewm("dx", "adx", **sm)], post_live, temp=["_trs", "_trs_dmp", "_trs_dmm"])


def rsi(df: DataFrame, period: int = 14, src: str = "close", out: str = "rsi_14") -> DataFrame:
    return fused(df, [rsi_ind(period, src, out)])


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    return fused(df, [macd_ind(fast, slow, signal)])


def adx(df: DataFrame, window: int = 14, dialect: str = "research") -> DataFrame:
    return fused(df, [adx_ind(window, dialect)])


def stochastic(df: DataFrame, k: int = 14, d: int = 3) -> DataFrame:
    df = positioned(df)
    low_min = rolling_min("low", k)
    high_max = rolling_max("high", k)
    df = df.withColumn("stoch_k", ieee_div(F.lit(100.0) * (F.col("close") - low_min), high_max - low_min))
    return df.withColumn("stoch_d", rolling_mean("stoch_k", d))


def cmf(df: DataFrame, period: int = 20, fill_flat: bool = True, out: str = "cmf_20") -> DataFrame:
    """Chaikin money flow.  A flat bar (high == low) has multiplier 0/0; it is 0
    with ``fill_flat`` (default) and NULL otherwise (then it blanks ``period`` rows)."""
    df = positioned(df)
    c, h, l, v = F.col("close"), F.col("high"), F.col("low"), F.col("volume")
    m = ieee_div((c - l) - (h - c), h - l)
    if fill_flat:
        m = F.coalesce(m, F.lit(0.0))
    df = df.withColumn("_mfv", m * v)
    return (df.withColumn(out, ieee_div(rolling_sum("_mfv", period), rolling_sum("volume", period)))
              .drop("_mfv"))


def bollinger(df: DataFrame, window: int = 20, num_std_dev: float = 2) -> DataFrame:
    df = positioned(df)
    df = df.withColumn("bb_mid", rolling_mean("close", window))
    df = df.withColumn("_sd", rolling_std("close", window))
    return (df.withColumn("bb_upper", F.col("bb_mid") + F.col("_sd") * F.lit(float(num_std_dev)))
              .withColumn("bb_lower", F.col("bb_mid") - F.col("_sd") * F.lit(float(num_std_dev)))
              .drop("_sd"))


def sma(df: DataFrame, n: int = 200, src: str = "close", out: str | None = None) -> DataFrame:
    return with_rolling_mean(positioned(df), src, n, out or f"sma_{n}")


def macd_cross_event(df: DataFrame) -> DataFrame:
    """+1 on a strict upward cross of MACD over its signal, -1 downward, else 0."""
    df = positioned(df)
    m, s = F.col("macd"), F.col("macd_signal")
    pm, ps = lag("macd"), lag("macd_signal")
    bull = F.coalesce((m > s) & (pm < ps), F.lit(False))
    bear = F.coalesce((m < s) & (pm > ps), F.lit(False))
    return df.withColumn("macd_cross", F.when(bear, F.lit(-1)).when(bull, F.lit(1)).otherwise(F.lit(0)).cast("int"))


def calendar(df: DataFrame) -> DataFrame:
    """day_of_week (Monday = 0) and hour_of_day of the bar open."""
    return (df.withColumn("day_of_week", F.weekday("open_time").cast("int"))
              .withColumn("hour_of_day", F.hour("open_time").cast("int")))


__all__ = ["rsi", "stochastic", "cmf", "bollinger", "sma", "macd", "adx", "macd_cross_event",
           "calendar", "flag", "fused", "rsi_ind", "macd_ind", "adx_ind", "DIALECTS"]
