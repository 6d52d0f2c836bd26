"""Engineered features, forward label and the full enrichment per dialect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.functions.expr import flag, ieee_div, inf_to_null
from tickframe.functions.windows import KEY, Parts, diff, forward_max, positioned, rolling_mean
from tickframe.operators import indicators as ind
from tickframe.operators.parts import ENRICH, on_parts
from tickframe.schemas import BAR_COLS, LIVE_FEATURES, RESEARCH_FEATURES

MIN_HISTORY = 250  # fixed value: series shorter than this are not enriched


def forward_max_label(df: DataFrame, pct: float = 0.03, horizon: int = 5,
                      out: str = "target") -> DataFrame:
    """1 when the max high of the next ``horizon`` bars reaches close*(1+pct).

    Undefined look-ahead (first horizon-1 rows, last horizon rows) gives 0:
    the label is never NULL and no row is dropped."""
    df = positioned(df)
    fh = forward_max("high", horizon)
    return df.withColumn(out, flag(fh >= F.col("close") * F.lit(1.0 + pct)))


def research_features(df: DataFrame, pct: float = 0.03, horizon: int = 5) -> DataFrame:
    """Context + strategy features + label of the research dialect.
    Needs rsi..atr and sma_200 present."""
    df = positioned(df)
    c = F.col("close")
    df = df.withColumn("dist_sma_200_pct", ieee_div(c - F.col("sma_200"), F.col("sma_200")) * F.lit(100.0))
    df = ind.macd_cross_event(df)
    df = ind.calendar(df)
    df = df.withColumn("bb_width", ieee_div(F.col("bb_upper") - F.col("bb_lower"), F.col("bb_mid")))
    df = df.withColumn("dist_sma_norm_by_atr", ieee_div(F.col("dist_sma_200_pct"), F.col("atr")))
    # +-inf -> NULL once, on the double columns that exist at this point only
    doubles = [f.name for f in df.schema.fields
               if f.dataType.typeName() == "double"]
    df = df.select(*[inf_to_null(n).alias(n) if n in doubles else F.col(n) for n in df.columns])
    df = df.withColumn("dist_sma_mom", diff("dist_sma_200_pct", 3))
    df = df.withColumn("bb_pos", ieee_div(c - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")))
    df = df.withColumn("adx_trending", flag(F.col("adx") > 25))
    df = df.withColumn("volume_spike", ieee_div(F.col("volume"), rolling_mean("volume", 30)))
    return forward_max_label(df, pct, horizon)


def live_features(df: DataFrame) -> DataFrame:
    """Features of the live dialect (computes sma_200 and live ADX itself)."""
    c = F.col("close")
    df = ind.sma(df, 200)
    if "adx" not in df.columns:
        df = ind.adx(df, 14, dialect="live")
    df = df.withColumn("dist_sma_200_pct", ieee_div(c - F.col("sma_200"), F.col("sma_200")) * F.lit(100.0))
    df = df.withColumn("macd_cross", flag(F.col("macd_hist") > 0))
    df = ind.calendar(df)
    df = df.withColumn("bb_width", ieee_div(F.col("bb_upper") - F.col("bb_lower"), F.col("bb_mid")))
    df = df.withColumn("dist_sma_norm_by_atr", ieee_div(c - F.col("sma_200"), F.col("atr")))
    df = df.withColumn("dist_sma_mom", diff("dist_sma_200_pct", 1))
    df = df.withColumn("bb_pos", ieee_div(c - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")))
    df = df.withColumn("adx_trending", flag(F.col("adx") > 25))
    df = df.withColumn("volume_spike", flag(F.col("volume") > F.lit(2.0) * rolling_mean("volume", 30)))
    return df


def min_history(df: DataFrame, n: int = MIN_HISTORY, key: str = KEY) -> DataFrame:
    """Drop whole series with fewer than ``n`` bars: bars are counted with partial sums, and a semi-join keeps
    the long series."""
    long = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n).select(key)
    return df.join(long, key, "left_semi")


def _bars(df: DataFrame) -> DataFrame:
    return df.select("symbol", "open_time", *BAR_COLS)


def enrich_research(bars: DataFrame, min_bars: int | None = MIN_HISTORY, parts: Parts | None = ENRICH) -> DataFrame:
    """Full research enrichment: 250-bar rule, indicators, features, label."""
    def compute(df):
        df = ind.fused(df, [ind.rsi_ind(), ind.macd_ind(), ind.adx_ind(dialect="research")])
        df = ind.stochastic(df)
        df = ind.cmf(df)
        df = ind.sma(df, 200)
        df = ind.bollinger(df)
        return research_features(df)
    return on_parts(_bars(bars), compute, parts, min_bars).select("symbol", "open_time", *BAR_COLS, *RESEARCH_FEATURES)


def live_columns(df: DataFrame, fill_flat: bool = True, initial: DataFrame | None = None, states: bool = False) -> DataFrame:
    """Live indicators and features of a frame whose rows are numbered."""
    df = ind.fused(df, live_indicators(), initial, states)
    df = ind.stochastic(df)
    df = ind.cmf(df, fill_flat=fill_flat)
    df = ind.bollinger(df)
    return live_features(df)


def live_indicators() -> list[ind.Indicator]:
    """The indicators with EWMs of the live dialect."""
    return [ind.rsi_ind(), ind.macd_ind(), ind.adx_ind(dialect="live")]


def enrich_live_all(bars: DataFrame, min_bars: int | None = MIN_HISTORY, fill_flat: bool = True,
                    parts: Parts | None = ENRICH, longest: int | None = None) -> DataFrame:
    """Live indicators and features on every bar (no NULL filter); ``parts`` and ``longest`` as in ``on_parts``."""
    return (on_parts(_bars(bars), lambda df: live_columns(df, fill_flat), parts, min_bars, longest=longest)
            .select("symbol", "open_time", *BAR_COLS, *LIVE_FEATURES))


def enrich_live(bars: DataFrame, min_bars: int | None = MIN_HISTORY, fill_flat: bool = True,
                parts: Parts | None = ENRICH, longest: int | None = None) -> DataFrame:
    """Live enrichment: rows with any NULL are dropped (warm-up rows go)."""
    return enrich_live_all(bars, min_bars, fill_flat, parts, longest).dropna("any")
