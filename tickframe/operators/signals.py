"""Model scoring, thresholds, signal tables and evaluation reports.

A scorer is either a Spark ML model (anything with ``transform`` producing a
``probability`` vector) or a function ``DataFrame -> Column`` giving the
probability of class 1.  Scoring runs distributed over all symbols at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.schemas import MODEL_FEATURES, MODEL_THRESHOLD

BUCKETS = 256
BUY, NOT_BUY = "BUY", "NEUTRAL/SELL"  # fixed values: the two signal labels


def align_features(df: DataFrame, columns: list[str] = MODEL_FEATURES, keep=("symbol", "open_time")) -> DataFrame:
    """Model input in the model's column order; ABSENT columns become 0,
    NULL cells of present columns stay NULL."""
    keep = [c for c in keep if c in df.columns]
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0).cast("double").alias(c)
                              for c in columns])


def score(df: DataFrame, scorer, out: str = "prob_buy",
          features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Add the class-1 probability.  Rows the model cannot score (NULL
    features) are skipped, as a failed prediction skips a symbol."""
    if hasattr(scorer, "transform"):
        from pyspark.ml.functions import vector_to_array
        base = df
        for c in features:
            if c not in df.columns:          # absent model column -> 0
                base = base.withColumn(c, F.lit(0.0))
        scored = scorer.transform(base.dropna(subset=features))
        return scored.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)
    return df.withColumn(out, scorer(df)).filter(F.col(out).isNotNull())


def signal_flag(df: DataFrame, threshold: float = MODEL_THRESHOLD, prob: str = "prob_buy",
                out: str = "signal") -> DataFrame:
    return df.withColumn(out, (F.col(prob) >= F.lit(threshold)).cast("int"))


def signal_label(prob: str = "prob_buy", threshold: float = MODEL_THRESHOLD) -> Column:
    return F.when(F.col(prob) >= F.lit(threshold), F.lit(BUY)).otherwise(F.lit(NOT_BUY))


def top_signals(scored_latest: DataFrame, symbols: DataFrame, n: int = 20,
                threshold: float = MODEL_THRESHOLD) -> DataFrame:
    """Top ``n`` (at least 1) by probability, list order (``pos``) on ties,
    numbered 1..n, with the number of analysed symbols.  Hash buckets keep their
    own count and top ``n``; only these (``BUCKETS * n`` rows at most) meet in one task."""
    n = max(1, n)
    order = [F.col("prob_buy").desc(), F.col("pos"), F.col("symbol")]
    bucket = F.pmod(F.xxhash64("symbol"), F.lit(BUCKETS)).alias("_b")
    cand = scored_latest.join(symbols.select("symbol", "pos"), "symbol").select("symbol", "pos", "prob_buy", bucket)
    w = Window.partitionBy("_b")
    best = cand.select("*", F.row_number().over(w.orderBy(*order)).alias("_r"),
                       F.count(F.lit(1)).over(w).alias("_n")).filter(F.col("_r") <= n)
    every = Window.partitionBy()
    top = best.select("symbol", "prob_buy", F.row_number().over(Window.orderBy(*order)).alias("rank"),
                      F.sum(F.when(F.col("_r") == 1, F.col("_n"))).over(every).alias("n_analyzed"))
    return top.filter(F.col("rank") <= n).select(
        "rank", "symbol", "prob_buy", signal_label("prob_buy", threshold).alias("signal"), "n_analyzed")


def consult(scored_latest: DataFrame, symbol: str, threshold: float = MODEL_THRESHOLD,
            stop_pct: float = 0.15, target_pct: float = 0.10) -> DataFrame:
    """Opinion on one symbol (input upper-cased): probability, label, stop and
    target prices (target only for BUY), a few indicators, trend vs SMA 200."""
    c = F.col("close")
    buy = F.col("prob_buy") >= F.lit(threshold)
    return (scored_latest.filter(F.col("symbol") == F.upper(F.lit(symbol)))
            .select("symbol", "open_time", "close", "prob_buy",
                    signal_label("prob_buy", threshold).alias("signal"),
                    (c * F.lit(1.0 - stop_pct)).alias("stop_price"),
                    F.when(buy, c * F.lit(1.0 + target_pct)).alias("target_price"),
                    "rsi_14", "adx", "bb_width", "stoch_k",
                    F.when(c > F.col("sma_200"), F.lit("ABOVE")).otherwise(F.lit("BELOW")).alias("trend")))


def lookup(bars: DataFrame, symbol: str, scorer, threshold: float = MODEL_THRESHOLD, window: int = 300) -> DataFrame:
    """Opinion on one symbol from a bar table: only its last ``window`` bars are enriched and scored.  On a table
    bucketed by symbol the scan reads one bucket; no job runs before the result's."""
    from tickframe.operators.dataset import last_n_bars, latest_bar
    from tickframe.operators.features import enrich_live
    own = last_n_bars(bars.filter(F.col("symbol") == symbol.upper()), window)
    return consult(score(latest_bar(enrich_live(own, parts=None, longest=window)), scorer), symbol, threshold)


def best_candidate(scored: DataFrame) -> DataFrame:
    """Highest probability strictly above 0; first in list order on ties."""
    return (scored.filter(F.col("prob_buy") > 0)
            .agg(F.max_by(F.struct("symbol", "prob_buy"),
                          F.struct(F.col("prob_buy"), -F.col("pos"))).alias("b"))
            .select(F.col("b.symbol").alias("symbol"), F.col("b.prob_buy").alias("prob_buy"))
            .filter(F.col("symbol").isNotNull()))


def confusion(df: DataFrame, label: str = "target", pred: str = "pred") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str = "target", pred: str = "pred") -> DataFrame:
    """Per class precision / recall / F1 / support, then macro and weighted
    averages (0 where a ratio is 0/0), from one pass over the rows.  Labels and
    predictions other than 0 and 1 are an error."""
    l, p = F.col(label), F.col(pred)
    cell = lambda a, b: F.sum(F.when((l == a) & (p == b), 1).otherwise(0))
    binary = l.isin(0, 1) & p.isin(0, 1)
    n = df.agg(*[cell(a, b).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)],
               F.max(F.when(binary | l.isNull() | p.isNull(), 0).otherwise(1)).alias("odd"))
    ratio = lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0))
    classes = []
    for k in (0, 1):
        hit = F.col(f"n{k}{k}")
        precision = ratio(hit, hit + F.col(f"n{1 - k}{k}"))
        recall = ratio(hit, hit + F.col(f"n{k}{1 - k}"))
        classes.append((precision, recall, hit + F.col(f"n{k}{1 - k}"),
                        ratio(F.lit(2.0) * precision * recall, precision + recall)))
    (p0, r0, s0, f0), (p1, r1, s1, f1) = classes
    row = lambda name, prec, rec, sup, f: F.struct(F.lit(name).alias("class"), prec.alias("precision"), rec.alias("recall"),
                                                   sup.alias("support"), f.alias("f1"))
    mean = lambda a, b: (a + b) / 2
    weighted = lambda a, b: (a * s0 + b * s1) / (s0 + s1)
    rows = F.array(row("0", *classes[0]), row("1", *classes[1]), row("macro avg", mean(p0, p1), mean(r0, r1), s0 + s1, mean(f0, f1)),
                   row("weighted avg", weighted(p0, p1), weighted(r0, r1), s0 + s1, weighted(f0, f1)))
    checked = F.when(F.col("odd") > 0, F.raise_error(F.lit("labels other than 0 and 1"))).otherwise(rows)
    return n.select(F.explode(checked).alias("r")).select("r.*")


def accuracy(df: DataFrame, label: str = "target", pred: str = "pred") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def entries_exits(signals: DataFrame, time: str = "open_time", key: str = "symbol",
                  signal: str = "signal") -> DataFrame:
    """Long-form entry / exit flags per (time, symbol): duplicates are averaged
    (0 and 1 -> 0.5 -> entry); entry = mean != 0, exit = mean == 0."""
    m = signals.groupBy(time, key).agg(F.avg(signal).alias("mean_signal"))
    return m.select(time, key, "mean_signal",
                    F.coalesce(F.col("mean_signal") != 0, F.lit(False)).alias("entry"),
                    F.coalesce(F.col("mean_signal") == 0, F.lit(False)).alias("exit"))


def pivot_wide(df: DataFrame, value: str, symbols: list[str], time: str = "open_time",
               key: str = "symbol") -> DataFrame:
    """time x symbol matrix of mean(value); the symbol list is given, so the
    pivot needs no extra pass to discover it.  For display, not computation."""
    return df.groupBy(time).pivot(key, symbols).agg(F.avg(value))
