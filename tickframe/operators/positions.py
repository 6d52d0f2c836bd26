"""Paper-trading decisions as tables: exits of held positions, buy candidates,
cash allocation and the wallet after one cycle.

Positions: (symbol, buy_price, qty, peak_price).  Market state per symbol:
the latest complete (feature-bearing) row with its score and rate of change,
plus the latest raw bar.  Everything is joins and CASE chains, for all
positions and symbols at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.expr import ieee_div
from tickframe.functions.windows import KEY, TIME
from tickframe.schemas import MODEL_THRESHOLD

# fixed values of the reference strategy
TP_PCT = 0.10
SL_PCT = 0.15
TRAIL_PCT = 0.10
ROC_LAG = 2          # "window 3" reads the close two bars back
ROC_MIN_ROWS = 4     # the rate of change needs more than 3 rows
ROC_THRESH = 0.06
MIN_TRADE_VALUE = 10.0


def rocket_roc(df: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """close / close two rows back - 1, once the series has at least 4 rows."""
    w = Window.partitionBy(key).orderBy(time)
    roc = ieee_div(F.col("close"), F.lag("close", ROC_LAG).over(w)) - F.lit(1.0)
    return df.withColumn("roc", F.when(F.row_number().over(w) >= ROC_MIN_ROWS, roc))


def running_peak(bars: DataFrame, positions: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """Peak since purchase per bar: max(buy price, running max of high from the buy bar)."""
    held = bars.join(positions.select(key, "buy_price", "buy_time"), key)
    held = held.filter(F.col(time) >= F.col("buy_time"))
    w = Window.partitionBy(key).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return held.select(key, time, F.greatest(F.col("buy_price"), F.max("high").over(w)).alias("peak_price"))


def exit_decisions(positions: DataFrame, latest: DataFrame, raw_latest: DataFrame,
                   threshold: float = MODEL_THRESHOLD, key: str = KEY) -> DataFrame:
    """Exit reason per position, in the reference order: stop loss, signal off,
    then trailing stop under rocket mode (ROC >= 6 %) or take profit otherwise.

    ``latest``: last complete row per symbol with ``close``, ``prob_buy``, ``roc``.
    ``raw_latest``: last raw bar per symbol (its high updates the peak, its
    close is the sale price).  A position without data is kept (reason NULL).
    """
    lt = latest.select(key, F.col("close").alias("close"), "prob_buy", "roc")
    rw = raw_latest.select(key, F.col("high").alias("raw_high"), F.col("close").alias("raw_close"))
    p = positions.join(lt, key, "left").join(rw, key, "left")
    buy, c = F.col("buy_price"), F.col("close")
    peak = F.greatest(F.coalesce(F.col("peak_price"), buy), F.col("raw_high"))
    p = p.withColumn("peak_price", F.coalesce(peak, F.col("peak_price")))
    sig = (F.col("prob_buy") >= F.lit(threshold)).cast("int")
    rocket = F.coalesce(F.col("roc") >= F.lit(ROC_THRESH), F.lit(False))
    reason = (F.when(c.isNull(), F.lit(None).cast("string"))
               .when(c <= buy * F.lit(1.0 - SL_PCT), F.lit("STOP_LOSS"))
               .when(sig == 0, F.lit("SIGNAL_OFF"))
               .when(rocket, F.when(c <= F.col("peak_price") * F.lit(1.0 - TRAIL_PCT), F.lit("TRAILING_ROCKET")))
               .when(c >= buy * F.lit(1.0 + TP_PCT), F.lit("TAKE_PROFIT")))
    p = p.withColumn("exit_reason", reason)
    sold = F.col("exit_reason").isNotNull()
    return p.select(key, "buy_price", "qty", "peak_price", "close", "roc", "prob_buy", "exit_reason",
                    F.when(sold, F.col("raw_close")).alias("sell_price"),
                    F.when(sold, F.col("qty") * F.col("raw_close")).alias("proceeds"),
                    F.when(sold, (F.col("raw_close") / buy - F.lit(1.0)) * F.lit(100.0)).alias("pnl_pct"))


def cash_after_exits(decisions: DataFrame, cash: float) -> DataFrame:
    return decisions.agg((F.lit(cash) + F.coalesce(F.sum("proceeds"), F.lit(0.0))).alias("cash_usdt"))


def kept_positions(decisions: DataFrame, key: str = KEY) -> DataFrame:
    return decisions.filter(F.col("exit_reason").isNull()).select(key, "buy_price", "qty", "peak_price")


def buy_candidates(universe: DataFrame, kept: DataFrame, scored_latest: DataFrame,
                   threshold: float = MODEL_THRESHOLD, key: str = KEY) -> DataFrame:
    """Symbols not held after the sells whose probability reaches the threshold."""
    free = universe.join(kept.select(key), key, "left_anti")
    return (free.join(scored_latest.select(key, "close", "prob_buy"), key)
                .filter(F.col("prob_buy") >= F.lit(threshold))
                .select(key, "pos", "prob_buy", F.col("close").alias("buy_price")))


def buy_allocation(candidates: DataFrame, cash, key: str = KEY) -> DataFrame:
    """Nothing below the minimum trade value; else the k = int(cash / 10) first candidates in list order share ALL
    cash equally.  ``cash`` is a number or a one-row table ``cash_usdt``; it enters the plan as a scalar subquery.

    ``k`` is the rank in list order: candidates are counted per range of ``pos`` and ranked inside it, so no
    window holds the whole list."""
    money = F.lit(float(cash)) if isinstance(cash, (int, float)) else cash.select("cash_usdt").scalar()
    ranked = _ranked(candidates, key).withColumn("_cash", money).filter(
        (F.col("_cash") >= MIN_TRADE_VALUE) & (F.col("_rank") <= F.floor(F.col("_cash") / MIN_TRADE_VALUE)))
    share = F.col("_cash") / ranked.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return ranked.select(key, "buy_price", (share / F.col("buy_price")).alias("qty"), F.col("buy_price").alias("peak_price"), share.alias("value"))


LIST_RANGE = 4096  # places of the symbol list that are ranked together


def _ranked(candidates: DataFrame, key: str) -> DataFrame:
    """Candidates with their rank (from 1) by (pos, key)."""
    c = candidates.withColumn("_range", F.floor(F.col("pos") / LIST_RANGE))
    sizes = c.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
                                               F.lit(0)).alias("_before"))     # one row per LIST_RANGE places
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("pos", key))
    return c.withColumn("_in", inside).join(before, "_range").withColumn("_rank", F.col("_before") + F.col("_in"))


def wallet_after_cycle(kept: DataFrame, bought: DataFrame, cash_after_sells) -> DataFrame:
    """Kept positions plus new ones, each row with the wallet's remaining cash (a scalar subquery)."""
    left = wallet_cash(bought, cash_after_sells).select("cash_usdt").scalar()
    rows = kept.unionByName(bought.select(KEY, "buy_price", "qty", "peak_price"))
    return rows.withColumn("cash_usdt", left)


def wallet_cash(bought: DataFrame, cash_after_sells) -> DataFrame:
    """The wallet's remaining cash as a one-row table, also when no position is left; the cash before is a number
    or a one-row table ``cash_usdt``."""
    money = F.lit(float(cash_after_sells)) if isinstance(cash_after_sells, (int, float)) else cash_after_sells.select("cash_usdt").scalar()
    return bought.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("spent")).select((money - F.col("spent")).alias("cash_usdt"))


def wallet_json(positions: DataFrame, cash) -> DataFrame:
    """The wallet document (reference field names), positions sorted by token; ``cash`` is a number or a one-row table."""
    money = F.lit(float(cash)) if isinstance(cash, (int, float)) else cash.select("cash_usdt").scalar()
    pos = F.struct(F.col(KEY).alias("token"), F.col("buy_price").alias("preco_compra"),
                   F.col("qty").alias("quantidade"), F.col("peak_price").alias("peak_price"))
    doc = positions.agg(F.array_sort(F.collect_list(pos)).alias("positions"))
    return doc.select(F.to_json(F.struct(money.alias("cash_usdt"), "positions")).alias("wallet"))


def wallet_positions(wallet_docs: DataFrame, col: str = "wallet", keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten wallet JSON documents to position rows (order kept as ``pos``) with the columns ``keep``.
    A wallet without positions is one row with its cash and NULL position."""
    from tickframe.schemas import WALLET
    w = wallet_docs.select(*keep, F.from_json(F.col(col), WALLET).alias("w"))
    return w.select(*keep, F.col("w.cash_usdt").alias("cash_usdt"),
                    F.posexplode_outer("w.positions").alias("pos", "p")).select(
        *keep, "cash_usdt", "pos", F.col("p.token").alias("symbol"), F.col("p.preco_compra").alias("buy_price"),
        F.col("p.quantidade").alias("qty"), F.col("p.peak_price").alias("peak_price"))
