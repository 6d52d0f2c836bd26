"""Structured Streaming jobs over landed kline payload files.

Landing folder: JSON lines ``{"symbol": ..., "payload": "<kline array text>"}``.
Every job uses ``trigger(availableNow=True)`` (process what has landed, then
stop: restartable from its checkpoint, so a lost executor or driver only
repeats the last micro-batch) and writes to a file sink.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.session import checkpoint_dir, qualified
from tickframe.sources.files import parse_klines

LANDING = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("payload", T.StringType())])


def default_checkpoint(spark: SparkSession, job: str, out: str) -> str:
    """Checkpoint location of a job writing to ``out``: stable for the same
    output (a restart resumes), distinct for every other output."""
    import hashlib
    tag = hashlib.sha1(qualified(spark, out).encode()).hexdigest()[:20]
    return os.path.join(checkpoint_dir(spark), f"{job}-{tag}")


def _run(df: DataFrame, out: str, ckpt: str, mode: str = "append") -> None:
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
           .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


ARRIVAL = ["landed", "landed_file", "pos"]


def stage_bars(spark: SparkSession, landing: str, staging: str, ckpt: str | None = None,
               files_per_trigger: int | None = None) -> DataFrame:
    """Appends every landed bar to ``staging`` with its arrival order: the
    file's modification time, its name and the place in the payload.  Nothing
    is dropped, however late it lands, and no state is kept."""
    ckpt = ckpt or default_checkpoint(spark, "stage-bars", staging)
    _run(_landed(spark, landing, files_per_trigger), staging, ckpt)
    return spark.read.parquet(staging)


def first_arrival(staged: DataFrame) -> DataFrame:
    """One row per (symbol, open_time): the first that landed."""
    values = [c for c in staged.columns if c not in ("symbol", "open_time", *ARRIVAL)]
    best = F.min_by(F.struct(*values), F.struct(*ARRIVAL)).alias("b")
    return staged.groupBy("symbol", "open_time").agg(best).select("symbol", "open_time", "b.*")


def newest_cells(staged: DataFrame) -> DataFrame:
    """One row per (symbol, open_time): per column the newest value that is not NULL."""
    values = [c for c in staged.columns if c not in ("symbol", "open_time", *ARRIVAL)]
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*ARRIVAL))).alias(c) for c in values]
    return staged.groupBy("symbol", "open_time").agg(*newest)


BAR_FIELDS = [f"{c} double" for c in ("open", "high", "low", "close", "volume")]
ARRIVED = "symbol string, open_time timestamp_ntz, " + ", ".join(BAR_FIELDS) + ", period date, late boolean"
SEEN = "newest long, seen array<long>"


def _first_seen(keep_days: int):
    """Passes the first arrival of each bar time; the state of a symbol is its newest time and the times seen
    within ``keep_days`` before it.  Bars older than that can't be judged by the state and are marked ``late``."""
    import numpy as np
    import pandas as pd
    keep = np.timedelta64(keep_days, "D")

    def fn(key, pdfs, state):
        newest, seen = state.get if state.exists else (None, [])
        bars = pd.concat(list(pdfs), ignore_index=True).sort_values(ARRIVAL, kind="stable").drop_duplicates("open_time")
        times = bars["open_time"].to_numpy().astype("datetime64[us]")
        known = np.array(seen, np.int64).astype("datetime64[us]")
        late = np.zeros(len(bars), bool) if newest is None else times < np.int64(newest).astype("datetime64[us]") - keep
        new = late | ~np.isin(times, known)
        top = times.max() if newest is None else max(times.max(), np.int64(newest).astype("datetime64[us]"))
        held = np.union1d(known, times[~late])
        state.update((int(top.astype(np.int64)), held[held >= top - keep].astype(np.int64).tolist()))
        yield bars.assign(late=late)[new][["symbol", "open_time", "open", "high", "low", "close", "volume", "period", "late"]]
    return fn


def _landed(spark: SparkSession, landing: str, files_per_trigger: int | None = None) -> DataFrame:
    """The stream of landed bars with their arrival order."""
    reader = spark.readStream.schema(LANDING)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = reader.json(landing).select("symbol", "payload", F.col("_metadata.file_modification_time").alias("landed"),
                                      F.col("_metadata.file_name").alias("landed_file"))
    return parse_klines(src, keep=("landed", "landed_file"))


def _for_each_batch(df: DataFrame, fn, ckpt: str, mode: str = "append") -> None:
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_dedup(spark: SparkSession, landing: str, out: str, ckpt: str | None = None, keep_days: int = 7,
                 files_per_trigger: int | None = None) -> DataFrame:
    """Re-sent bars are dropped: the first arrival per (symbol, open_time) stays, whatever lands later.

    A keyed state with the bar times of the last ``keep_days`` of each symbol judges what arrives in time; it
    expires with the symbol's newest bar, so it is bounded by the symbols.  A bar that is older is
    looked up in the stored bars of its month, which alone are read; nothing is dropped unseen, and stored bars
    are never aggregated again.  A micro-batch writes one folder, which its repetition overwrites."""
    ckpt = ckpt or default_checkpoint(spark, "dedup", out)
    arrived = _landed(spark, landing, files_per_trigger).select(
        "symbol", "open_time", "open", "high", "low", "close", "volume",
        F.to_date(F.date_trunc("month", "open_time")).alias("period"), *ARRIVAL)
    judged = arrived.groupBy("symbol").applyInPandasWithState(_first_seen(keep_days), ARRIVED, SEEN, "append", "NoTimeout")
    _for_each_batch(judged, lambda df, batch: _keep_first(df, batch, out), ckpt)
    return first_bars(spark, out)


def first_bars(spark: SparkSession, out: str) -> DataFrame:
    """The bars that ``stream_dedup`` has stored at ``out``."""
    return spark.read.schema(f"{ARRIVED}, batch long").parquet(f"{out}/bars")


def _keep_first(df: DataFrame, batch: int, out: str) -> None:
    spark = df.sparkSession
    held = f"{out}/arrived/batch={batch}"
    df.write.mode("overwrite").parquet(held)      # the state operator runs once a batch
    rows = spark.read.schema(ARRIVED).parquet(held)
    late = rows.filter("late")
    months = [r["period"] for r in late.select("period").distinct().collect()]   # at most the months of history
    if months and batch > 0:
        stored = first_bars(spark, out).filter((F.col("batch") < batch) & F.col("period").isin(months)).select("symbol", "open_time", "period")
        late = late.join(stored, ["symbol", "open_time", "period"], "left_anti").select(rows.columns)
    rows.filter(~F.col("late")).unionByName(late).write.mode("overwrite").partitionBy("period").parquet(f"{out}/bars/batch={batch}")


def stream_update(spark: SparkSession, landing: str, store, ckpt: str | None = None,
                  files_per_trigger: int | None = None) -> None:
    """Incremental update of a ``store.BarStore`` with the landed bars that are not in it yet.

    A micro-batch reads its own files only; its newest non-NULL cells are merged into the store, which recomputes
    the features of the bars concerned.  The store remembers the last batch of this stream (named after its
    checkpoint), so a repeated batch is not applied again."""
    ckpt = ckpt or default_checkpoint(spark, "update-bars", store.path)

    def apply(df: DataFrame, batch: int) -> None:
        store.update(newest_cells(df.select("symbol", "open_time", *ARRIVAL, "open", "high", "low", "close", "volume")), ckpt, batch)

    _for_each_batch(_landed(spark, landing, files_per_trigger), apply, ckpt)


def stream_upsert(spark: SparkSession, existing: DataFrame, landing: str, staging: str,
                  ckpt: str | None = None) -> DataFrame:
    """Update of a frame that has no store: stage all landed bars with a streaming job, then upsert the newest
    non-NULL cells into the existing rows."""
    from tickframe.operators.upsert import upsert
    new = newest_cells(stage_bars(spark, landing, staging, ckpt))
    return upsert(existing, new.select("symbol", "open_time", "open", "high", "low", "close", "volume"))


def write_back(spark: SparkSession, updated: DataFrame, touched: DataFrame, path: str, enrich=None) -> None:
    """Overwrites the partitions of the ``touched`` symbols of the table at
    ``path`` (one folder per symbol) with their ``updated`` bars, enriched
    again by ``enrich`` if given.  Other symbols' files stay as they are."""
    import uuid
    rows = updated.join(touched.select("symbol").distinct(), "symbol", "left_semi")
    rows = enrich(rows) if enrich else rows
    held = os.path.join(checkpoint_dir(spark), f"write-back-{uuid.uuid4().hex}")
    rows.write.parquet(held)  # the table itself may be an input of ``updated``
    (spark.read.schema(rows.schema).parquet(held).repartition("symbol").sortWithinPartitions("symbol", "open_time")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol").parquet(path))


EXIT_OUT = ("symbol string, buy_price double, qty double, peak_price double, exit_time timestamp_ntz, "
            "close double, exit_reason string")
EXIT_STATE = "bought_ns long, buy_price double, qty double, peak_price double, done boolean"


def _monitor(threshold: float, sl: float, tp: float, trail: float, roc_thresh: float):
    import pandas as pd

    def reason(close, buy, peak, prob, roc):
        if close <= buy * (1 - sl):
            return "STOP_LOSS"
        if prob is not None and prob < threshold:
            return "SIGNAL_OFF"
        if roc is not None and roc >= roc_thresh:
            return "TRAILING_ROCKET" if close <= peak * (1 - trail) else None
        return "TAKE_PROFIT" if close >= buy * (1 + tp) else None

    def fn(key, pdfs, state):
        bought, buy, qty, peak, done = state.get if state.exists else (None, None, None, None, True)
        out = []
        bars = pd.concat(list(pdfs), ignore_index=True).dropna(subset=["buy_time"])
        for r in bars.sort_values(["buy_time", "open_time"], kind="stable").itertuples(index=False):
            at = r.buy_time.value
            if bought is None or at > bought:      # bought again: a new position
                bought, buy, qty, peak, done = at, r.buy_price, r.qty, r.peak_price, False
            if done or at < bought:
                continue
            peak = max(buy if pd.isna(peak) else peak, r.high)
            why = reason(r.close, buy, peak, r.prob_buy, r.roc)
            if why:
                out.append((key[0], buy, qty, peak, r.open_time, r.close, why))
                done = True
        if bought is not None:
            state.update((bought, buy, qty, peak, done))
        yield pd.DataFrame(out, columns=["symbol", "buy_price", "qty", "peak_price", "exit_time", "close",
                                         "exit_reason"])
    return fn


def stream_exits(spark: SparkSession, landing: str, out: str, ckpt: str | None = None,
                 threshold: float = 0.49, files_per_trigger: int = 1) -> DataFrame:
    """Position monitor: scored bars of held symbols arrive (parquet files with
    symbol, open_time, close, high, prob_buy, roc, buy_time, buy_price, qty, peak_price).
    The state per symbol is its newest position (by ``buy_time``) with its peak; the first
    exit per position is emitted, and a symbol bought again is watched again."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    from tickframe.operators import positions as po
    ckpt = ckpt or default_checkpoint(spark, "stream-exits", out)
    schema = ("symbol string, open_time timestamp_ntz, close double, high double, prob_buy double, roc double, "
              "buy_time timestamp_ntz, buy_price double, qty double, peak_price double")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    res = src.groupBy("symbol").applyInPandasWithState(
        _monitor(threshold, po.SL_PCT, po.TP_PCT, po.TRAIL_PCT, po.ROC_THRESH),
        EXIT_OUT, EXIT_STATE, "append", GroupStateTimeout.NoTimeout)
    _run(res, out, ckpt)
    return spark.read.parquet(out)
