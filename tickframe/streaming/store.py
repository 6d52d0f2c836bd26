"""A stored table of enriched bars that an update goes on from instead of starting anew.

Files lie in folders ``data/commit=C/period=P/slice=S``: a slice is a hash of the symbol, a period a calendar
month (or week, or day).  A manifest version lists which commit holds each (period, slice); readers take the newest
version.  An update writes new files for the partitions it touches, then publishes the next version by renaming
one folder: a run that fails leaves the table as it was, and a second writer's rename fails.

The last bar of a symbol in a period carries the state after it (``state``): the position and, per EWM, value, log
weight and observations.  An update reads the state before a symbol's first new bar, the last bars before it
(as many as the longest window looks back) and the bars from that period on; earlier bars are neither read
nor written.  The result equals an enrichment of the whole history.

The driver holds one entry for each (period, slice), as for any table's file index, and no bars.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions.windows import POS, Parts, in_parts, lead
from tickframe.operators import features as feat
from tickframe.operators.ewm import seed_columns, state_columns
from tickframe.operators.parts import ENRICH, LENGTH, numbered, own_rows, parted
from tickframe.operators.upsert import upsert
from tickframe.schemas import BAR_COLS, INT_FEATURES, LIVE_FEATURES
from tickframe.session import checkpoint_dir

KEYS = ["symbol", "open_time"]
ENTRY = "period date, slice int, commit string, n_rows long"


@dataclass(frozen=True)
class Entry:
    """Where a partition's rows are."""
    period: object
    slice: int
    commit: str
    n_rows: int


class BarStore:
    def __init__(self, spark: SparkSession, path: str, period: str = "month", slices: int = 64, parts: Parts = ENRICH) -> None:
        """``period`` and ``slices`` must be the same for every use of a store."""
        self.spark, self.path, self.period, self.slices, self.parts = spark, path.rstrip("/"), period, slices, parts
        self.specs = [e for x in feat.live_indicators() for e in (*x.stage1, *x.stage2)]
        seeds = [T.StructField(c, T.LongType() if c.startswith("_sn") else T.DoubleType()) for s in self.specs for c in seed_columns(s)]
        state = T.StructType([T.StructField("bars", T.LongType()), *seeds])
        ints = INT_FEATURES | {"volume_spike"}
        self.schema = T.StructType([
            T.StructField("symbol", T.StringType()), T.StructField("open_time", T.TimestampNTZType()),
            *[T.StructField(c, T.DoubleType()) for c in BAR_COLS],
            *[T.StructField(c, T.IntegerType() if c in ints else T.DoubleType()) for c in LIVE_FEATURES],
            T.StructField(POS, T.LongType()), T.StructField("state", state),
            T.StructField("commit", T.StringType()), T.StructField("period", T.DateType()), T.StructField("slice", T.IntegerType())])

    # ---- files ------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm

    def version(self) -> int:
        """The newest published version, 0 for a store that has none."""
        fs, path = self._fs(f"{self.path}/manifest")
        if not fs.exists(path):
            return 0
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        return max((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), default=0)

    def entries(self, version: int | None = None) -> list[Entry]:
        version = self.version() if version is None else version
        if not version:
            return []
        rows = self.spark.read.schema(ENTRY).parquet(f"{self.path}/manifest/version={version}/entries").collect()
        return [Entry(r["period"], r["slice"], r["commit"], r["n_rows"]) for r in rows]

    def last_batch(self, stream: str) -> int:
        """The last micro-batch of ``stream`` that is in the table, -1 if none is."""
        version = self.version()
        if not version:
            return -1
        rows = self.spark.read.schema("stream string, batch long").parquet(f"{self.path}/manifest/version={version}/streams")
        return max((r["batch"] for r in rows.filter(F.col("stream") == stream).collect()), default=-1)

    def _publish(self, version: int, entries: list[Entry], stream: str | None, batch: int | None) -> None:
        held = f"{self.path}/manifest/_{uuid.uuid4().hex}"
        rows = [(e.period, e.slice, e.commit, e.n_rows) for e in entries]
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.parquet(f"{held}/entries")
        known = self.spark.createDataFrame([], "stream string, batch long")
        if version > 1:
            known = self.spark.read.schema("stream string, batch long").parquet(f"{self.path}/manifest/version={version - 1}/streams")
        if stream is not None:
            known = known.filter(F.col("stream") != stream).union(self.spark.createDataFrame([(stream, batch)], "stream string, batch long"))
        known.coalesce(1).write.parquet(f"{held}/streams")
        fs, source = self._fs(held)
        target = self._fs(f"{self.path}/manifest/version={version}")[1]
        if fs.exists(target) or not fs.rename(source, target):
            raise RuntimeError(f"version {version} was published by another writer")

    def scan(self, entries: list[Entry]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/data/commit={e.commit}/period={e.period}/slice={e.slice}" for e in entries]
        return self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*paths)

    def read(self) -> DataFrame:
        """The enriched bars of the newest version."""
        return self.scan(self.entries()).select(*KEYS, *BAR_COLS, *LIVE_FEATURES)

    # ---- update -----------------------------------------------------------------

    def _home(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"period": F.to_date(F.date_trunc(self.period, "open_time")),
                               "slice": F.pmod(F.xxhash64("symbol"), F.lit(self.slices)).cast("int")})

    def _staged(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/bar-store/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def update(self, cells: DataFrame, stream: str | None = None, batch: int | None = None) -> int:
        """Merges new cells, unique by (symbol, open_time), and returns the version that has them.

        A non-NULL cell replaces the stored one.  A micro-batch that is in the table already is not applied again."""
        version = self.version()
        if stream is not None and self.last_batch(stream) >= batch:
            return version
        new = self._staged(self._home(cells.select(*KEYS, *BAR_COLS)), "cells")
        since = new.groupBy("symbol", "slice").agg(F.min("period").alias("since"))
        first = {r["slice"]: r["since"] for r in since.groupBy("slice").agg(F.min("since").alias("since")).collect()}
        if not first:
            return version
        entries = self.entries(version)
        earlier = [e for e in entries if e.slice in first and e.period < first[e.slice]]
        touched = [e for e in entries if e.slice in first and e.period >= first[e.slice]]

        goes_on, back_to = self._goes_on(earlier, touched, since)
        copied = [e for e in [*earlier, *touched] if e.slice in back_to and e.period >= back_to[e.slice]]
        rows = self._recomputed(new, since, goes_on, copied, touched)
        kept = (self.scan(touched).alias("t").join(since.drop("slice").alias("n"), (F.col("t.symbol") == F.col("n.symbol"))
                                                   & (F.col("t.period") >= F.col("n.since")), "left_anti").drop("commit"))
        commit = f"{version + 1:08d}-{uuid.uuid4().hex[:12]}"
        folder = f"{self.path}/data/commit={commit}"
        out = rows.unionByName(kept)
        out.repartition("period", "slice").sortWithinPartitions("period", "slice", *KEYS).write.partitionBy("period", "slice").parquet(folder)
        written = (self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(folder)
                   .groupBy("period", "slice").agg(F.count("*").alias("n")).collect())
        gone = {(e.period, e.slice) for e in touched}
        entries = [e for e in entries if (e.period, e.slice) not in gone] + [Entry(r["period"], r["slice"], commit, r["n"]) for r in written]
        self._publish(version + 1, entries, stream, batch)
        return version + 1

    def _goes_on(self, earlier: list[Entry], touched: list[Entry], since: DataFrame) -> tuple[DataFrame, dict[int, object]]:
        """(symbol, since, state before it) of the symbols that have bars before; and per slice the first period
        that holds one of the bars that windows look back to."""
        states = self.scan([*earlier, *touched]).filter(F.col("state").isNotNull()).select("symbol", "slice", "period", "state")
        before = (states.join(since.select(F.col("symbol").alias("_s"), "since"), (F.col("symbol") == F.col("_s")) & (F.col("period") < F.col("since")))
                  .drop("_s"))
        goes_on = self._staged(before.groupBy("symbol", "slice", "since").agg(F.max_by("state", "period").alias("state")), "states")
        needed = (before.join(goes_on.select(F.col("symbol").alias("_s"), F.col("state.bars").alias("_bars")), F.col("symbol") == F.col("_s"))
                  .filter(F.col("state.bars") > F.col("_bars") - self.parts.back))
        return goes_on, {r["slice"]: r["p"] for r in needed.groupBy("slice").agg(F.min("period").alias("p")).collect()}

    def _recomputed(self, new: DataFrame, since: DataFrame, goes_on: DataFrame, copied: list[Entry], touched: list[Entry]) -> DataFrame:
        """All rows, from their first new period on, of the symbols that have new bars."""
        seeds = [c for s in self.specs for c in seed_columns(s)]
        base = goes_on.select(F.col("symbol").alias("_s"), F.col("state.bars").alias("_bars"), F.col("since").alias("_since"))
        bars = self.scan(touched).select("symbol", "open_time", *BAR_COLS, "period")
        bars = bars.join(since.select(F.col("symbol").alias("_s"), "since"), (F.col("symbol") == F.col("_s")) & (F.col("period") >= F.col("since")))
        merged = numbered(upsert(bars.select(*KEYS, *BAR_COLS), new.select(*KEYS, *BAR_COLS)))
        merged = (merged.join(base.drop("_since"), F.col("symbol") == F.col("_s"), "left").drop("_s")
                  .withColumn("_bars", F.coalesce("_bars", F.lit(0).cast("long")))
                  .withColumns({POS: F.col(POS) + F.col("_bars"), LENGTH: F.col(LENGTH) + F.col("_bars")}))
        before = (self.scan(copied).join(base, (F.col("symbol") == F.col("_s")) & (F.col("period") < F.col("_since"))
                                         & (F.col(POS) >= F.col("_bars") - self.parts.back))
                  .select(*KEYS, *BAR_COLS, POS, "_bars", F.lit(None).cast("long").alias(LENGTH)))
        with in_parts(self.parts):
            frame = parted(merged, self.parts, base="_bars", before=before)
            df = feat.live_columns(frame, initial=goes_on.select("symbol", *[F.col(f"state.{c}").alias(c) for c in seeds]), states=True)
            df = self._home(df)
            last = F.coalesce(F.to_date(F.date_trunc(self.period, lead("open_time"))) != F.col("period"), F.lit(True))
            df = df.withColumn("state", F.when(last, self._state()))
        return own_rows(df, POS).select(*[f.name for f in self.schema.fields if f.name != "commit"])

    def _state(self) -> Column:
        held = [F.col(t).cast("long" if c.startswith("_sn") else "double").alias(c)
                for s in self.specs for c, t in zip(seed_columns(s), state_columns(s))]
        return F.struct((F.col(POS) + 1).alias("bars"), *held)


__all__ = ["BarStore", "Entry"]
