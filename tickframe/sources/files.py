"""Sources and sinks: bar files, kline payloads, symbol lists.

Schemas are always given (no inference); symbols come from partition
folders (our layout) or from file names (the reference's per-symbol files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

from tickframe.functions.text import from_epoch_ms, symbol_from_file_name
from tickframe.schemas import BAR_COLS, BARS, KLINE_FIELDS, KLINE_PAYLOAD, RAW_BAR_CSV


FILE_ROWS = 2_000_000  # most rows of a bar file


def write_bars(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", by_symbol: bool = True,
               file_rows: int = FILE_ROWS) -> None:
    """Bar sink in (symbol, time) order, with one folder per symbol if ``by_symbol``.

    Rows are range-partitioned by (symbol, time), so a hot symbol is written by many tasks, each a stretch of time;
    a file has at most ``file_rows`` rows."""
    rows = df.repartitionByRange("symbol", "open_time").sortWithinPartitions("symbol", "open_time")
    writer = rows.write.mode(mode).format(fmt).option("header", True).option("maxRecordsPerFile", file_rows)
    (writer.partitionBy("symbol") if by_symbol else writer).save(path)


def in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """The bars of a parquet sink written with ``by_symbol=False``, with their place ``pos`` (from 0) in file order.

    Files are ordered by their first bar.  A file whose rows are out of order, or that begins before the one before
    it ends, is an error."""
    at = F.struct("symbol", "open_time")
    rows = (spark.read.schema(BARS).parquet(path)
            .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")))
    inside = Window.partitionBy("_file").orderBy("_row")
    rows = rows.withColumn("_back", F.coalesce(F.lag(at).over(inside) >= at, F.lit(False)))
    sizes = rows.groupBy("_file").agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.count("*").alias("_n"), F.max("_back").alias("_back"))
    ordered = Window.orderBy("_first")        # over one row per file
    sizes = sizes.select("_file", F.coalesce(F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                         (F.col("_back") | F.coalesce(F.lag("_last").over(ordered) >= F.col("_first"), F.lit(False))).alias("_wrong"))
    pos = F.when(F.col("_wrong"), F.raise_error(F.lit("bars out of order"))).otherwise(F.col("_before") + F.col("_row"))
    return rows.drop("_back").join(sizes, "_file").select("symbol", "open_time", *BAR_COLS, pos.cast("long").alias("pos"))


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int) -> None:
    """Bars as a table bucketed by symbol, sorted by time inside a bucket: a look-up of one symbol reads one bucket."""
    (df.write.mode("overwrite").bucketBy(buckets, "symbol").sortBy("symbol", "open_time").option("path", path).saveAsTable(name))


def write_symbol_files(df: DataFrame, folder: str, prefix: str = "analise_v2_", interval: str = "4h") -> None:
    """Legacy layout: one CSV file ``{prefix}{SYMBOL}_{interval}.csv`` per symbol, in time order.  The driver only
    renames the files, one a symbol."""
    spark = df.sparkSession
    held = f"{folder.rstrip('/')}/_held"
    df.repartition("symbol").sortWithinPartitions("symbol", "open_time").write.partitionBy("symbol").option("header", True).csv(held)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(held).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in fs.listStatus(hadoop(held)):
        if part.isDirectory():
            symbol = part.getPath().getName().removeprefix("symbol=")
            for f in fs.listStatus(part.getPath()):
                if f.getPath().getName().startswith("part-"):
                    fs.rename(f.getPath(), hadoop(f"{folder}/{prefix}{symbol}_{interval}.csv"))
    fs.delete(hadoop(held), True)


def scan_by_header(spark: SparkSession, glob: str, wanted: list[str], time: str = "open_time", prefix: str = "analise_v2_") -> DataFrame:
    """CSV files that differ in columns: (symbol, time, wanted columns), a column that a file lacks being NULL.

    A header scan groups the files by their column line; each group is one scan that is pruned to the wanted columns,
    and the groups' outer union is the result.  The driver gets one path per file, as for any scan's file index.
    Columns are read as double, the time as timestamp; a file without the time column is an error."""
    lines = spark.read.text(glob).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"))
    heads = lines.filter(F.col("header").rlike(rf"(^|,){time}(,|$)"))
    groups = heads.groupBy("path").agg(F.min("header").alias("header")).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    files = spark.read.text(glob).select(F.col("_metadata.file_path").alias("p")).distinct().count()
    if sum(len(g["paths"]) for g in groups) != files:
        raise ValueError(f"files without a {time} column match {glob}")
    frames = []
    for g in sorted(groups, key=lambda g: g["header"]):
        names = g["header"].split(",")
        schema = StructType([StructField(n, TimestampNTZType() if n == time else DoubleType()) for n in names])
        df = spark.read.schema(schema).option("header", True).csv(sorted(g["paths"]))
        frames.append(df.select(symbol_from_file_name(F.col("_metadata.file_name"), prefix).alias("symbol"), time,
                                *[n for n in wanted if n in names]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    missing = [F.lit(None).cast("double").alias(n) for n in wanted if n not in out.columns]
    return out.select("*", *missing).select("symbol", time, *wanted)


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read our bar layout back (symbol from the partition folder)."""
    schema = StructType([*RAW_BAR_CSV.fields, StructField("symbol", StringType())])
    df = spark.read.format(fmt).schema(schema).option("header", True).load(path)
    return df.select("symbol", "open_time", *BAR_COLS)


def read_or_empty(spark: SparkSession, path: str, schema, fmt: str = "csv") -> DataFrame:
    """Existing table at ``path`` or, when nothing is there yet, an empty frame
    of ``schema`` (first run of an incremental job).  A corrupt file is an error."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("header", True).load(path)


def write_versioned(df: DataFrame, base: str, version: int, fmt: str = "parquet") -> str:
    """Result sink of one run under ``base/run_version=N`` (trade logs, reports)."""
    path = f"{base}/run_version={int(version)}"
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)
    return path


def run_versions(spark: SparkSession, base: str) -> DataFrame:
    """Names of existing runs under ``base`` as a DataFrame of ``name``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(jvm_path)] if fs.exists(jvm_path) else []
    return spark.createDataFrame([(n,) for n in names], "name string")


def scan_bars_csv(spark: SparkSession, glob: str, prefix: str = "analise_v2_") -> DataFrame:
    """Legacy per-symbol CSV files (``[prefix]{SYMBOL}_{interval}.csv``, header
    ``open_time,open,high,low,close,volume``): symbol cut from the file name."""
    df = spark.read.schema(RAW_BAR_CSV).option("header", True).csv(glob)
    return df.select(symbol_from_file_name(F.col("_metadata.file_name"), prefix).alias("symbol"),
                     "open_time", *BAR_COLS)


def parse_klines(payloads: DataFrame, symbol: str = "symbol", payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Exchange kline payload text (JSON array of 12-element arrays) -> typed
    bar rows with all fields, the place in the payload (``pos``) and the columns
    ``keep``.  Numbers arrive as text and are cast (ANSI: bad text raises);
    an empty array yields no rows."""
    arr = F.from_json(F.col(payload), KLINE_PAYLOAD)
    rows = payloads.select(F.col(symbol).alias("symbol"), *keep, F.posexplode(arr).alias("pos", "k"))
    k = F.col("k")
    return rows.select(
        "symbol",
        from_epoch_ms(k[0].cast("long")).alias("open_time"),
        *[k[i].cast("double").alias(n) for i, n in enumerate(KLINE_FIELDS) if n in BAR_COLS],
        from_epoch_ms(k[6].cast("long")).alias("close_time"),
        k[7].cast("double").alias("quote_volume"),
        k[8].cast("long").alias("trades"),
        k[9].cast("double").alias("taker_base"),
        k[10].cast("double").alias("taker_quote"),
        k[11].alias("ignore"), "pos", *keep)


def symbol_list(docs: DataFrame, text: str = "symbols", key: str = "list_id") -> DataFrame:
    """JSON array of symbols per document -> (list_id, pos, symbol); order kept."""
    arr = F.from_json(F.col(text), "array<string>")
    return docs.select(key, F.posexplode(arr).alias("pos", "symbol"))


def next_run_version(names: DataFrame, col: str = "name", prefix: str = "trades_log_v") -> DataFrame:
    """1 + the largest ``{prefix}{N}`` among names (1 when there is none)."""
    from tickframe.functions.text import run_version
    return names.filter(F.col(col).startswith(prefix)).agg(
        (F.coalesce(F.max(run_version(col, prefix)), F.lit(0)) + F.lit(1)).alias("next_version"))


__all__ = ["write_bars", "read_bars", "in_file_order", "write_bucketed", "write_symbol_files", "scan_by_header", "read_or_empty", "write_versioned", "run_versions", "scan_bars_csv",
           "parse_klines", "symbol_list", "next_run_version", "BARS"]
