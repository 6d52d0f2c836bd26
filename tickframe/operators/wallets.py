"""Stored wallets: many wallets in one table, written only if they changed.

A wallet is its rows (wallet_id, cash_usdt, symbol, buy_price, qty, peak_price); one without positions is a row whose
symbol is NULL.  Its checksum does not depend on the order of the rows.  ``save_wallets`` compares the checksums of
the stored and the given wallets; if none differs, nothing is written.  Else the next version of the table is
written beside the old one and published by renaming one folder, so a reader sees the old wallets or the new ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "wallet_id long, cash_usdt double, symbol string, buy_price double, qty double, peak_price double"
COLUMNS = ["wallet_id", "cash_usdt", "symbol", "buy_price", "qty", "peak_price"]


def checksums(wallets: DataFrame) -> DataFrame:
    """(wallet_id, n_rows, checksum): row hashes added up, so any order of rows gives the same."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in COLUMNS]).cast("decimal(20,0)")
    return wallets.groupBy("wallet_id").agg(F.count("*").alias("n_rows"), F.sum(row).alias("checksum"))


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm.getFileSystem(spark._jsc.hadoopConfiguration()), jvm


def wallet_version(spark: SparkSession, path: str) -> int:
    fs, folder = _files(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), default=0)


def read_wallets(spark: SparkSession, path: str) -> DataFrame:
    """The newest stored wallets with the version in which each was last written."""
    version = wallet_version(spark, path)
    schema = f"{SCHEMA}, written int"
    return spark.read.schema(schema).parquet(f"{path}/version={version}") if version else spark.createDataFrame([], schema)


def save_wallets(wallets: DataFrame, path: str) -> int:
    """Stores the given wallets, keeps the stored ones that are not given, and returns the table's version."""
    spark = wallets.sparkSession
    version, stored = wallet_version(spark, path), read_wallets(spark, path)
    same = ["wallet_id", "n_rows", "checksum"]
    changed = checksums(wallets.select(COLUMNS)).join(checksums(stored), same, "left_anti").select("wallet_id")
    if changed.isEmpty():
        return version
    new = wallets.select(COLUMNS).join(changed, "wallet_id", "left_semi").withColumn("written", F.lit(version + 1))
    kept = stored.join(changed, "wallet_id", "left_anti")
    held = f"{path.rstrip('/')}/_{uuid.uuid4().hex}"
    new.unionByName(kept).write.parquet(held)
    fs, source = _files(spark, held)
    target = _files(spark, f"{path}/version={version + 1}")[1]
    if fs.exists(target) or not fs.rename(source, target):
        raise RuntimeError(f"version {version + 1} was published by another writer")
    return version + 1


def wallet_documents(wallets: DataFrame) -> DataFrame:
    """(wallet_id, wallet): each wallet as a JSON document with the reference's field names, positions by token."""
    held = F.struct(F.col("symbol").alias("token"), F.col("buy_price").alias("preco_compra"), F.col("qty").alias("quantidade"), F.col("peak_price").alias("peak_price"))
    docs = wallets.groupBy("wallet_id", "cash_usdt").agg(F.array_sort(F.collect_list(F.when(F.col("symbol").isNotNull(), held))).alias("positions"))
    return docs.select("wallet_id", F.to_json(F.struct("cash_usdt", "positions")).alias("wallet"))
