"""Bar tables derived from the driver's test tables (FIXTURES.md part 2).

No bar data ships with the reference, so test bars are aggregated from
``lineitem`` (daily bars) and ``events`` (hourly bars).  The derivation is an
ordinary grouped aggregate: partial aggregation happens map side before the
shuffle on ``(symbol, open_time)``; open/close are ``min_by``/``max_by`` on a
total order key, so the result does not depend on file or task order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ohlcv(df: DataFrame, price, volume, key) -> DataFrame:
    return (df.groupBy("symbol", "open_time")
              .agg(F.min_by(price, key).alias("open"), F.max(price).alias("high"),
                   F.min(price).alias("low"), F.max_by(price, key).alias("close"),
                   volume.alias("volume")))


def _lineitem_bars(spark, sf_dir, symbol, combine: bool = True) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    if not combine:
        li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       "l_shipdate", symbol.alias("_symbol")).repartition("_symbol", "l_shipdate")
        symbol = F.col("_symbol")
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                   "l_quantity", "l_extendedprice")
    src = li.select(symbol.alias("symbol"), F.col("l_shipdate").alias("open_time"),
                    (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                    "l_quantity", key.alias("k"))
    return _ohlcv(src, F.col("price"), F.sum("l_quantity").cast("double"), F.col("k"))


def bars_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per return flag (3 long series)."""
    return _lineitem_bars(spark, sf_dir, F.col("l_returnflag"))


def bars_s(spark: SparkSession, sf_dir: str, combine: bool = True) -> DataFrame:
    """Daily bars per supplier (many short series; the bench table).

    Without ``combine`` the line items are shuffled as they are.  Of a bar of few line items the partial aggregate
    is larger than they are; the exchange then is no larger than the table, however many a bar has."""
    return _lineitem_bars(spark, sf_dir, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), combine)


def bars_h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars per event type."""
    ev = table(spark, sf_dir, "events")
    src = ev.select(F.col("event_type").alias("symbol"),
                    F.window("ts", "1 hour").start.alias("open_time"),
                    F.col("value").alias("price"), F.struct("ts", "event_id").alias("k"))
    return _ohlcv(src, F.col("price"), F.count(F.lit(1)).cast("double"), F.col("k"))


# DuckDB text of the same derivations, for oracle queries.
def _lineitem_bars_sql(symbol_sql: str) -> str:
    key = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)"
    return f"""SELECT {symbol_sql} AS symbol, l_shipdate AS open_time,
       arg_min(l_extendedprice / l_quantity, {key}) AS open,
       max(l_extendedprice / l_quantity) AS high,
       min(l_extendedprice / l_quantity) AS low,
       arg_max(l_extendedprice / l_quantity, {key}) AS close,
       CAST(sum(l_quantity) AS DOUBLE) AS volume
FROM lineitem GROUP BY 1, 2"""


BARS_D_SQL = _lineitem_bars_sql("l_returnflag")
BARS_S_SQL = _lineitem_bars_sql("'S' || CAST(l_suppkey AS VARCHAR)")
BARS_H_SQL = """SELECT event_type AS symbol, time_bucket(INTERVAL '1 hour', ts) AS open_time,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM events GROUP BY 1, 2"""

FIXTURES = {"bars_d": (bars_d, BARS_D_SQL), "bars_s": (bars_s, BARS_S_SQL),
            "bars_h": (bars_h, BARS_H_SQL)}
