"""Registered queries: sources, sinks and scalar functions."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tickframe.functions import text as tx
from tickframe.functions.expr import ieee_div
from tickframe.plans.catalog import DIGITS, finish, register
from tickframe.plans.sqlkit import div, rnd
from tickframe.schemas import BAR_COLS
from tickframe.session import checkpoint_dir
from tickframe.sources import files
from tickframe.sources.fixtures import BARS_H_SQL, BARS_S_SQL, bars_h, bars_s, table

K = ["symbol", "open_time"]
D6 = DIGITS["bars_h"]


# ---- file names -> symbols --------------------------------------------------

def _file_names(spark, sf):
    syms = bars_s(spark, sf).select("symbol").distinct()
    a = syms.select(F.concat(F.lit("analise_v2_"), "symbol", F.lit("_4h.csv")).alias("name"))
    b = syms.select(F.concat("symbol", F.lit("_4h.csv")).alias("name"))
    c = table(spark, sf, "pages").select(tx.basename("url").alias("name"))
    return a.unionByName(b).unionByName(c)


_NAMES_SQL = (f"bs AS ({BARS_S_SQL}), syms AS (SELECT DISTINCT symbol FROM bs), names AS ("
              "SELECT 'analise_v2_' || symbol || '_4h.csv' AS name FROM syms UNION ALL "
              "SELECT symbol || '_4h.csv' FROM syms UNION ALL "
              "SELECT regexp_extract(url, '[^/]*$') FROM pages)")


@register("symbol_from_path", f"WITH {_NAMES_SQL} SELECT name, "
                              "regexp_replace(regexp_replace(name, '^analise_v2_', ''), '_[^_]*$', '') AS symbol FROM names")
def q_symbol_from_path(spark, sf):
    return _file_names(spark, sf).select("name", tx.symbol_from_file_name("name").alias("symbol"))


@register("strip_prefix", f"WITH {_NAMES_SQL} SELECT name, starts_with(name, 'analise_v2_') AS should_rename, "
                          "CASE WHEN starts_with(name, 'analise_v2_') THEN substr(name, 12) ELSE name END AS new_name "
                          "FROM names")
def q_strip_prefix(spark, sf):
    has, new = tx.strip_prefix(F.col("name"), "analise_v2_")
    return _file_names(spark, sf).select("name", has.alias("should_rename"), new.alias("new_name"))


_RUN_NAMES = ("SELECT 'trades_log_v' || CAST(page_id AS VARCHAR) || '_total.csv' AS name FROM pages "
              "WHERE url LIKE 'https%' UNION ALL SELECT 'report_v' || CAST(page_id AS VARCHAR) || '.html' FROM pages")


@register("next_run_version", f"WITH names AS ({_RUN_NAMES}) SELECT coalesce(max(CAST(regexp_extract(name, "
                              "'trades_log_v(\\d+)', 1) AS BIGINT)), 0) + 1 AS next_version FROM names "
                              "WHERE starts_with(name, 'trades_log_v')")
def q_next_run_version(spark, sf):
    p = table(spark, sf, "pages")
    names = (p.filter(F.col("url").startswith("https"))
              .select(F.concat(F.lit("trades_log_v"), F.col("page_id").cast("string"), F.lit("_total.csv")).alias("name"))
              .unionByName(p.select(F.concat(F.lit("report_v"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"))))
    return files.next_run_version(names)


# ---- symbol lists (JSON arrays, order kept) -------------------------------

def _list_docs(spark, sf):
    li = table(spark, sf, "lineitem")
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                    F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("sym"))
    docs = li.groupBy(F.col("l_orderkey").alias("list_id")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return docs.select("list_id", F.to_json(F.transform("items", lambda x: x["sym"])).alias("symbols"))


@register("symbol_list", "SELECT l_orderkey AS list_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY "
                         "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INTEGER) AS pos, "
                         "'S' || CAST(l_suppkey AS VARCHAR) AS symbol FROM lineitem")
def q_symbol_list(spark, sf):
    return files.symbol_list(_list_docs(spark, sf))


# ---- kline payloads ---------------------------------------------------------

def kline_payloads(spark, sf):
    """Wire-format payloads built from hourly bars: one JSON array per symbol
    and day (numbers as text, as the exchange sends them), plus one empty
    payload per symbol."""
    b = bars_h(spark, sf)
    ms = tx.to_epoch_ms("open_time")
    s = lambda c: F.col(c).cast("string")
    row = F.array(ms.cast("string"), s("open"), s("high"), s("low"), s("close"), s("volume"),
                  (ms + F.lit(3_599_999)).cast("string"), (F.col("close") * F.col("volume")).cast("string"),
                  F.col("volume").cast("long").cast("string"), F.lit("0"), F.lit("0"), F.lit("0"))
    day = F.to_date("open_time")
    full = b.groupBy("symbol", day.alias("d")).agg(F.to_json(F.collect_list(row)).alias("payload"))
    empty = b.select("symbol").distinct().select("symbol", F.lit(None).cast("date").alias("d"),
                                                 F.lit("[]").alias("payload"))
    return full.unionByName(empty)


@register("parse_klines", f"WITH bars AS ({BARS_H_SQL}) SELECT symbol, open_time, "
                          + ", ".join(f"{rnd(c, D6)} AS {c}" for c in BAR_COLS)
                          + ", open_time + INTERVAL 3599999 MILLISECOND AS close_time, "
                          "CAST(volume AS BIGINT) AS trades FROM bars")
def q_parse_klines(spark, sf):
    k = files.parse_klines(kline_payloads(spark, sf))
    return finish(k.select(*K, *BAR_COLS, "close_time", "trades"), D6)


# ---- CSV sink + scan round trip ---------------------------------------------

@register("scan_bars_csv", f"WITH bars AS ({BARS_H_SQL}) SELECT symbol, open_time, "
                           + ", ".join(f"{rnd(c, D6)} AS {c}" for c in BAR_COLS) + " FROM bars")
def q_scan_bars_csv(spark, sf):
    path = os.path.join(checkpoint_dir(spark), f"bars-csv-{uuid.uuid4().hex}")
    files.write_bars(bars_h(spark, sf), path, fmt="csv")
    return finish(files.read_bars(spark, path, fmt="csv"), D6)


# ---- scalar functions --------------------------------------------------------

@register("scalar_functions", f"WITH bars AS ({BARS_H_SQL}) SELECT symbol, open_time, upper(symbol) || 'USDT' AS pair, "
                              "CAST(isodow(open_time) - 1 AS INTEGER) AS day_of_week, CAST(hour(open_time) AS INTEGER) AS hour_of_day, "
                              "CAST(epoch_ms(open_time) AS BIGINT) AS open_ms, "
                              "make_timestamp(epoch_ms(open_time) * 1000) = open_time AS ms_round_trip, "
                              f"{rnd('abs(close - open)', D6)} AS abs_move, {rnd('greatest(open, close)', D6)} AS body_top, "
                              f"{rnd('least(open, close)', D6)} AS body_bottom, CAST(floor(volume / 2) AS BIGINT) AS half_volume, "
                              f"{rnd(div('close - open', 'high - low'), D6)} AS body_ratio, "
                              f"{rnd('(close / open - 1.0) * 100.0', D6)} AS pct_change FROM bars")
def q_scalar_functions(spark, sf):
    b = bars_h(spark, sf)
    ms = tx.to_epoch_ms("open_time")
    c, o = F.col("close"), F.col("open")
    return finish(b.select(
        *K, tx.symbol_with_quote("symbol").alias("pair"),
        F.weekday("open_time").cast("int").alias("day_of_week"), F.hour("open_time").cast("int").alias("hour_of_day"),
        ms.cast("bigint").alias("open_ms"), (tx.from_epoch_ms(ms) == F.col("open_time")).alias("ms_round_trip"),
        F.abs(c - o).alias("abs_move"), F.greatest(o, c).alias("body_top"), F.least(o, c).alias("body_bottom"),
        F.floor(F.col("volume") / 2).cast("bigint").alias("half_volume"),
        ieee_div(c - o, F.col("high") - F.col("low")).alias("body_ratio"),
        ((c / o - F.lit(1.0)) * F.lit(100.0)).alias("pct_change")), D6)
