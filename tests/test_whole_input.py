"""Queries on rows of their own that a smaller job would leave out."""
import datetime as dt

import duckdb

import __spark_entry__ as E


def _same_rows(spark, folder, table, query):
    got = E.queries()[query](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    want = con.execute(f"SELECT symbol, count(*) FROM ({E.oracle_sql()[query]}) GROUP BY symbol").fetchall()
    found = {r.symbol: r["count"] for r in got.groupBy("symbol").count().collect()}
    assert found == dict(want)
    return found


def test_min_history_keeps_symbols_of_any_name(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, kind, t0 + dt.timedelta(hours=i), float(i)) for kind, n in (("abc", 260), ("abcd", 250), ("few", 249)) for i in range(n)]
    spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert _same_rows(spark, tmp_path, "events", "min_history") == {"abc": 260, "abcd": 250}


def test_first_n_symbols_takes_the_reference_count(spark, tmp_path):
    day = dt.datetime(1995, 1, 1)
    rows = [(k, 1, 1, k, 1.0, 100.0 + k, day) for k in range(1, 701)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                                "l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert len(_same_rows(spark, tmp_path, "lineitem", "first_n_symbols")) == 690


def test_gbt_rounds_do_not_depend_on_the_input_partitions(spark, monkeypatch):
    from tickframe.operators import ml
    rows = spark.range(400, numPartitions=97).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 2 AS INT) AS target")
    dealt = []
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, df: dealt.append((df.rdd.getNumPartitions(), df.count())))
    ml.train_gbt(rows, ["a"], "target")
    assert dealt == [(1, 400)]
    monkeypatch.setattr(ml, "ROWS_PER_TASK", 100)
    ml.train_gbt(rows, ["a"], "target")
    assert dealt[1] == (4, 400)
