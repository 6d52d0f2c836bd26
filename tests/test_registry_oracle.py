"""Every registered query against its DuckDB oracle (as the driver does), at sf0.001."""
import datetime
import decimal
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tickframe.plans import load_all

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
NAMES = sorted(load_all())  # the corpus operators have tests of their own
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, float):
        return (2, repr(v + 0.0))
    if isinstance(v, decimal.Decimal):
        return (2, repr(float(v)))
    if isinstance(v, int):
        return (3, v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return (4, v.isoformat())
    return (5, str(v))


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = {n for n in NAMES if n not in ORACLE}
    assert rows_only <= {"wallet_json", "train_gbt"}, rows_only


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    rows = df.collect()
    assert len(set(cols)) == len(cols)
    if name not in ORACLE:
        return
    cur = con.execute(ORACLE[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    a = Counter(tuple(_canon(r[cols.index(c)]) for c in order) for r in rows)
    b = Counter(tuple(_canon(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b, (list((a - b).items())[:2], list((b - a).items())[:2])
