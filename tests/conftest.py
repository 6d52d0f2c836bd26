import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickframe.session import get_spark
    s = get_spark("local[4]", 8, app="tickframe-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def series_df(spark, values, symbol="s", col="x"):
    """One series: open_time = epoch + i days."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(symbol, t0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"symbol string, open_time timestamp_ntz, {col} double")


def bars_df(spark, rows, symbol="s"):
    """rows: (open, high, low, close, volume) per day."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    data = [(symbol, t0 + dt.timedelta(days=i), *map(float, r)) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double")
