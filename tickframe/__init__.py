"""tickframe: bar-series (OHLCV) analytics as Spark DataFrame operators.

Every public operator takes and returns a DataFrame keyed by
``(symbol, open_time)``; per-symbol order is expressed with window specs,
never with driver-side loops.
"""

from tickframe.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
