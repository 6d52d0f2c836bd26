"""The fixed scorer of the registered queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stub_probability(df: DataFrame) -> Column:
    """Fixed logistic expression used as a deterministic test scorer (our own
    stub, so scoring operators have an exact SQL oracle).  On the fixtures it crosses the
    threshold both ways, so every branch downstream occurs."""
    z = (F.lit(0.05) * (F.lit(50.0) - F.col("rsi_14")) + F.lit(0.03) * (F.lit(50.0) - F.col("stoch_k"))
         + F.lit(0.1) * F.col("bb_width") - F.lit(0.1))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


STUB_SQL = ("1.0 / (1.0 + exp(-(0.05 * (50.0 - rsi_14) + 0.03 * (50.0 - stoch_k) "
            "+ 0.1 * bb_width - 0.1)))")
