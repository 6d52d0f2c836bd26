"""Results do not depend on partition count or input order."""
from conftest import SF_SMALL

from tickframe.operators import features as feat
from tickframe.plans.catalog import finish
from tickframe.sources.fixtures import bars_s


def _rows(df):
    return sorted(tuple(r) for r in finish(df, 6).collect())


def test_enrichment_independent_of_partitioning(spark):
    b = bars_s(spark, SF_SMALL)
    base = _rows(feat.enrich_live_all(b, min_bars=0))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        shuffled = b.repartition(7).orderBy("volume")          # different input order and layout
        again = _rows(feat.enrich_live_all(shuffled, min_bars=0))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert base == again
