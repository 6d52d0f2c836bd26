"""Headline benchmark: prints ONE JSON line.

1,000 symbols, ~533k bars at sf0.1): research enrichment, live enrichment,
the upsert of a live update, the trade ledger and the top-N signal table.
Each query is executed in full with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickframe.operators import dataset as ds  # noqa: E402
from tickframe.operators import features as feat  # noqa: E402
from tickframe.operators import signals as sg  # noqa: E402
from tickframe.operators import trades as tr  # noqa: E402
from tickframe.functions.windows import Parts  # noqa: E402
from tickframe.operators.parts import ENRICH  # noqa: E402
from tickframe.operators.upsert import upsert  # noqa: E402
from tickframe.plans.data_queries import upsert_inputs  # noqa: E402
from tickframe.plans.trading_queries import scored_latest, symbol_universe  # noqa: E402
from tickframe.plans.stub import stub_probability  # noqa: E402
from tickframe.session import get_spark  # noqa: E402
from tickframe.sources.fixtures import bars_s  # noqa: E402


def enrich_research(spark, sf):
    return feat.enrich_research(bars_s(spark, sf))


def enrich_live(spark, sf):
    return feat.enrich_live(bars_s(spark, sf))


def upsert_bars(spark, sf):
    old, new = upsert_inputs(spark, sf)
    return upsert(old, new, in_place=True)


def trade_ledger(spark, sf):
    df = ds.drop_incomplete(feat.enrich_research(bars_s(spark, sf)))
    s = sg.signal_flag(sg.score(df, stub_probability), 0.49)
    flags = s.select("symbol", "open_time", "close", (F.col("signal") != 0).alias("entry"),
                     (F.col("signal") == 0).alias("exit"))
    return tr.trade_ledger(flags)


def top_signals(spark, sf):
    return sg.top_signals(scored_latest(spark, sf), symbol_universe(spark, sf), 20)


QUERIES = {"enrich_research": enrich_research, "enrich_live": enrich_live, "upsert_bars": upsert_bars,
           "trade_ledger": trade_ledger, "top_signals": top_signals}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app="tickframe-bench",
                      extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    n_bars = bars_s(spark, sf).count()
    # warm-up, not timed: JIT and codegen of every query on the smallest test tables
    warm_dir = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        for fn in QUERIES.values():
            fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in QUERIES.items():
        t0 = time.time()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    # cost of parts so short that every series has two or more, reported apart from the total
    t0 = time.time()
    feat.enrich_research(bars_s(spark, sf), parts=Parts(rows=300, back=ENRICH.back, fwd=ENRICH.fwd)).write.format("noop").mode("overwrite").save()
    short = round(time.time() - t0, 3)
    print(json.dumps({"metric": "bars_s_workload_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "bars": n_bars,
                      "enrich_research_bars_per_sec": round(n_bars / times["enrich_research"], 1),
                      "enrich_research_short_parts_sec": short,
                      "local_cpus": int(cpus), "spark": spark.version}))


if __name__ == "__main__":
    main()
