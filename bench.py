"""Headline-query bench: prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3, median reported; one warm-up run first).
Each query is executed in full with the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stayframe.operators import compare as G  # noqa: E402
from stayframe.operators import evaluate as E  # noqa: E402
from stayframe.plans.catalog import QUERIES  # noqa: E402
from stayframe.plans.q_clean_intervals import FAMILIES, W_H, _tagged  # noqa: E402
from stayframe.plans.q_eval_compare import _mw_long  # noqa: E402
from stayframe.operators import intervals as P  # noqa: E402
from stayframe.session import get_session  # noqa: E402
from stayframe.sources import adapters as ad  # noqa: E402


def bench_queries():
    return {
        "build_cohort": QUERIES["build_cohort"].build,
        "ts_features": QUERIES["ts_features"].build,
        "interval_features": QUERIES["interval_features"].build,
        "union_coverage": lambda s, d: P.union_coverage(_tagged(s, d), list(FAMILIES), W_H),
        "average_precision": lambda s, d: E.average_precision(ad.bench_predictions(s, d)),
        "auroc": lambda s, d: E.auroc(ad.bench_predictions(s, d)),
        "mann_whitney": lambda s, d: G.mann_whitney(_mw_long(s, d)),
        "embedding_features": QUERIES["embedding_features"].build,
        "train_classifier": QUERIES["train_classifier"].build,
    }


def run_once(spark, fn, sf_dir):
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", cpus, extra={"spark.driver.memory": "16g"})
    results = {}
    for name, fn in bench_queries().items():
        if only and name not in only:
            continue
        run_once(spark, fn, sf_dir)  # warm-up (JIT, file listing, caches)
        times = [run_once(spark, fn, sf_dir) for _ in range(repeats)]
        results[name] = round(statistics.median(times), 3)
        spark.catalog.clearCache()
    tag = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(tag)
    except ValueError:
        sf = tag
    print(json.dumps({"metric": "median_sec_per_query", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": sf, "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()
