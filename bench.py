"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default the headline set),
     BENCH_PARTITIONS (shuffle partitions, default 2 x cpus).
Each query runs to completion through a ``noop`` write (no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelrank.plans.queries import QUERIES  # noqa: E402
from reelrank.session import local_session  # noqa: E402

HEADLINE = [
    "user_knn", "item_similarity", "two_hop_scores", "item_knn", "unseen_pair_scores",
    "blend_recommendations", "als_recommend", "mf_recommend", "hybrid_recommendations",
    "review_sentiment", "clean_text", "index_ids", "topn_per_user", "sample_n",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, partitions=int(os.environ.get("BENCH_PARTITIONS", 2 * cpus)),
                          app="reelrank-bench")
    # warm-up (not timed): JVM code paths, parquet footers, and one Python
    # worker per core (workers are reused by later Arrow tasks)
    QUERIES["user_item_ratings"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    (spark.range(cpus * 4).repartition(cpus, "id").groupBy("id")
     .applyInPandas(lambda pdf: pdf, "id long").write.format("noop").mode("overwrite").save())
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
