"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and
print one JSON line. Each query is executed to completion with the no-op sink
(the whole plan runs, nothing is collected to the driver).

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (runs per query, median reported; default 1),
     BENCH_QUERIES (comma list; default the headline set below).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "action_flatten", "behavior_merge", "interest_weight", "user_age", "upsert_by_key", "article_sentence",
    "tokens", "vocab_idf", "tfidf_top20", "textrank_top20", "user_topic_weight", "similar_top10",
    "content_recall", "recall_latest", "user_channel_features", "ctr_training_set", "als_recall",
    "online_recall",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from newsloom.session import build_session
    from newsloom.plans.catalog import QUERIES
    from newsloom.sources.tables import SCAN_PARTITIONS

    # the tables here are one row group each, which Spark cannot split: spread the scans explicitly
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="newsloom-bench",
                          extra={SCAN_PARTITIONS: str(cpus * 2)})
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
