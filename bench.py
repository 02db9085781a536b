"""Benchmark the headline queries.

Runs each query of HEADLINE over $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] and prints one JSON line.  Each query is executed in
full through the ``noop`` sink (no rows are collected to the driver); the
time includes planning and any fitting the query does.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagloom.plans.registry import load_all  # noqa: E402
from tagloom.session import get_session  # noqa: E402

HEADLINE = [
    "tag_top50",
    "metadata_tag_tokens",
    "language_histogram",
    "score_topk",
    "score_sentinel",
    "label_top50",
    "index_listing",
    "image_lots",
    "listed_image_scores",
    "infer_labels_from_tags",
    "infer_labels_from_tags_depth8",
    "prediction_stats",
    "stream_classification",
    "stream_top25",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="tagloom-bench")
    reg = load_all()
    # Warm-up: JVM start and first job are not part of any query.
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        t0 = time.time()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
