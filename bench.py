"""Headline-query timings.

Runs the headline queries at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is executed in full through the ``noop`` sink (every stage
runs, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from recsmith.plans import model_q, registry  # noqa: E402
from recsmith.session import local_session  # noqa: E402

HEADLINE = [
    "top_titles",
    "export_ratings",
    "precision_recall_curve",
    "similar_items",
    "build_rec_lists",
    "als_precision_recall",
    "extract_items",
    "extract_profile",
    "crawl_status",
    "new_ratings",
    "assign_item_ids",
    "quota_pages",
    "upsert_user_recs",
    "serve_similar",
    "stream_ingest_pages",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    spark = local_session(cpus, app="recsmith-bench")
    registry.load_all()
    # Warm-up (not timed): JVM code paths and the Python workers that the
    # pandas-based operators reuse.
    spark.range(1000).selectExpr("sum(id)").collect()
    spark.range(0, 10_000, 1, int(cpus)).mapInPandas(lambda it: it, "id long").write.format("noop") \
        .mode("overwrite").save()
    from pyspark.ml.recommendation import ALS  # load Spark ML's ALS code paths on a tiny input
    tiny = spark.range(2000).selectExpr("CAST(id % 50 AS INT) AS userId", "CAST(id % 40 AS INT) AS movieId",
                                        "CAST(id % 5 + 1 AS INT) AS rating")
    ALS(rank=2, maxIter=1, userCol="userId", itemCol="movieId", ratingCol="rating", seed=1).fit(tiny) \
        .recommendForAllUsers(2).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        df = (model_q.RAW.get(name) or registry.QUERIES[name])(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
