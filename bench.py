"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores. The inputs the jobs
read in production as stored tables (raw records, vocabulary, export, profiles) are
written before the clock starts. Queries of under ``REPEAT_BELOW`` seconds run twice, and the
better time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from plumefeed import drop_work, session
from plumefeed.plans import tables
from plumefeed.plans.catalog import QUERIES

REPEAT_BELOW = 10

HEADLINE = [
    "csv_adapt",
    "encode_tokens",
    "clean_posts",
    "dedup_exact",
    "embed_hashed",
    "profiles_hashed",
    "profile_lengths",
    "upsert_latest",
    "knn_topk",
    "candidate_scores",
    "jaccard_turns",
    "near_dup_greedy",
    "feed",
    "feed_hashed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    tables.vocab(spark, sf_dir)
    tables.raw_path(spark, sf_dir)
    tables.export_path(spark, sf_dir)
    tables.judged_profiles(spark, sf_dir)
    tables.points(spark, sf_dir)
    times = {}
    for name in HEADLINE:
        runs = []
        while not runs or (len(runs) < 2 and runs[0] < REPEAT_BELOW):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        print(name, [round(r, 1) for r in runs], file=sys.stderr, flush=True)
        times[name] = round(min(runs), 3)
    drop_work(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
