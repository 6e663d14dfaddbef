"""Time the headline queries on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from sleevework.plans.catalog import all_queries
from sleevework.session import local_session

HEADLINE = (
    "flagship_track_credits", "n4_block_context", "n9_assemble_enrichment", "n11_run_backends", "v9_normalize_role", "v11_parse_track_set",
    "q1_canonical", "q4_score", "q6_scorecard", "q7_coverage", "q8_match_credits", "q10_rank_backends", "q11_nway_diff",
    "c7_retry_outcome", "c8_throttle_wait", "d7_foreign_key", "p2_tokenise", "p15_refs", "p18_assemble_album", "p20_search_rows", "n15_validate_replies",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "8g"))
    runs = all_queries()
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start the executors outside the clock
    times: dict[str, float] = {}
    for name in HEADLINE:
        if name in runs:
            start = time.perf_counter()
            runs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cores)}))
    spark.stop()


if __name__ == "__main__":
    main()
