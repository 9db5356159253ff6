"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row is
computed, nothing is collected to the driver). Prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
Set BENCH_QUERIES=all to time the whole catalogue.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "pair_count_latest", "pair_count_latest_any_type", "msg_dedup", "total_msgs_per_user", "group_count_latest",
    "conform_users", "contact_fanout_users", "region_lookup", "resolve_messages", "profile_generic",
    "profile_contacts", "profile_snapshot", "profile_merge_maps", "block_keys", "pair_scores", "merge_profiles",
    "rekey_messages", "link_flatten", "daily_counters", "counter_upsert", "to_cells", "mail_from_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from idweave.plans.catalog import QUERIES
    from idweave.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="idweave-bench")
    names = list(QUERIES) if os.environ.get("BENCH_QUERIES") == "all" else \
        [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["count_by_type"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
