"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS].  Each query runs to completion into the no-op sink
(full computation, nothing collected).  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "event_search",
    "units_affected_per_year",
    "match_days_state",
    "match_spans",
    "event_map",
    "event_key_mint",
    "locations_table",
    "impute_end",
    "impact_pivot_killed",
    "duration_pivot",
    "rewrite_rules",
    "gazetteer_match",
    "fill_updown",
    "collapse_days",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from eventweave.plans.catalog import queries
    from eventweave.session import local_session

    # one shuffle partition per core locally; AQE coalesces further (a cluster
    # sets its own, much larger, spark.sql.shuffle.partitions)
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app="eventweave-bench")
    qs = queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
