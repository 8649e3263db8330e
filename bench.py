"""Bench: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line with per-query seconds.

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One untimed warm-up run of
the flagship query on the smallest tables first keeps JVM start-up and JIT
warm-up out of the first timed query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.queries import QUERIES  # noqa: E402
from lodestar.session import get_session  # noqa: E402

HEADLINE = [
    "resolve_lineitem", "resolve_generated", "resolve_full", "resolve_blocked", "mapping_log", "method_breakdown",
    "link_top8", "enrich_links", "refill_links", "overmatch_clear",
    "parse_dates", "relative_dates", "fresh_24h", "ingest_funnel",
    "first_wins_dedupe", "category_dedupe", "capped_pages", "resume_anti",
    "job_records", "news_records", "atom_source", "startup_records", "product_build",
    "pricing_from_replies", "truncate_text", "collapse_space", "strip_markup", "extract_refs",
    "quality_profile", "validate_quarantine",
    "papers_flow", "export_papers", "stream_dedupe",
]


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["method_breakdown"](spark, warm).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in names:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - one failure must not lose the report
            failed[name] = str(e).splitlines()[0][:200]
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr)
            continue
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf.rstrip("/"))
    out = {"metric": "headline_total", "value": total, "unit": "sec",
           "queries": times, "sf": sf_name.replace("sf", "")}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
