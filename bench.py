"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "headline_total", "value": sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is built and fully executed with a no-op write (no driver collect). The
first pass over all of them (cold code and file listings) is reported as ``first_run``;
after it the best of three runs is kept. The naive item planner
(theta join + two row_numbers) runs next to the prefix planner, in both orders,
as the baseline.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_item_planner", "q_planner_tiers", "q_planner_easy", "q_planner_filtered", "q_planner_cube",
    "q_rank_xp", "q_cycles_to_target", "q_level_report", "q_vlookup_first",
    "q_pages_blocks", "q_pages_details", "q_html_table_rows", "q_take_while_pages", "q_page_counts",
    "q_surrogate_id", "q_chunk_export", "q_json_records", "q_csv_roundtrip", "q_bad_records",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, spark, sf_dir) -> float:
    t0 = time.perf_counter()
    run(fn(spark, sf_dir))
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from slotplan.session import local_session
    from slotplan.plans.catalog import QUERIES
    from slotplan.plans.q_items import item_planner, item_planner_naive

    spark = local_session(cpus, shuffle_partitions=2 * cpus, app="slotplan-bench")
    names = [n for n in HEADLINE if n in QUERIES]
    only = os.environ.get("BENCH_ONLY")
    if only:
        names = [n for n in names if n in only.split(",")]

    # first pass: JIT, codegen caches and file listings are cold
    first = {n: round(timed(QUERIES[n], spark, sf_dir), 3) for n in names}
    run(item_planner_naive(spark, sf_dir))

    res: dict[str, float] = {}
    for n in names:
        res[n] = round(min(timed(QUERIES[n], spark, sf_dir) for _ in range(3)), 3)

    # baseline pair, both orders
    a1 = timed(item_planner, spark, sf_dir)
    b1 = timed(item_planner_naive, spark, sf_dir)
    b2 = timed(item_planner_naive, spark, sf_dir)
    a2 = timed(item_planner, spark, sf_dir)
    res["baseline_item_planner_prefix"] = round(min(a1, a2), 3)
    res["baseline_item_planner_naive"] = round(min(b1, b2), 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    total = round(sum(v for k, v in res.items() if not k.startswith("baseline_")), 3)
    runs = {"order": "prefix, naive, naive, prefix",
            "prefix": [round(a1, 3), round(a2, 3)], "naive": [round(b1, 3), round(b2, 3)]}
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": res, "sf": sf, "cpus": cpus, "baseline_runs": runs,
                      "first_run": first}))
    spark.stop()


if __name__ == "__main__":
    main()
