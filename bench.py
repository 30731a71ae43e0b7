"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed end to end into Spark's no-op sink (every row is
computed, nothing is collected to the driver). One untimed pass over all
queries warms the JVM; then $BENCH_REPEAT timed passes follow. Prints one JSON
line with the per-query median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearth.session import build_session  # noqa: E402
from hearth.bindings import load_all  # noqa: E402

HEADLINE = [
    "family_housing_tracker", "family_inventory", "family_hotness", "family_home_values", "family_rent_values",
    "family_investor_quarter", "family_weekly",
    "prior_from_ratio", "melt_wide_series", "fill_down_keyed", "fill_down_global", "duplicate_key_report",
    "surrogate_key", "lookup_left_join", "tagged_union", "preamble_skip", "freshness_gate", "json_key_values",
]


def transform_only_jobs(spark, sf_dir: str) -> dict:
    """The family transforms alone on landed frames staged once (untimed): the
    counterpart of the reference's transform-only timings (its SQL layers)."""
    from hearth.bindings import families as fb
    from hearth.plans import families as fam
    from hearth.plans import specs as S
    from hearth.session import stage

    tracker = stage(fb.tracker_landed(spark, sf_dir), "bench_tracker_landed")
    inventory = stage(fb.inventory_landed(spark, sf_dir), "bench_inventory_landed")
    hotness = stage(fb.hotness_landed(spark, sf_dir), "bench_hotness_landed")
    return {
        "tracker_layers_on_landed": lambda: fam.tracker_transform(tracker, fb.RUN_TS),
        "inventory_transform_on_landed": lambda: fam.inventory_transform(inventory, S.INVENTORY_GEOGRAPHIES["zip"],
                                                                         fb.RUN_TS),
        "hotness_transform_on_landed": lambda: fam.hotness_transform(hotness, S.HOTNESS_GEOGRAPHIES["zip"], fb.RUN_TS),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [k for k in os.environ.get("BENCH_ONLY", "").split(",") if k]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="hearth-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    reg = load_all()
    jobs = {k: (lambda k=k: reg[k].fn(spark, sf_dir)) for k in (only or HEADLINE)}
    failed: dict[str, str] = {}
    if not only:
        try:
            jobs.update(transform_only_jobs(spark, sf_dir))
        except Exception as e:  # the headline queries are still measured
            failed["transform_only_setup"] = f"{type(e).__name__}: {str(e)[:200]}"
    keys = list(jobs)
    runs: dict[str, list[float]] = {k: [] for k in keys}
    for i in range(repeat + 1):
        for key in keys:
            if key in failed:
                continue
            t = time.perf_counter()
            try:
                jobs[key]().write.format("noop").mode("overwrite").save()
            except Exception as e:  # record and keep measuring the others
                failed[key] = f"{type(e).__name__}: {str(e)[:200]}"
                continue
            if i:
                runs[key].append(time.perf_counter() - t)
    times = {k: round(statistics.median(v), 3) for k, v in runs.items() if v and k not in failed}
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_total_warm_median", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
