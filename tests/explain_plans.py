"""Print the physical-plan facts for chosen keys: python tests/explain_plans.py [sf_dir] [key ...]"""

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")
from hearth.session import build_session  # noqa: E402
from hearth.bindings import load_all  # noqa: E402

KEYS = ["prior_from_ratio", "period_range_filter", "family_housing_tracker", "fill_down_keyed", "lookup_left_join",
        "melt_wide_series", "duplicate_key_report", "json_key_values"]

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
keys = sys.argv[2:] or KEYS
spark = build_session("local[8]", 16)
reg = load_all()
for k in keys:
    df = reg[k].fn(spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        reg[k].fn(spark, sf).explain("formatted")
    text = buf.getvalue()
    scans = re.findall(r"^(?:PushedFilters|ReadSchema): ([^\n]*)$", text, flags=re.M)
    print(f"== {k}")
    print("   exchanges:", len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", plan)),
          "| reused:", plan.count("ReusedExchange"), "| broadcast joins:", plan.count("BroadcastHashJoin"),
          "| sort-merge joins:", plan.count("SortMergeJoin"), "| codegen stages:", len(set(re.findall(r"\*\((\d+)\)", plan))))
    for line in scans:
        print(f"   {line[:150]}")
