"""Summarise the physical plan of every catalog query as a markdown table.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts come from the formatted explain of the (pre-AQE) physical plan: parquet
scans, shuffles (Exchange), broadcasts, sorts, windows, generators and Python UDF
nodes, plus whether any single-partition exchange appears and which filters reach
the scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.session import build_session  # noqa: E402
from feedlens.plans.catalog import registry  # noqa: E402


# queries that run a sink, a stream or a maintained table first and read its output
RUN_FIRST = {"stream_slot_metrics", "stream_alerts", "alert_history", "cube_rewrite", "feed_scan", "app_report_maintained"}


def tree(spark, df) -> str:
    jvm = spark.sparkContext._jvm
    s = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return s


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    print("| query | scans | shuffles | broadcasts | windows | single-partition windows (rows bound) "
          "| generate | python | global-agg merges | ts range at scan |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in registry().items():
        if name in RUN_FIRST:
            continue
        s = tree(spark, fn(spark, sf_dir))
        top = s.split("\n\n")[0]
        ops = re.findall(r"(\w+)(?: parquet)?\s+\((\d+)\)", top)
        count = lambda n: sum(1 for o, _ in ops if o == n)
        details = {m.group(1): m.group(2) for m in re.finditer(r"^\((\d+)\) (.*?)(?=^\(\d+\) |\Z)", s, re.M | re.S)}
        single = [i for o, i in ops if o == "Exchange" and "SinglePartition" in details.get(i, "")]
        # the operator above each single-partition exchange decides what it is
        seq = [(o, i) for o, i in ops]
        win_single = agg_single = 0
        for k, (o, i) in enumerate(seq):
            if o == "Exchange" and i in single:
                parents = [p for p, _ in seq[max(0, k - 2):k]]
                if "Window" in parents:
                    win_single += 1
                else:
                    agg_single += 1
        scan_lines = [ln for ln in s.splitlines() if ln.startswith("PushedFilters")]
        pushed = sum(1 for ln in scan_lines if re.search(r"(GreaterThanOrEqual|LessThan)\(ts,", ln))
        py = count("ArrowEvalPython") + count("BatchEvalPython")
        print(f"| `{name}` | {count('Scan')} | {count('Exchange')} | {count('BroadcastExchange')} | "
              f"{count('Window')} | {win_single} | {count('Generate')} | {py} | {agg_single} | "
              f"{pushed}/{len(scan_lines)} |")
    spark.stop()


if __name__ == "__main__":
    main()
