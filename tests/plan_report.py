"""Summarise the final physical plans of the headline queries (writes PLANS.md).

``python tests/plan_report.py [sf_dir]`` runs each query to a ``noop`` sink and
reads the adaptive plan after execution.
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

QUERIES = ("sales_extract", "remove_outliers", "continuous_items", "price_bands", "avg_price",
           "price_bands_multi", "avg_price_multi", "report_lists_prices")


def summarise(plan: str) -> dict:
    return {
        "hash exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range exchanges": len(re.findall(r"Exchange rangepartitioning", plan)),
        "broadcast hash joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "generate (explode)": plan.count("Generate "),
        "parquet scans": len(re.findall(r"FileScan parquet", plan)),
    }


def main(argv):
    from __spark_entry__ import queries
    from rosband.session import local_session

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    q = queries()
    lines = [
        "# Physical plans of the headline queries",
        "",
        f"Final adaptive plans after execution on `{sf}` (`python tests/plan_report.py`). Counts are for the last",
        "job of each query; the jobs before it write the materialised intermediates (extract, outlier statistics,",
        "edges, band grain) which the last job reads back as Parquet scans.",
        "",
    ]
    rows = []
    for name in QUERIES:
        df = q[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarise(plan)))
    keys = list(rows[0][1])
    lines.append("| query | " + " | ".join(keys) + " |")
    lines.append("| --- |" + " --- |" * len(keys))
    for name, s in rows:
        lines.append(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + " |")
    lines.append("")
    df = q["price_bands"](spark, sf)
    lines += ["## price_bands, formatted", "", "```", df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n\n(1)")[0], "```", ""]
    with open(os.path.join(os.path.dirname(HERE), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines))
    print("\n".join(lines[:20]))


if __name__ == "__main__":
    main(sys.argv)
