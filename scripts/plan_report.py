"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python scripts/plan_report.py [sf_dir] [out.md]

Per query: shuffles (Exchange), broadcasts, partial top-k (WindowGroupLimit,
TakeOrderedAndProject), Python steps (ArrowEvalPython), filters pushed to
the parquet scan and the columns the scan reads.  Model-fit queries are
listed without a plan (building them runs the fit).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.plans.registry import REGISTRY  # noqa: E402
from revlens.session import local_session  # noqa: E402

SKIP = {"als_recommendations", "als_recommendations_by_price", "als_metrics", "als_facts", "als_variant_metrics"}


def summarise(plan: str) -> dict:
    """Counts from an ``explain("formatted")`` string."""

    def nodes(name: str) -> int:
        return len(re.findall(rf"^\(\d+\) {name}\b", plan, flags=re.M))

    scans = re.findall(r"^ReadSchema: struct<(.*)>$", plan, flags=re.M)
    pushed = re.findall(r"^PushedFilters: \[(.*)\]$", plan, flags=re.M)
    return {
        "shuffles": nodes("Exchange"),  # BroadcastExchange is a different node name
        "broadcasts": nodes("BroadcastExchange"),
        "partial_topk": nodes("WindowGroupLimit") // 2 + nodes("TakeOrderedAndProject"),
        "python": nodes("ArrowEvalPython"),
        "scan_columns": sorted({c.split(":")[0] for s in scans for c in re.split(r",(?![^<]*>)", s) if c}),
        "pushed": sorted({p for ps in pushed for p in re.split(r", (?![^(]*\))", ps) if p}),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session(8)
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `scripts/plan_report.py` at `{os.path.basename(sf_dir)}` (AQE on; the initial plan).",
        "Shuffles count Exchange nodes (a broadcast is counted apart); partial top-k counts WindowGroupLimit",
        "pairs (partial before the shuffle + final) and TakeOrderedAndProject.",
        "",
        "| Query | Shuffles | Broadcasts | Partial top-k | Python steps | Scan columns | Pushed filters |",
        "| --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name, (fn, _sql) in REGISTRY.items():
        if name in SKIP:
            lines.append(f"| `{name}` | - | - | - | - | (model fit: Spark ALS) | - |")
            continue
        df = fn(spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarise(plan)
        lines.append(
            f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['partial_topk']} | {s['python']} | "
            f"{', '.join(s['scan_columns'])} | {', '.join(s['pushed'])} |"
        )
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
