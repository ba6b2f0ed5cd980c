"""Write PLANS.md: facts from each registered query's final physical plan.

Usage: python scripts/plan_report.py [sf_dir]

Each query runs once (collect, at a small scale) so its adaptive plan is final; the report
counts shuffles, broadcasts, reused stages and Python stages, and lists what
each parquet scan reads (columns, pushed filters).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import tidings.plans  # noqa: E402, F401  (registers the queries)
from tidings.plans.registry import QUERIES  # noqa: E402
from tidings.session import get_spark  # noqa: E402


def _scans(plan: str) -> list[str]:
    out = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: \S+ \[?([^\],]*)"
                         r".*?PushedFilters: \[([^\]]*)\]", plan):
        cols = ", ".join(re.sub(r"#\d+L?", "", c).strip() for c in m.group(1).split(",") if c)
        table = os.path.basename(m.group(2).rstrip("]").strip()).replace(".parquet", "")
        pushed = m.group(3).strip()
        out.append(f"{table}({cols})" + (f" pushed [{pushed}]" if pushed else ""))
    return sorted(set(out))


def final_plan(df) -> str:
    """The executed plan's text without the initial plans that adaptive execution
    prints beside the final ones, in subqueries too. Run the query first."""
    out, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        at = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and (at >= skip or not at):   # 0: a literal's line break
            continue
        skip = at if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=16,
                      extra={"spark.driver.memory": "8g"})
    rows = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()   # executes this DataFrame's own plan, so AQE finalizes it
        plan = final = final_plan(df)
        shuffles = len(re.findall(r"\bExchange (hashpartitioning|RoundRobin|rangepartitioning|"
                                  r"SinglePartition)", final))
        rows.append((name, shuffles, final.count("BroadcastExchange"),
                     final.count("ReusedExchange") + final.count("ReusedQueryStage"),
                     len(re.findall(r"MapInArrow|ArrowEvalPython|BatchEvalPython", final)),
                     len(re.findall(r"WholeStageCodegen|\*\(\d+\)", final)) > 0,
                     "; ".join(_scans(plan))))
        print(name, rows[-1][1:5], flush=True)
    spark.stop()
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `scripts/plan_report.py` on `{sf_dir}` (local[8], AQE on). "
        "Counts are from the final adaptive plan, so broadcasts are AQE's runtime "
        "choices at this size; at 100 TB the same joins plan as sort-merge, with more "
        "shuffles. Scalar subqueries are counted with their plan. Staged runs read their checkpoint (`Scan ExistingRDD`), so the scans of "
        "the run queries appear only in the checkpoint job.",
        "",
        "| Query | Shuffles | Broadcasts | Reused | Python stages | Codegen | Parquet scans (columns read, pushed filters) |",
        "|---|---|---|---|---|---|---|",
    ]
    for r in rows:
        lines.append(f"| `{r[0]}` | {r[1]} | {r[2]} | {r[3]} | {r[4]} | "
                     f"{'yes' if r[5] else 'no'} | {r[6] or '(checkpoint)'} |")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
