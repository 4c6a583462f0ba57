"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python scripts/plan_report.py [sf_dir]

Per query: shuffles (Exchange), join strategies, window group limits
(partial ones sit below an exchange), pandas stages, and the widest parquet
ReadSchema. Plans are the initial adaptive plans (before runtime
re-optimisation); ALS queries are skipped (their plan is Spark ML's).
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recsmith.plans import registry  # noqa: E402
from recsmith.session import local_session  # noqa: E402

SKIP_PREFIX = ("als_", "rank_grid", "best_rank", "build_rec_lists", "top_titles", "rec_ids", "refresh_", "stream_")


def summarise(plan: str) -> dict:
    # The formatted plan is the operator tree, then numbered node details.
    tree = plan.split("\n\n(1)", 1)[0]
    text = "\n".join(ln for ln in tree.splitlines() if "== " not in ln)
    widths = [len(m.split(",")) for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]
    return {
        "exchanges": text.count("Exchange") - text.count("BroadcastExchange"),
        "broadcast": text.count("BroadcastExchange"),
        "smj": text.count("SortMergeJoin"),
        "bhj": text.count("BroadcastHashJoin"),
        "wgl": text.count("WindowGroupLimit"),
        "pandas": text.count("FlatMapGroupsInPandas") + text.count("MapInPandas"),
        "widest_scan": max(widths) if widths else 0,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    rows = []
    registry.load_all()
    for name, fn in registry.QUERIES.items():
        if name.startswith(SKIP_PREFIX):
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        rows.append((name, summarise(plan)))
    out = ["# Physical plan summary", "",
           "Generated by `scripts/plan_report.py` from the formatted plans at sf0.01 (initial adaptive plans; "
           "AQE may later turn a sort-merge join into a broadcast one and coalesce partitions). "
           "`wgl` = WindowGroupLimit nodes: 2 means a partial limit before the shuffle and a final one after it. "
           "`widest scan` = most columns any parquet scan reads. ALS and streaming queries are not listed.", "",
           "| query | shuffles | broadcast | SMJ | BHJ | wgl | pandas | widest scan |",
           "|---|---|---|---|---|---|---|---|"]
    for name, s in rows:
        out.append(f"| `{name}` | {s['exchanges']} | {s['broadcast']} | {s['smj']} | {s['bhj']} | {s['wgl']} | "
                   f"{s['pandas']} | {s['widest_scan']} |")
    Path(__file__).resolve().parents[1].joinpath("PLANS.md").write_text("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
