"""Summarise the physical plan of every registered query.

    python tools/plan_summary.py [sf_dir] > PLANS.md

Plans are taken as a large cluster would make them (no side small enough to
broadcast, so every join is a shuffle join).  For each query: shuffles run
and reused, joins, windows and the predicates pushed into scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_plan(df) -> str:
    """Run ``df`` and return its final adaptive plan (reuse resolved)."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def summarise(plan: str) -> dict[str, str]:
    lines = plan.splitlines()
    shuffles = sum(1 for ln in lines if re.search(r"\bExchange (hash|range|Single|RoundRobin)", ln)
                   and "ReusedExchange" not in ln and "BroadcastExchange" not in ln)
    reused = sum(1 for ln in lines if "ReusedExchange" in ln)
    broadcasts = sum(1 for ln in lines if "BroadcastExchange" in ln)
    joins: dict[str, int] = {}
    for ln in lines:
        m = re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)\b.*?\], (\w+)", ln)
        if m:
            key = f"{m.group(1)} {m.group(2)}" + (" (skew)" if "isSkewJoin=true" in ln else "")
            joins[key] = joins.get(key, 0) + 1
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]\n]+)\]", plan)
                     if re.search(r"GreaterThan|LessThan|EqualTo|In\(", p)})
    return {
        "shuffles": str(shuffles),
        "reused": str(reused),
        "broadcasts": str(broadcasts),
        "joins": ", ".join(f"{k} ×{v}" for k, v in joins.items()) or "-",
        "windows": str(sum(1 for ln in lines if re.search(r"[-+] (\*\(\d+\) )?Window \[", ln))),
        "window_group_limit": "yes" if "WindowGroupLimit" in plan else "-",
        "pushed": "; ".join(pushed) or "-",
        "python": "yes" if re.search(r"EvalPython|InPandas", plan) else "no",
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from retail_insights.plans.registry import QUERIES
    from retail_insights.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "2000",
    })
    print("# Plans of the registered queries (shuffle joins, as on a large cluster)\n")
    print(f"Generated by `python tools/plan_summary.py {sf_dir}`: final adaptive plans after "
          "running each query with broadcasting switched off.  'shuffles run' counts exchanges "
          "that executed, 'reused' those AQE served from an identical exchange of the same "
          "query.\n")
    print("| query | shuffles run | reused | broadcasts | joins | windows | WindowGroupLimit | "
          "pushed predicates | Python |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, q in QUERIES.items():
        s = summarise(final_plan(q(spark, sf_dir)))
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['joins']} | "
              f"{s['windows']} | {s['window_group_limit']} | {s['pushed']} | {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
