"""Write PLANS.md: the physical shape of every registered report.

    BENCH_SF_DIR=/root/testdata/sf0.1 python tools_plans.py
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    from lorry.session import local_session

    spark = local_session(shuffle_partitions=16, app="lorry-plans")
    from lorry import registry

    lines = [
        "# PLANS — physical shape of each registered report",
        "",
        f"Executed (AQE final) plans at `{os.path.basename(sf_dir)}` on local[8], 16 shuffle partitions, generated by "
        "`tools_plans.py`. At this size AQE turns most joins into broadcasts after measuring them; on large inputs "
        "the same plans keep shuffle joins. `staged` = intermediates written once to the checkpoint folder "
        "(numbering tags; the contract flags, stop rows and per-bill lookups; their upstream plans run as separate jobs and are not counted here).",
        "",
        "| key | exchanges | broadcast joins | sort-merge joins | shuffled-hash joins | windows | staged scans | collated sort |",
        "|---|---|---|---|---|---|---|---|",
    ]
    for key, job in registry.queries().items():
        df = job(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        p = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p))
        row = [
            key, str(shuffles), str(p.count("BroadcastHashJoin")), str(p.count("SortMergeJoin")),
            str(p.count("ShuffledHashJoin")), str(len(re.findall(r"\bWindow\b", p))),
            str(p.count("lorry-stage")), "yes" if "collate(" in p else "",
        ]
        lines.append("| " + " | ".join(row) + " |")
        print(key, row, file=sys.stderr)
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
