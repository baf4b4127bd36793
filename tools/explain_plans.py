"""Write PLANS.md: the physical plan of every query (sf0.01), and for the
iterative operators the plan of each kind of round they run.

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import quern.session as qs  # noqa: E402
from quern.plans.catalog import QUERIES  # noqa: E402

WIDTH = 170
_seen: dict[str, str] = {}


def tidy(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[file:[^\]]*/([^/\]]+)\]", r"Location: \1", line)
        line = re.sub(r"file:/tmp/[^\],]*", "<scratch>", line)
        out.append(line if len(line) <= WIDTH else line[: WIDTH - 3] + "...")
    return "\n".join(out)


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    return tidy(qe.executedPlan().toString())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = qs.local_session(8, 16)
    orig = qs.ScratchTables.put

    def put(self, df, name):
        kind = re.sub(r"\d+$", "", name.split("-", 1)[-1])
        key = f"{name.split('-', 1)[0]}:{kind}"
        if key not in _seen:
            _seen[key] = final_plan(df)
        return orig(self, df, name)

    qs.ScratchTables.put = put
    print("# PLANS\n")
    print(f"Physical plans (`executedPlan`, before adaptive re-planning) at `{sf_dir}`, written by")
    print("`tools/explain_plans.py`. Expression ids and scratch paths are elided; long lines are cut.\n")
    print("For the iterative operators the returned DataFrame only reads the last scratch table, so")
    print("each kind of round (seeding pick, Lloyd update, coreset weights) is shown once, as planned")
    print("in its first occurrence.\n")
    for name, fn in QUERIES.items():
        _seen.clear()
        df = fn(spark, sf_dir)
        print(f"## {name}\n")
        for key, plan in _seen.items():
            print(f"round `{key}`:\n\n```\n{plan}\n```\n")
        print(f"result:\n\n```\n{final_plan(df)}\n```\n")
    colocated_appendix(spark, sf_dir, orig)
    spark.stop()


def colocated_appendix(spark, sf_dir, orig) -> None:
    """Plans of the coreset rounds (taken after each round ran) when a block of
    centres does not fit the broadcast threshold: points laid out by (bucket,
    salt), only centre-side tables exchanged."""
    from quern.operators import clustering as cl
    from quern.sources.vectors import points_from_embeddings

    plans: dict[str, str] = {}

    def put(self, df, name):
        out = orig(self, df, name)  # runs the round first
        plans.setdefault(name.split("-", 1)[-1], final_plan(df))
        return out

    qs.ScratchTables.put = put
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        pts = points_from_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
        cl.coreset(pts, 3, 4, 1, seed=42).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
    print("## Appendix: coreset rounds without broadcasts\n")
    print("Broadcast threshold -1, 4 buckets, 4 shuffle partitions: the points are hash-partitioned")
    print("by (bucket, salt) once. In the plans below (taken after each round ran) the")
    print("`REPARTITION_BY_NUM` exchange inside the cached point frame is that one shuffle, read from")
    print("the cache afterwards; every `ENSURE_REQUIREMENTS` exchange is over a centre-side table.\n")
    for key, plan in plans.items():
        if key in ("pick1", "lloyd0", "coreset"):
            print(f"round `{key}`:\n\n```\n{plan}\n```\n")


if __name__ == "__main__":
    main()
