"""Physical-plan summary of every registered query (after execution, AQE final plan).

Usage: python tests/plan_report.py [sf_dir]
Per query: shuffle exchanges, broadcast exchanges, reused exchanges, window
operators, and any nested-loop / cartesian join or Python evaluation (should
be none). These counts are of the last step only; "built by" is the number of jobs
(written intermediate tables, quantiles, size checks) that ran while the
DataFrame was built, "jobs" the number in all.
"""

from __future__ import annotations

import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))


def summarize(plan: str) -> dict:
    # An adaptive plan prints the final plan and then the initial one.
    lines = plan.split("== Initial Plan ==")[0].splitlines()

    def count(token):
        return sum(token in ln for ln in lines)
    return {
        "shuffle": count("Exchange hashpartitioning") + count("Exchange rangepartitioning")
                   + count("Exchange SinglePartition"),
        "broadcast": count("BroadcastExchange"),
        "reused": count("ReusedExchange"),
        "window": count("Window ["),
        "bad": count("BroadcastNestedLoopJoin") + count("CartesianProduct")
               + count("BatchEvalPython") + count("ArrowEvalPython"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tripmart.plans.registry import QUERIES
    from tripmart.session import checkpoint_dir, get_spark

    spark = get_spark("local[8]", shuffle_partitions=8)
    checkpoint_dir(spark)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    print(f"{'query':26s} shuffle broadcast reused window nlj/cart/python built by  jobs")
    for name, fn in QUERIES.items():
        spark.sparkContext.setJobGroup(name, name)
        df = fn(spark, sf_dir)
        built = len(jobs(name))
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"{name:26s} {s['shuffle']:7d} {s['broadcast']:9d} {s['reused']:6d} "
              f"{s['window']:6d} {s['bad']:15d} {built:8d} {len(jobs(name)):5d}")


if __name__ == "__main__":
    main()
