"""Print the PLANS.md table: node counts of each registered query's physical plan.

Usage: python tests/plan_table.py [sf_dir]
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def pushed(plan: str) -> str:
    """All filters that the scans push down, IsNotNull aside (also of lists
    that the plan text cuts short)."""
    lists = re.findall(r"PushedFilters: \[([^\]]*)", plan)
    found = {f for x in lists for f in re.findall(r"(?:Not\()?[A-Z]\w+\([^()]*\)+", x) if not f.startswith("IsNotNull")}
    return "; ".join(sorted(found))[:120].replace("|", "/")


def main() -> None:
    from tidemark.plans import catalog
    from tidemark.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.sql.maxMetadataStringLength": "2000"})
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    print("| query | scans | shuffles | reused | single-partition | windows | BHJ | SMJ | pushed filters |")
    print("|---|---|---|---|---|---|---|---|---|")
    for n in catalog.QUERIES:
        df = catalog.QUERIES[n](spark, sf)
        df.collect()  # the plan that ran
        p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

        def count(pattern: str) -> int:
            return len(re.findall(pattern, p))
        reused = count(r"ReusedExchange")
        print(f"| `{n}` | {count('FileScan')} | {count(r'[-:] Exchange (?:hash|range)partitioning')} | {reused} | "
              f"{count(r'[-:] Exchange SinglePartition')} | {count(r'Window .')} | {count('BroadcastHashJoin')} | "
              f"{count('SortMergeJoin')} | {pushed(p)} |")


if __name__ == "__main__":
    main()
