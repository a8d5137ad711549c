"""Print the executed physical plan tree of registered queries.

Usage: python tools/show_plans.py [sf_dir] query [query ...]
Runs each query into the noop sink first, so the plans are AQE's final plans.
Set CDRFLOW_NO_BROADCAST=1 to plan J1 as it runs beyond the broadcast limit.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    from cdrflow.plans import queries as q
    from cdrflow.session import get_session

    spark = get_session()
    if os.environ.get("CDRFLOW_NO_BROADCAST"):
        # as on a cluster with a large subscription table
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in args:
        df = q.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"--- {name}")
        df.explain("simple")


if __name__ == "__main__":
    main()
