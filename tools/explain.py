"""Print the physical plan of registered queries.

    python tools/explain.py [sf_dir] name [name ...]   # formatted plans (no execution)
    EXECUTE=1 python tools/explain.py ...                # run, then print the final adaptive plan
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import all_plans  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session()
    plans = all_plans()
    for name in args:
        df = plans[name].fn(spark, sf)
        print(f"===== {name}")
        if os.environ.get("EXECUTE"):
            df.write.format("noop").mode("overwrite").save()
            print(df._jdf.queryExecution().executedPlan().toString())
        else:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
