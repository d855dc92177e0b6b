"""Print the plan summary of every registered query (after execution, so the
plan is AQE's final plan). Usage: python -m livetables.plans.report [sf_dir]"""

from __future__ import annotations

import sys

from livetables.plans.catalog import QUERIES
from livetables.plans.inspect import summary
from livetables.session import local_session


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    spark = local_session(8, 8)
    cols = None
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summary(df)
        if cols is None:
            cols = list(s)
            print("| query | " + " | ".join(cols) + " |")
            print("| --- |" + " --- |" * len(cols))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main(*sys.argv[1:])
