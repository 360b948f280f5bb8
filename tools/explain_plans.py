"""Write the formatted physical plans of the headline jobs to docs/plans/.

    python tools/explain_plans.py [--sf /root/testdata/sf0.01] [name ...]

Each query is built and executed once (into the no-op sink), so the
intermediate tables it writes exist; the file holds ``explain("formatted")`` of
the final query (the plan AQE starts from) and a count of operator kinds.
"""

from __future__ import annotations

import argparse
import collections
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = ["recall", "catalog_movie", "interactions_rating", "user_history", "stream_latest", "recommend"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from cinegraph.queries import QUERIES
    from cinegraph.session import local_session
    spark = local_session()
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name in args.names or HEADLINE:
        df = QUERIES[name](spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        kinds = collections.Counter(re.findall(r"^\(\d+\) ([A-Za-z]+)", text, re.M))
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(f"# {name} at {args.sf}: operator counts {dict(kinds.most_common())}\n\n")
            f.write(text)
        print(name, dict(kinds.most_common(12)))
    spark.stop()


if __name__ == "__main__":
    main()
