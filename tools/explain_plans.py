"""Write the formatted physical plans of key queries to docs/plans/.

    python tools/explain_plans.py [--sf /root/testdata/sf0.01]

Plans are taken after execution (adaptive plans final), simulating large
inputs (size-based broadcast off) so the shapes are the ones a big cluster
would run. Very long lines (the 2,499-column wide stage) are truncated.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["features_all", "global_trend", "etl_flagship", "rmsse", "submission", "trend_arx",
        "scan_store_slice", "price_kde"]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "docs", "plans"))
    a = ap.parse_args()
    from shelfcast.plans.catalog import all_queries
    from shelfcast.session import build_session
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    qs = all_queries()
    os.makedirs(a.out, exist_ok=True)
    for k in KEYS:
        df = qs[k](spark, a.sf)
        df.write.format("noop").mode("overwrite").save()
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        lines = [ln if len(ln) <= 400 else ln[:400] + " ...[truncated]" for ln in text.split("\n")]
        with open(os.path.join(a.out, f"{k}.txt"), "w") as fh:
            fh.write("\n".join(lines))
        print(k, len(lines), "lines")
    spark.stop()


if __name__ == "__main__":
    main()
