"""Run registered queries from the command line.

    python -m skuflow.plans.run --list
    python -m skuflow.plans.run item_stock --sf-dir /data/sf1 [--out PATH] [--format parquet|json] [--show N]

Results are written by Spark (never collected to the driver); ``--show``
prints the first N rows, a bounded peek for inspection.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from skuflow.config import scratch_scope
from skuflow.plans.catalog import queries
from skuflow.plans.oracle import oracle_sql


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="run a registered skuflow query")
    ap.add_argument("query", nargs="?")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out")
    ap.add_argument("--format", choices=["parquet", "json"], default="parquet")
    ap.add_argument("--show", type=int, default=0)
    ap.add_argument("--list", action="store_true")
    a = ap.parse_args(argv)
    qs = queries()
    if a.list or not a.query:
        oracles = oracle_sql()
        for name in qs:
            print(f"{name}{'' if name in oracles else '  (rows-only check)'}")
        return
    spark = SparkSession.builder.appName(f"skuflow-{a.query}").getOrCreate()
    with scratch_scope(spark):
        df = qs[a.query](spark, a.sf_dir)
        if a.out:
            df.write.mode("overwrite").format(a.format).save(a.out)
        if a.show:
            df.show(a.show, truncate=False)
        if not a.out and not a.show:
            df.write.format("noop").mode("overwrite").save()
            print(f"{a.query}: ran to completion (use --out or --show to see rows)")


if __name__ == "__main__":
    main()
