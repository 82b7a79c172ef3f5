"""Hot-key experiment: plain per-key window vs the blocked running sum.

Derives a skewed transaction set from the sf0.1 events (10 copies with
fresh ids; one SKU gets a third of all rows), runs both plans with an
event log in a fresh scratch folder, and prints per-task shuffle records
and task times of every shuffle-reading stage.

usage: python tools/skew_experiment.py [sf_dir]
"""

from __future__ import annotations

import collections
import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "false")  # show the raw partitioning
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from skuflow.operators.changelog import item_changelog
    from skuflow.operators.stock import signed_delta
    from skuflow.sources.tables import events_transactions

    tx = events_transactions(spark, sf_dir)
    skewed = (
        tx.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9))))
        .withColumn("id", F.col("id") + F.col("copy") * 1_000_000)
        .withColumn("sku", F.when(F.col("id") % 3 == 0, F.lit("Item-HOT")).otherwise(F.col("sku")))
        .drop("copy")
    )
    d = signed_delta(skewed, keep=("id",)).where("itemID is not null")
    w = Window.partitionBy("itemID").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plans = {
        "warmup": item_changelog(skewed, block_width=65536),
        "plain window": d.select("id", "itemID", F.sum("delta").over(w).alias("s")),
        "blocked W=65536": item_changelog(skewed, block_width=65536),
    }
    for name, df in plans.items():
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name:18s} wall {time.perf_counter() - t0:.2f}s")
    spark.stop()
    _report(log_dir)


def _report(log_dir: str) -> None:
    import zstandard

    stage_job, tasks = {}, collections.defaultdict(list)
    for f in glob.glob(f"{log_dir}/**/events_*", recursive=True):
        with open(f, "rb") as fh:
            raw = fh.read()
        text = zstandard.ZstdDecompressor().stream_reader(raw).read() if f.endswith(".zstd") else raw
        for line in text.decode("utf-8", "replace").splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                for s in e.get("Stage IDs", []):
                    stage_job[s] = desc
            elif e.get("Event") == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                info = e["Task Info"]
                tasks[e["Stage ID"]].append((recs, info["Finish Time"] - info["Launch Time"]))
    for s, t in sorted(tasks.items()):
        desc = stage_job.get(s, "")
        recs = [r for r, _ in t]
        if desc in ("", "warmup") or max(recs) == 0:
            continue
        durs = [x for _, x in t]
        print(
            f"{desc:18s} stage {s:3d}: shuffle records per task max {max(recs):>8,} "
            f"median {int(statistics.median(recs)):>8,} total {sum(recs):>9,}; "
            f"task ms max {max(durs)} median {int(statistics.median(durs))}"
        )


if __name__ == "__main__":
    main()
