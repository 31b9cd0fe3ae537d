"""Skew check: run key-sensitive operators on a hot-key table and report, from Spark's event log, the
largest share of shuffled records any single task had to read.

The hot key comes from the data itself: every returned line item (l_returnflag = 'R', about a third of the
table) is moved to order key 0. AQE thresholds are scaled down with the data (1 MB instead of 256 MB) so
the small local input behaves like a large one, and broadcasts are off so joins take the shuffle path.

usage: python tools/skew_check.py [sf_dir] [event_log_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_shares(log_dir: str, groups: list[str]) -> dict[str, float]:
    import zstandard

    job_group, stage_group, task_reads = {}, {}, {}
    for f in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*.zstd")):
        with open(f, "rb") as fh:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            for line in text:
                e = json.loads(line)
                ev = e["Event"]
                if ev == "SparkListenerJobStart":
                    g = e.get("Properties", {}).get("spark.jobGroup.id")
                    for s in e["Stage Infos"]:
                        stage_group[s["Stage ID"]] = g
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if recs:
                        task_reads.setdefault(e["Stage ID"], []).append(recs)
    out = {}
    for g in groups:
        worst = 0.0
        for sid, reads in task_reads.items():
            if stage_group.get(sid) == g and sum(reads) > 1000:
                worst = max(worst, max(reads) / sum(reads))
        out[g] = round(worst, 3)
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    print(json.dumps(run(sf, log_dir)))


def run(sf: str, log_dir: str) -> dict:
    """Run the operators on the hot-key table in a fresh session; stops any active session first."""
    from pyspark.sql import SparkSession, functions as F

    from sluice.operators import metrics, quality, silver
    from sluice.session import local_session
    from sluice.specs import TableSpec

    os.makedirs(log_dir, exist_ok=True)
    active = SparkSession.getActiveSession()
    if active is not None:
        active.stop()
    spark = local_session(8, shuffle_partitions=32, app="sluice-skew", extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",  # force the shuffle join so AQE's skew split is exercised
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    })
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_returnflag") == "R", F.lit(0).cast("long")).otherwise(F.col("l_orderkey")))
    # stored as 16 files, like real multi-file input: AQE splits a skewed partition by ranges of map tasks,
    # and the single-row-group test file would give it only one
    staged = os.path.join(log_dir, "hot_lineitem")
    hot.repartition(16).write.mode("overwrite").parquet(staged)
    hot = spark.read.parquet(staged)
    share = hot.filter("l_orderkey = 0").count() / hot.count()
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    runs = {
        "dq_report": lambda: quality.quality_report(hot, TableSpec("LI", key=("l_orderkey",))).collect(),
        "key_uniqueness": lambda: quality.key_uniqueness(hot, ["l_orderkey"]).collect(),
        "duplicate_profile": lambda: quality.duplicate_profile(hot).collect(),
        "dedup_latest": lambda: silver.dedup_latest(hot, ["l_orderkey"], ["l_shipdate", "l_linenumber"]).write.format("noop").mode("overwrite").save(),
        "exact_quantile": lambda: metrics.exact_quantile(hot, ["l_orderkey"], "l_extendedprice", 0.95).collect(),
        "enrich_shuffle_join": lambda: silver.enrich(hot, orders, {"l_orderkey": "o_orderkey"}, ["o_orderdate"],
                                                     max_broadcast_rows=0).write.format("noop").mode("overwrite").save(),
    }
    for g, fn in runs.items():
        spark.sparkContext.setJobGroup(g, g)
        fn()
    spark.stop()
    return {"hot_key_share_of_rows": round(share, 3),
            "largest_task_share_of_shuffled_records": stage_shares(log_dir, list(runs)),
            "event_log": log_dir}


if __name__ == "__main__":
    main()
