"""Skew probe: keep-last with a hot key versus the same data with its own keys.

Usage: python tools/skew_probe.py [sf_dir]
Runs ``keep_last`` over lineitem (key = order key, order = line number) twice:
as is, and with every third row moved onto one key (a third of all rows on a
single key).  Prints seconds, shuffle bytes and the largest shuffle read of one
reduce task, taken from Spark's event log in a scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F
    from snapmerge.operators.merge import keep_last
    from snapmerge.session import build_session
    events = tempfile.mkdtemp(prefix="snapmerge-skew-events-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": events, "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")
    hot = li.withColumn("l_orderkey", F.when(F.monotonically_increasing_id() % 3 == 0, F.lit(-1))
                        .otherwise(F.col("l_orderkey")))
    times = {}
    for name, df in (("uniform", li), ("hot_third", hot)):
        out = keep_last(df, "l_orderkey", ord_col="l_linenumber")
        out.write.format("noop").mode("overwrite").save()  # warm-up
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        out.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    stage_group, written, read_max = {}, {}, {}
    for path in sorted(p for p in glob.glob(os.path.join(events, "**", "*"), recursive=True) if os.path.isfile(p)):
        if os.path.basename(path).startswith("appstatus"):
            continue
        for line in open(path, encoding="utf-8"):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = g
            elif e.get("Event") == "SparkListenerTaskEnd":
                g = stage_group.get(e.get("Stage ID"))
                if not g:
                    continue
                m = e.get("Task Metrics") or {}
                w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                r = m.get("Shuffle Read Metrics") or {}
                rb = r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                written[g] = written.get(g, 0) + w
                read_max[g] = max(read_max.get(g, 0), rb)
    print(json.dumps({"sf": sf, "seconds": times, "shuffle_bytes": written,
                      "max_task_shuffle_read_bytes": read_max}))


if __name__ == "__main__":
    main()
