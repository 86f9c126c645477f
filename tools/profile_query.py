"""Per-stage timings of one registered query from Spark's event log (written to a scratch folder).

    python tools/profile_query.py <query> [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from volpanel.plans import queries as q  # noqa: E402
from volpanel.session import ensure_checkpoint_dir  # noqa: E402


def main():
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="volpanel-evlog-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logdir)
        .config("spark.eventLog.compress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    q.REGISTRY[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    t0 = time.time()
    q.REGISTRY[name](spark, sf).write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()
    stages = {}
    for path in [p for p in glob.glob(f"{logdir}/**", recursive=True) if os.path.isfile(p)]:
        for line in open(path):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if info.get("Submission Time") and info.get("Completion Time"):
                    stages[info["Stage ID"]] = (
                        info["Submission Time"], info["Completion Time"] - info["Submission Time"],
                        info["Number of Tasks"], info["Stage Name"][:60],
                    )
    ids = sorted(stages)
    t_first = None
    for sid in ids:
        sub, dur, ntask, sname = stages[sid]
        print(f"stage {sid:4d} {dur:6d} ms tasks={ntask:4d} {sname}")
    print(f"wall {wall:.2f}s")


if __name__ == "__main__":
    main()
