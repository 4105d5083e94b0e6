"""Write STAGES.md: per job, the stages and tasks Spark ran, bytes read,
shuffle bytes written / read and executor time, taken from Spark's event
log (written to a fresh scratch folder; the UI stays off).

    python tools/stage_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import bench  # noqa: E402
from pixelflow.session import shared_dir  # noqa: E402
from pixelflow.sources import fixtures as fx  # noqa: E402

METRICS = {"internal.metrics.input.bytesRead": "input",
           "internal.metrics.shuffle.write.bytesWritten": "shuffle_write",
           "internal.metrics.shuffle.read.remoteBytesRead": "shuffle_read",
           "internal.metrics.shuffle.read.localBytesRead": "shuffle_read",
           "internal.metrics.executorRunTime": "run_ms",
           "internal.metrics.shuffle.write.recordsWritten": "shuffle_records",
           "internal.metrics.input.recordsRead": "input_records"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="pixelflow-eventlog-")   # local tool run only
    spark = (SparkSession.builder.master("local[8]").appName("stage-report")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    paths = fx.materialize(spark, sf, shared_dir(spark, "stage-inputs"))
    names = []
    jobs = {name: make for name, (_, make) in bench.jobs(spark, paths).items()}
    for name, make in jobs.items():              # warm-up pass (JIT), not recorded
        spark.sparkContext.setJobGroup("warmup", "warmup")
        make().write.format("noop").mode("overwrite").save()
    for name, make in jobs.items():
        df = make()
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
        names.append(name)
    spark.stop()

    job_group, stage_job = {}, {}
    per = defaultdict(lambda: defaultdict(float))
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = g
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    g = stage_job.get(info["Stage ID"])
                    if g not in names:
                        continue
                    acc = per[g]
                    acc["stages"] += 1
                    acc["tasks"] += info.get("Number of Tasks", 0)
                    for a in info.get("Accumulables", []):
                        key = METRICS.get(a.get("Name"))
                        if key:
                            acc[key] += float(a.get("Value") or 0)
    out = ["# STAGES", "",
           f"What Spark ran per job on stored log-shaped inputs from `{sf}` (local[8], AQE on, after one",
           "warm-up pass), from its event log.  Skipped stages (reused shuffle output) are not counted.  Written by",
           "`tools/stage_report.py`.", "",
           "| job | stages | tasks | input rows | input MB | shuffle rows | shuffle write MB | shuffle read MB | executor s |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for n in names:
        a = per[n]
        out.append(f"| {n} | {int(a['stages'])} | {int(a['tasks'])} | {int(a['input_records'])} | "
                   f"{a['input'] / 1e6:.2f} | {int(a['shuffle_records'])} | {a['shuffle_write'] / 1e6:.3f} | "
                   f"{a['shuffle_read'] / 1e6:.3f} | {a['run_ms'] / 1000:.2f} |")
    out += ["", "Shuffle rows far below input rows mean the aggregation was combined map-side",
            "before the exchange (collect and CTR jobs) or the rows were filtered and narrowed",
            "before it (sequence jobs).", ""]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    open(os.path.join(root, "STAGES.md"), "w").write("\n".join(out))


if __name__ == "__main__":
    main()
