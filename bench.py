"""Benchmark the headline jobs.

At ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: the ``events`` table, ``$BENCH_COPIES`` times (default
16, each copy with users of its own), is first turned into stored text logs
(in a fresh folder under the session's checkpoint folder; not timed), then
each job runs on them, through its text parser, to completion with the
``noop`` sink (full plan, nothing collected to the driver).  The time per job
is the best of ``$BENCH_REPS`` runs after one warm-up pass.  Prints one JSON
line; ``mb_per_sec`` is the text read over the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pixelflow.plans import (agg_rate, collect_conversions, collect_impressions,  # noqa: E402
                             ctr_leaves, sequence_labels, sequence_labels_mixed)
from pixelflow.session import get_session, shared_dir  # noqa: E402
from pixelflow.sources import fixtures as fx, logs  # noqa: E402

PIX, ADG = fx.PIXEL_SPEC, fx.ADGROUP_SPEC


def jobs(spark, p):
    imp_lines, conv_lines, both = [p["imp_lines"]], [p["conv_lines"]], [p["imp_lines"], p["conv_lines"]]
    text = lambda paths: spark.read.text(paths)
    imp = lambda: logs.parse_impressions_tokens(text(imp_lines))
    conv = lambda: logs.parse_retarg_first(text(conv_lines))
    seq = lambda: sequence_labels(
        spark, logs.parse_impressions_fields(text(imp_lines)), logs.parse_retarg_all(text(conv_lines)), PIX, tie_col=None)
    return {
        "collect_impressions": (imp_lines, lambda: collect_impressions(spark, imp(), PIX)),
        "collect_conversions": (conv_lines, lambda: collect_conversions(spark, conv(), PIX)),
        "agg_rate": (both, lambda: agg_rate(collect_impressions(spark, imp(), PIX), collect_conversions(spark, conv(), PIX))),
        "seq_label": (both, seq),
        "seq_label_mixed": (both, lambda: sequence_labels_mixed(spark, text(both), PIX)),
        "ctr_leaves_text": (imp_lines, lambda: ctr_leaves(spark, logs.parse_ctr_log(text(imp_lines)), ADG)),
        "route_mixed": (both, lambda: logs.route_mixed(text(both)).groupBy("kind").count()),
    }


def size_mb(paths) -> float:
    return sum(os.path.getsize(os.path.join(d, f)) for p in paths
               for d, _, names in os.walk(p.removeprefix("file:")) for f in names if f.startswith("part-")) / 1e6


def run(make) -> float:
    t0 = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    scratch = shared_dir(spark, "bench-inputs")
    t0 = time.perf_counter()
    paths = fx.materialize(spark, sf_dir, scratch, int(os.environ.get("BENCH_COPIES", "16")))
    prep = time.perf_counter() - t0
    js = jobs(spark, paths)
    for _, make in js.values():       # warm-up: JIT, file listing caches
        run(make)
    times = {name: round(min(run(make) for _ in range(reps)), 3) for name, (_, make) in js.items()}
    rate = {name: round(size_mb(inputs) / times[name], 1) for name, (inputs, _) in js.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "mb_per_sec": rate, "sf": sf, "prepare_sec": round(prep, 2)}))


if __name__ == "__main__":
    main()
