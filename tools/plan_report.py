"""Write PLANS.md: physical-plan facts of each job on stored log-shaped
inputs (shuffles, broadcasts, scans, largest generated method) plus the
operator tree from ``explain("formatted")``.

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from pixelflow.session import get_session, shared_dir  # noqa: E402
from pixelflow.sources import fixtures as fx  # noqa: E402


def facts(df):
    qe = df._jdf.queryExecution()
    phys = qe.executedPlan().toString()
    lines = phys.splitlines()
    shuffles = sum(1 for x in lines if "Exchange hashpartitioning" in x and "ReusedExchange" not in x)
    reused = sum(1 for x in lines if "ReusedExchange" in x)
    bhj = sum(1 for x in lines if "BroadcastHashJoin" in x)
    smj = sum(1 for x in lines if "SortMergeJoin" in x)
    py = any("EvalPython" in x for x in lines)
    scans = []
    for x in lines:
        if "FileScan" in x:
            kind = re.search(r"FileScan (\w+)", x).group(1)
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", x)
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", x)
            scans.append(f"{kind} {rs.group(1) if rs else ''} pushed={pf.group(1) if pf else '[]'}")
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("codegen")
    sizes = [int(m) for m in re.findall(r"maxMethodCodeSize:(\d+)", buf.getvalue())]
    return dict(shuffles=shuffles, reused=reused, bhj=bhj, smj=smj, python=py, scans=scans,
                max_method=max(sizes) if sizes else 0)


def tree(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    txt = buf.getvalue()
    return txt.split("\n\n\n")[0].strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # show the static plan
    paths = fx.materialize(spark, sf, shared_dir(spark, "plan-inputs"))
    out = ["# PLANS", "",
           f"Physical plans of the jobs on stored log-shaped inputs from `{sf}` (AQE off so the",
           "static plan is shown; at run time AQE may coalesce partitions or turn a shuffle join",
           "into a broadcast from measured sizes).  Written by `tools/plan_report.py`.", "",
           "| job | shuffles | reused | broadcast joins | sort-merge joins | Python | largest generated method (bytes) |",
           "| --- | --- | --- | --- | --- | --- | --- |"]
    details = []
    for name, (_, make) in bench.jobs(spark, paths).items():
        df = make()
        f = facts(df)
        out.append(f"| {name} | {f['shuffles']} | {f['reused']} | {f['bhj']} | {f['smj']} | "
                   f"{'yes' if f['python'] else 'no'} | {f['max_method']} |")
        details += [f"## {name}", "", "Scans:", ""] + [f"* `{s}`" for s in f["scans"]] + \
                   ["", "```", tree(df), "```", ""]
    out += ["", "HotSpot compiles methods up to 8000 bytes of bytecode; larger ones run interpreted.", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out + details) + "\n")


if __name__ == "__main__":
    main()
