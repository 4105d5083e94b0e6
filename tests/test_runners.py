"""The five runners end to end on hourly folders written from sf0.001."""

import pytest
from pyspark.sql import functions as F

from pixelflow.plans import collect_conversions, collect_impressions, ctr_leaves, sequence_labels
from pixelflow.plans import runners
from pixelflow.session import shared_dir
from pixelflow.sources import fixtures as fx, logs, sinks

SF = "/root/testdata/sf0.001"
PIX, ADG = fx.PIXEL_SPEC, fx.ADGROUP_SPEC


@pytest.fixture(scope="module")
def hourly(spark):
    ev = fx.read_events(spark, SF)
    hour = F.date_format("ts", "yyyyMMddHH")
    imp_root, conv_root = shared_dir(spark, "run-imp"), shared_dir(spark, "run-conv")
    imp_ev = ev.where(F.col("event_type").isin(*fx.IMP_TYPES))
    conv_ev = ev.where(F.col("event_type").isin(*fx.CONV_TYPES))
    fx.impression_lines(imp_ev).join(imp_ev.select("event_id", hour.alias("dthr")), "event_id") \
        .select("value", "dthr").write.partitionBy("dthr").text(imp_root)
    fx.conversion_lines(conv_ev).join(conv_ev.select("event_id", hour.alias("dthr")), "event_id") \
        .select("value", "dthr").write.partitionBy("dthr").text(conv_root)
    return imp_root, conv_root


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_runners_match_in_memory_jobs(spark, hourly):
    imp_root, conv_root = hourly
    start, days = "20240101", 31
    io_, co, ro, so, to = (shared_dir(spark, n) for n in ("o-imp", "o-conv", "o-rate", "o-seq", "o-ctr"))
    runners.run_collect_impressions(spark, imp_root, start, days, PIX, io_)
    runners.run_collect_conversions(spark, conv_root, start, days, PIX, co)
    runners.run_agg_rate(spark, io_, co, ro)
    runners.run_sequence(spark, imp_root, conv_root, start, days, PIX, so)
    runners.run_ctr_leaves(spark, imp_root, start, days, ADG, to)

    imp_lines = logs.scan_hour_range(spark, imp_root, start, days).select("value")
    conv_lines = logs.scan_hour_range(spark, conv_root, start, days).select("value")
    e1 = collect_impressions(spark, logs.parse_impressions_tokens(imp_lines), PIX)
    back = spark.read.text(io_).select(F.split("value", "\t").alias("a"))
    assert _rows(back.select(*[F.col("a")[i] for i in range(5)], F.col("a")[6].cast("bigint"))) == _rows(e1)
    e2 = collect_conversions(spark, logs.parse_retarg_first(conv_lines), PIX)
    back = spark.read.text(co).select(F.split("value", "\t").alias("a"))
    assert _rows(back.select(*[F.col("a")[i] for i in range(5)], F.col("a")[6].cast("double"))) == _rows(e2)
    from pixelflow.plans import agg_rate
    rate = agg_rate(e1, e2.withColumn("conv", F.col("conv").cast("string").cast("double")))
    want = sorted("\t".join([*r[:5], str(r.imp), str(r.conv), f"{r.rate:.8f}"]) for r in rate.collect())
    assert sorted(r.value for r in spark.read.text(ro).collect()) == want
    seq = sequence_labels(spark, logs.parse_impressions_fields(imp_lines), logs.parse_retarg_all(conv_lines),
                          PIX, tie_col=None)
    back = sinks.read_flat(spark, so, "cookie string, hour string, state string, os string, browser string, "
                                      "category string, label int")
    assert _rows(back) == _rows(seq)
    ctr = ctr_leaves(spark, logs.parse_ctr_log(imp_lines), ADG)
    want = sorted("\t".join("" if v is None else str(v) for v in r) for r in ctr.collect())
    assert sorted(r.value for r in spark.read.text(to).collect()) == want and want[0].count("\t") == 7


def test_rate_of_an_empty_side(spark, hourly):
    io_, co, ro = (shared_dir(spark, n) for n in ("e-imp", "e-conv", "e-rate"))
    runners.run_collect_impressions(spark, hourly[0], "20240101", 2, PIX, io_)
    runners.run_collect_conversions(spark, hourly[1], "20240101", 2, "none|c0|auto", co)
    runners.run_agg_rate(spark, io_, co, ro)
    assert spark.read.schema("value string").text(ro).count() == 0
    with pytest.raises(ValueError):
        runners.run_agg_rate(spark, io_, "", ro)


def test_sequence_routes_every_line(spark):
    """A 32-character bid marks a retargeting line, in either folder."""
    from pixelflow.plans import sequence_labels_mixed
    from pixelflow.constants import LOG_FIELDS

    def imp_line(**given):
        return "\t".join(given.get(f, "null") for f in LOG_FIELDS)
    rows = [(imp_line(bid="b" * 32, cookie="c" * 32, campaign_id="c0", timestamp="1704067200000"), "2024010100"),
            (imp_line(bid="short", cookie="c" * 32, campaign_id="c0", timestamp="1704067260000"), "2024010100")]
    logs_root, conv_root, out = (shared_dir(spark, n) for n in ("r-imp", "r-conv", "r-out"))
    spark.createDataFrame(rows, "value string, dthr string").write.partitionBy("dthr").text(logs_root)
    spark.createDataFrame([("x" * 32 + '\t{"cmpn":"p0","date":"20240101 00:02:00"}', "2024010100")], "value string, dthr string") \
        .write.partitionBy("dthr").text(conv_root)
    runners.run_sequence(spark, logs_root, conv_root, "20240101", 1, PIX, out)
    lines = spark.read.text(logs_root).select("value").unionByName(spark.read.text(conv_root).select("value"))
    want = ["\t".join("" if v is None else str(v) for v in r) for r in sequence_labels_mixed(spark, lines, PIX).collect()]
    got = [r.value for r in spark.read.text(out).collect()]
    assert got == want and len(got) == 1


def test_runner_reads_a_manifest(spark):
    from pixelflow.sources import fixtures as fx, logs
    root, kept, a, b = (shared_dir(spark, n) for n in ("m-imp", "m-kept", "m-a", "m-b"))
    lines = fx.impression_lines(fx.read_events(spark, "/root/testdata/sf0.001"), with_hour=True)
    lines.select("value", "dthr").hint("rebalance", "dthr").write.partitionBy("dthr").text(root)
    logs.hour_manifest(spark, root).write.parquet(kept)
    start = lines.selectExpr("substr(min(dthr), 1, 8)").first()[0]
    runners.run_collect_impressions(spark, root, start, 3, PIX, a)
    runners.run_collect_impressions(spark, kept, start, 3, PIX, b, layout="manifest")
    rows = [sorted(tuple(r) for r in spark.read.text(p).collect()) for p in (a, b)]
    assert rows[0] == rows[1] and rows[0]


def test_runner_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        runners.run_collect_impressions(spark, "/nowhere", "", 1, PIX, "/tmp/x")
    with pytest.raises(ValueError):
        runners.run_ctr_leaves(spark, "/nowhere", "20240101", 1, ADG, "")
