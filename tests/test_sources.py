"""Parsers, configuration strings, hourly scans and sinks."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pixelflow.constants import LOG_FIELDS
from pixelflow.session import shared_dir
from pixelflow.sources import logs, sinks
from pixelflow.sources.config import adgroup_table, pixel_lookups, pixel_map, spec_entries
from pixelflow.sources.intermediate import parse_intermediate, to_intermediate_lines


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_token_mode_shifts_columns(spark):
    line = "b1\twp\tslot\t\tCA|US|807\tg1"
    tok = logs.parse_impressions_tokens(lines(spark, line)).first()
    fld = logs.parse_impressions_fields(lines(spark, line)).first()
    assert tok.visibility == "CA|US|807" and tok.geo_location == "g1" and tok.google_id is None
    assert fld.visibility == "" and fld.geo_location == "CA|US|807" and fld.google_id == "g1"
    assert tok.bid == fld.bid == "b1"


def test_field_mode_drops_trailing_empty_fields(spark):
    r = logs.parse_impressions_fields(lines(spark, "a\tb\t\t")).first()
    assert (r.bid, r.wp_bucket, r.ad_slot_id) == ("a", "b", None)


def test_ctr_parse_reads_56_fields(spark):
    line = "\t".join(f"v{i}" for i in range(len(LOG_FIELDS)))
    df = logs.parse_ctr_log(lines(spark, line))
    assert len(df.columns) == 56 and df.first().seller_id == "v55"


def test_retargeting_parsers(spark):
    ck = "c" * 32
    df = lines(spark, f"{ck}\tp1\tp2", f"{ck}\t\tp2", "short\tp1", ck, f"{ck}\t")
    first = [tuple(r) for r in logs.parse_retarg_first(df).collect()]
    assert first == [(ck, "p1"), (ck, "p2"), ("short", "p1")]
    every = [(r.cookie, r.payloads) for r in logs.parse_retarg_all(df).collect()]
    assert every == [(ck, ["p1", "p2"]), (ck, ["", "p2"])]


def test_route_mixed(spark):
    ck = "c" * 32
    df = lines(spark, f"{ck}\tp1", "b\tx\ty", "alone", f"{ck}")
    assert [r.kind for r in logs.route_mixed(df).collect()] == ["CONV", "IMP"]


def test_pixel_map_spec(spark):
    spec = "p0|c0|auto,p0|c1|,bad,p1||x,,p2|c2|retail|extra,p3|c3|travel||"
    rows = [tuple(r) for r in pixel_map(spark, spec).collect()]
    # 'p0|c1|' has two parts once the trailing empty part is dropped
    assert rows == [(0, "p0", "c0", "auto"), (3, "p1", "", "x"), (5, "p3", "c3", "travel")]
    assert spec_entries(spec, 3) == 3
    lk = pixel_lookups(spark, "p0|c0|auto,p0|c1|auto,p2|c0|finance")
    assert dict(lk.category.collect()) == {"c0": "finance", "c1": "auto"}
    assert sorted(tuple(r) for r in lk.weights.collect()) == [("p0", "auto", 0.5), ("p0", "auto", 0.5),
                                                             ("p2", "finance", 1.0)]


def test_adgroup_spec(spark):
    assert sorted(r[0] for r in adgroup_table(spark, "x|a0,y|a0,z|a1,bad,w|a2|extra").collect()) == ["a0", "a1"]
    assert adgroup_table(spark, "").count() == 0 and spec_entries("", 2) == 0


def test_map_kept_as_a_table_gives_the_same_lookups(spark):
    from pixelflow.sources import config
    spec = "p0|c0|auto,p0|c1|auto,p2|c0|finance"
    a, b = config.pixel_lookups(spark, spec), config.lookups_from_entries(pixel_map(spark, spec))
    for name in ("entries", "category", "weights", "pairs", "pixels", "campaigns"):
        x, y = getattr(a, name), getattr(b, name)
        assert sorted(map(tuple, x.select(*sorted(x.columns)).collect())) == sorted(map(tuple, y.select(*sorted(y.columns)).collect()))


def _write_hours(spark, root, hours, layout):
    rows = [(h, f"line-{h}-{i}") for h in hours for i in range(2)]
    df = spark.createDataFrame(rows, "dthr string, value string")
    if layout == "partitioned":
        df.write.partitionBy("dthr").text(root)
    else:
        for h in hours:
            df.where(F.col("dthr") == h).select("value").write.text(f"{root}/{h}")


def test_scan_hour_range_partitioned(spark):
    root = shared_dir(spark, "hours-p")
    _write_hours(spark, root, ["2024010123", "2024010200", "2024010223", "2024010300"], "partitioned")
    got = logs.scan_hour_range(spark, root, "20240102", 1)
    assert sorted(r.value for r in got.collect()) == ["line-2024010200-0", "line-2024010200-1",
                                                       "line-2024010223-0", "line-2024010223-1"]
    assert "PartitionFilters: [isnotnull(dthr" in got._jdf.queryExecution().executedPlan().toString()
    assert dict(got.dtypes) == {"value": "string", "dthr": "string"}


@pytest.mark.parametrize("days", [1, 7, 8, 400])
def test_scan_takes_one_path_for_any_length(spark, days):
    root = shared_dir(spark, "hours-any")
    _write_hours(spark, root, ["2023123123", "2024010100", "2024010123", "2025020500"], "partitioned")
    spark.createDataFrame([("stray",)], "value string").write.text(f"{root}/other")
    got = logs.scan_hour_range(spark, root, "20240101", days)
    assert sorted(r.value for r in got.collect()) == [f"line-{h}-{i}" for h in ("2024010100", "2024010123") for i in range(2)]
    assert dict(got.dtypes) == {"value": "string", "dthr": "string"}
    for layout in ("partitioned", "dirs"):
        with pytest.raises(AnalysisException):                 # a range without any hour
            logs.scan_hour_range(spark, root, "20300101", days, layout=layout).count()
        with pytest.raises(AnalysisException):                 # a missing root
            logs.scan_hour_range(spark, root + "-missing", "20240101", days, layout=layout).count()
    assert logs.scan_hour_range(spark, root, "20240101", 0).count() == 0


def test_scan_hour_range_plain_dirs(spark):
    root = shared_dir(spark, "hours-d")
    _write_hours(spark, root, ["2024010123", "2024010205", "2024010300"], "dirs")
    got = logs.scan_hour_range(spark, root, "20240102", 2, layout="dirs")
    assert sorted(r.value for r in got.collect()) == ["line-2024010205-0", "line-2024010205-1",
                                                       "line-2024010300-0", "line-2024010300-1"]
    assert len(logs.hour_keys("20240228", 2)) == 48 and logs.hour_keys("20240228", 2)[-1] == "2024022923"


def test_partitioned_sink_writes_only_present_groups(spark):
    out = shared_dir(spark, "sink-p")
    df = spark.createDataFrame([("1", "a", 1), ("3", "b", 2)], "hour_group string, k string, v bigint")
    sinks.write_partitioned(df, out, "hour_group")
    assert sorted(d for d in os.listdir(out.replace("file:", "")) if d.startswith("hour_group=")) == \
        ["hour_group=1", "hour_group=3"]
    sinks.write_partitioned(df.where("v = 2"), out, "hour_group")          # replaced, not appended
    assert spark.read.parquet(out).count() == 1


def test_flat_text_sink_round_trip(spark):
    out = shared_dir(spark, "sink-f")
    df = spark.createDataFrame([("ck", "", "CA", 1), ("ck2", "07", "", 0)], "cookie string, hour string, state string, label int")
    sinks.write_flat(df, out)
    back = sinks.read_flat(spark, out, "cookie string, hour string, state string, label int")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    raw = sorted(r.value for r in spark.read.text(out).collect())
    assert raw == ["ck\t\tCA\t1", "ck2\t07\t\t0"]


def test_intermediate_lines(spark):
    agg = spark.createDataFrame([("1", "CA", "W", "C", "auto", 3)],
                                "hour_group string, state string, os string, browser string, category string, imp bigint")
    txt = to_intermediate_lines(agg, "IMP", "imp").union(lines(spark, "too\tfew\tfields"))
    got = [tuple(r) for r in parse_intermediate(txt).collect()]
    assert got == [("1\tCA\tW\tC\tauto", "IMP", 3.0)]


def test_scan_hour_range_long_range_uses_partition_filter(spark):
    root = shared_dir(spark, "hours-long")
    _write_hours(spark, root, ["2024010100", "2024011012", "2024020100"], "partitioned")
    got = logs.scan_hour_range(spark, root, "20240101", 20)
    assert sorted(r.value for r in got.collect()) == ["line-2024010100-0", "line-2024010100-1",
                                                       "line-2024011012-0", "line-2024011012-1"]


def test_scan_hour_range_plain_dirs_with_leaf(spark):
    root = shared_dir(spark, "hours-leaf")
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    df.write.text(f"{root}/2024010105/all_data_hourly")
    df.write.text(f"{root}/2024010106/other")
    got = logs.scan_hour_range(spark, root, "20240101", 1, layout="dirs", leaf="all_data_hourly")
    assert sorted(r.value for r in got.collect()) == ["a", "b"]


def test_flat_text_sink_compressed(spark):
    out = shared_dir(spark, "sink-gz")
    df = spark.createDataFrame([("ck", "", "CA", 1)], "cookie string, hour string, state string, label int")
    sinks.write_flat(df, out, compression="gzip")
    assert any(f.endswith(".gz") for f in os.listdir(out.replace("file:", "")))
    back = sinks.read_flat(spark, out, "cookie string, hour string, state string, label int")
    assert [tuple(r) for r in back.collect()] == [("ck", "", "CA", 1)]


def test_plain_dirs_carry_the_hour(spark):
    root = shared_dir(spark, "2023010101/hours")               # an hour-like folder above the root does not count
    _write_hours(spark, root, ["2024010123", "2024010205"], "dirs")
    spark.createDataFrame([("leaf",)], "value string").write.text(f"{root}/2024010207/leaf")
    got = logs.scan_hour_range(spark, root, "20240101", 2, layout="dirs")
    assert dict(got.dtypes) == {"value": "string", "dthr": "string"}
    assert sorted((r.value[5:15], r.dthr) for r in got.collect()) == [(h, h) for h in ("2024010123", "2024010205") for _ in range(2)]
    leaf = logs.scan_hour_range(spark, root, "20240102", 1, layout="dirs", leaf="leaf")
    assert [tuple(r) for r in leaf.collect()] == [("leaf", "2024010207")]


@pytest.mark.parametrize("layout", ["partitioned", "dirs"])
def test_manifest_scan_lists_only_its_folders(spark, layout):
    root = shared_dir(spark, "hours-m")
    _write_hours(spark, root, ["2023123123", "2024010100", "2024010123", "2024020500"], layout)
    spark.createDataFrame([("stray",)], "value string").write.text(f"{root}/other")
    m = logs.hour_manifest(spark, root)
    assert m.schema.simpleString() == "struct<hour:string,path:string,files:bigint,bytes:bigint>"
    rows = {r.hour: r for r in m.collect()}
    assert sorted(rows) == ["2023123123", "2024010100", "2024010123", "2024020500"]
    assert all(r.files >= 1 and r.bytes >= 2 * len("line-2024010100-0\n") for r in rows.values())
    kept = spark.createDataFrame(m.collect(), logs.MANIFEST_SCHEMA)
    # an hour that arrives later is not seen until the manifest has it
    later = "/dthr=2024010105" if layout == "partitioned" else "/2024010105"
    spark.createDataFrame([("late",)], "value string").write.text(root + later)
    got = logs.scan_manifest(spark, kept, "20240101", 31)
    assert sorted((r.dthr, r.value) for r in got.collect()) == [
        (h, f"line-{h}-{i}") for h in ("2024010100", "2024010123") for i in range(2)]
    assert {f.rsplit("/", 2)[-2][-10:] for f in got.inputFiles()} == {"2024010100", "2024010123"}
    assert logs.scan_manifest(spark, logs.hour_manifest(spark, root), "20240101", 1).count() == 5
    assert logs.scan_manifest(spark, kept, "20240101", 0).count() == 0
    with pytest.raises(ValueError):
        logs.scan_manifest(spark, kept, "20300101", 2)


def test_manifest_scan_of_a_leaf(spark):
    root = shared_dir(spark, "hours-ml")
    for leaf in ("all_data_hourly", "other"):
        spark.createDataFrame([(leaf,)], "value string").write.text(f"{root}/2024010105/{leaf}")
    m = logs.hour_manifest(spark, root)
    assert m.count() == 2
    got = logs.scan_manifest(spark, m, "20240101", 1, leaf="other")
    assert [tuple(r) for r in got.collect()] == [("other", "2024010105")]
    assert logs.scan_manifest(spark, m, "20240101", 1).count() == 2
