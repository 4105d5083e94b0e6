"""End-to-end jobs on hand-made rows and on the sf0.001 tables."""

from pyspark.sql import functions as F

from log_frames import conv_frame, imp_frame, payload
from pixelflow.plans import (agg_rate, collect_conversions, collect_impressions, ctr_leaves,
                             sequence_labels)
from pixelflow.sources import fixtures as fx

PIX = fx.PIXEL_SPEC          # p0->c0,c1  p1->c2  p2->c3,c4,c0,c5  p3->c5
DAY0 = 1704067200000         # 2024-01-01 00:00:00 UTC


def ms(h, m=0, s=0):
    return str(DAY0 + ((h * 60 + m) * 60 + s) * 1000)


def cdate(h, m=0, s=0):
    return f"20240101 {h:02d}:{m:02d}:{s:02d}"


def ck(c):
    return (c * 32)[:32]


def imp(eid, cookie, camp, ts, **kw):
    return dict(event_id=eid, cookie=cookie, campaign_id=camp, timestamp=ts,
                geo_location=kw.get("geo", "CA|US|807"), os=kw.get("os", "Windows 7"),
                browser=kw.get("browser", "Chrome 38"))


def labels(spark, imps, convs, spec=PIX):
    out = sequence_labels(spark, imp_frame(spark, imps), conv_frame(spark, convs), spec)
    return sorted((r.cookie, r.hour, r.label) for r in out.collect())


def test_sequence_adjacency_rules(spark):
    A, B, C, D, E = ck("a"), ck("b"), ck("c"), ck("d"), ck("e")
    imps = [
        imp(1, A, "c1", ms(8)),                       # then p0, p0 -> 1 (second conversion credits nothing)
        imp(2, B, "c1", ms(8)),                       # then p1 (lists c2), p0 -> 0
        imp(3, C, "c1", ms(8)),                       # then unmapped p4, p0 -> 1
        imp(4, D, "c0", ms(8)), imp(5, D, "c0", ms(9)),   # same second as a conversion -> conversion kept
        imp(6, E, "c0", ms(10)),                      # undated conversion sorts first -> 0
        imp(7, "-", "c0", ms(8)),                     # no cookie: dropped
        imp(8, A, "c6", ms(7)),                       # campaign not in map: dropped
    ]
    convs = [
        (11, A, [payload("p0", date=cdate(9))]), (12, A, [payload("p0", date=cdate(10))]),
        (13, B, [payload("p1", date=cdate(9))]), (14, B, [payload("p0", date=cdate(10))]),
        (15, C, [payload("p4", date=cdate(9))]), (16, C, [payload("p0", date=cdate(10))]),
        (17, D, [payload("p0", date=cdate(9))]),
        (18, E, [payload("p0")]),
    ]
    assert labels(spark, imps, convs) == [(A, "08", 1), (B, "08", 0), (C, "08", 1), (D, "08", 1), (E, "10", 0)]


def test_sequence_undated_impressions(spark):
    F_, G = ck("f"), ck("g")
    imps = [imp(1, F_, "c0", "null"),                 # '' sorts before the '-' marker of its conversions -> 0
            imp(2, G, "c0", "null"), imp(3, G, "c0", "bad"),  # both collapse to one '' row
            imp(4, G, "c0", ms(7))]
    convs = [(11, F_, [payload("p0", date=cdate(9))])]
    assert labels(spark, imps, convs) == [(F_, "", 0), (G, "", 0), (G, "07", 0)]


def test_two_payloads_first_only_vs_all(spark):
    H = ck("h")
    pl = [payload("p4", date=cdate(9)), payload("p0", date=cdate(9, 5))]
    # conversions job reads the first payload only: unmapped, so nothing is credited
    first = conv_frame(spark, [(1, H, pl[0])])
    assert collect_conversions(spark, first, PIX).count() == 0
    # the sequence job reads all payloads and keeps the mapped one
    assert labels(spark, [imp(2, H, "c1", ms(9))], [(1, H, pl)]) == [(H, "09", 1)]


def test_raw_category_markers(spark):
    spec = "p9|c9|unknown"
    i = imp_frame(spark, [imp(1, ck("x"), "c9", ms(8))])
    c = conv_frame(spark, [(2, ck("x"), payload("p9", date=cdate(8)))])
    assert [r.category for r in collect_impressions(spark, i, spec).collect()] == ["-"]
    assert [r.category for r in collect_conversions(spark, c, spec).collect()] == ["unknown"]


def test_collect_impressions_dims(spark):
    rows = [imp(1, "x", "c0", ms(8), os="Windows 8.1", browser="Internet Explorer 11"),
            imp(2, "x", "c0", ms(8), os="Windows 8.1", browser="Internet Explorer 11"),
            imp(3, "x", "c5", "null", geo="WA", os="null", browser="unknown")]
    out = {tuple(r[:5]): r.imp for r in collect_impressions(spark, imp_frame(spark, rows), PIX).collect()}
    assert out == {("1", "CA", "Windows8", "InternetExplorer", "finance"): 2,
                   ("1", "-", "-", "-", "retail"): 1}


def test_collect_conversions_fanout(spark):
    ua = "Mozilla/5.0 (Windows NT 6.1) Chrome/38.0"
    c = conv_frame(spark, [(1, ck("a"), payload("p2", ua, cdate(14), "CA")),
                           (2, ck("a"), payload("p0", ua, cdate(14), "CA")),
                           (3, ck("a"), '{"cmpn":"px-1"}')])
    out = {(r.category): r.conv for r in collect_conversions(spark, c, PIX).collect()}
    # p2: four entries (travel twice) -> 0.25 each; p0: two entries, both auto -> 0.5 + 0.5
    assert out == {"travel": 0.5, "retail": 0.25, "finance": 0.25, "auto": 1.0}


def test_agg_rate_hour_groups(spark):
    dims = "hour_group string, state string, os string, browser string, category string"
    ia = spark.createDataFrame([("1", "CA", "a", "b", "auto", 10), ("4", "CA", "a", "b", "auto", 5),
                                ("1", "NY", "a", "b", "auto", 3)], dims + ", imp bigint")
    ca = spark.createDataFrame([("1", "CA", "a", "b", "auto", 2.0), ("1", "TX", "a", "b", "auto", 7.0),
                                ("-", "CA", "a", "b", "auto", 1.0)], dims + ", conv double")
    out = sorted((r.hour_group, r.state, r.imp, r.conv, r.rate) for r in agg_rate(ia, ca).collect())
    # group 4 has no conversions at all: dropped; TX has no impressions: dropped
    assert out == [("1", "CA", 10.0, 2.0, round(3 / 1010, 8)), ("1", "NY", 3.0, 0.0, round(1 / 1003, 8))]


def test_ctr_leaves_filters(spark):
    base = dict(date="2024-01-01 14:00:00", geo_location="CA|US|807", verticle_list="v1,0.2|v2,0.7",
                campaign_id="c1", visibility="IN_VIEW")
    rows = [dict(base, event_id=1, adgroup_id="a0", click_flag="1"),
            dict(base, event_id=2, adgroup_id="a0", click_flag="0"),
            dict(base, event_id=3, adgroup_id="a9", click_flag="1"),
            dict(base, event_id=4, click_flag="1"),                       # no ad group: dropped
            dict(base, event_id=5, adgroup_id="a0", campaign_id="")]      # empty campaign: dropped
    df = imp_frame(spark, rows)
    got = [tuple(r) for r in ctr_leaves(spark, df, "x|a0,x|a1").collect()]
    assert got == [("2", "CA", "IN_VIEW", "v2", "c1", 2, 1, 0.5)]
    every = [tuple(r) for r in ctr_leaves(spark, df, "").collect()]
    assert sorted(every) == [("2", "CA", "IN_VIEW", "v2", "c1", 3, 2, 2 / 3)]


SF = "/root/testdata/sf0.001"


def test_invariants_on_tables(spark):
    ev = fx.read_events(spark, SF)
    imp_df, conv_df = fx.impressions(ev), fx.conversions(ev)
    e1 = collect_impressions(spark, imp_df, PIX)
    e2 = collect_conversions(spark, conv_df, PIX)
    kept_conv = conv_df.where(F.regexp_extract("payload", r'"cmpn":"(\w+?)"', 1).isin("p0", "p1", "p2", "p3")).count()
    assert round(e2.agg(F.sum("conv")).first()[0], 6) == kept_conv            # credit conserved
    kept_imp = imp_df.where(F.col("campaign_id").isin("c0", "c1", "c2", "c3", "c4", "c5")).count()
    assert e1.agg(F.sum("imp")).first()[0] == kept_imp
    e3 = agg_rate(e1, e2)
    dims = ["hour_group", "state", "os", "browser", "category"]
    assert e3.join(e1, dims, "left_anti").count() == 0                        # E3 keys within E1 keys
    ctr = ctr_leaves(spark, imp_df, fx.ADGROUP_SPEC)
    assert ctr.where((F.col("ctr") < 0) | (F.col("ctr") > 1)).count() == 0
    seq = sequence_labels(spark, imp_df, conv_df.select("event_id", "cookie", F.array("payload").alias("payloads")), PIX)
    assert seq.agg(F.sum("label")).first()[0] <= kept_conv


def test_rate_from_group_folders(spark):
    import os
    from pixelflow.plans import agg_rate_from_folders
    from pixelflow.session import shared_dir
    from pixelflow.sources.intermediate import write_intermediate
    dims = "hour_group string, state string, os string, browser string, category string"
    ia = spark.createDataFrame([("1", "CA", "a", "b", "auto", 10), ("4", "CA", "a", "b", "auto", 5),
                                ("-", "CA", "a", "b", "auto", 7)], dims + ", imp bigint")
    ca = spark.createDataFrame([("1", "CA", "a", "b", "auto", 2.0), ("-", "CA", "a", "b", "auto", 1.0)],
                               dims + ", conv double")
    ir, cr = shared_dir(spark, "t-imp"), shared_dir(spark, "t-conv")
    write_intermediate(ia, "IMP", "imp", ir)
    write_intermediate(ca, "CONV", "conv", cr)
    assert sorted(d for d in os.listdir(cr.replace("file:", "")) if d.startswith("hour_group")) == \
        ["hour_group=-", "hour_group=1"]
    out = agg_rate_from_folders(spark, ir, cr)
    assert [tuple(r) for r in out.collect()] == [("1\tCA\ta\tb\tauto", 10.0, 2.0, round(3 / 1010, 8))]
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        out.explain("formatted")
    import re
    assert re.search(r"PartitionFilters: \[[^\]]*hour_group[^\]]*IN \(1,2,3,4\)", buf.getvalue())


def test_shuffled_lookups_give_same_results(spark):
    ev = fx.read_events(spark, SF)
    imp_df, conv_df = fx.impressions(ev), fx.conversions(ev)
    conv_all = conv_df.select("event_id", "cookie", F.array("payload").alias("payloads"))

    def run():
        return [sorted(tuple(r) for r in df.collect()) for df in (
            collect_impressions(spark, imp_df, PIX), collect_conversions(spark, conv_df, PIX),
            sequence_labels(spark, imp_df, conv_all, PIX), ctr_leaves(spark, imp_df, fx.ADGROUP_SPEC))]

    small = run()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_sided_group_folder_is_not_read(spark, tmp_path):
    from pixelflow.constants import TAG_CONV, TAG_IMP
    from pixelflow.plans import agg_rate_from_folders
    from pixelflow.sources.intermediate import write_intermediate
    row = "hour_group string, state string, os string, browser string, category string, "
    dims = ("s", "o", "b", "c")
    imp = spark.createDataFrame([(g, *dims, 5) for g in "123"], row + "imp bigint")
    conv = spark.createDataFrame([(g, *dims, 1.0) for g in "24"], row + "conv double")
    ir, cr = str(tmp_path / "imp"), str(tmp_path / "conv")
    write_intermediate(imp, TAG_IMP, "imp", ir)
    write_intermediate(conv, TAG_CONV, "conv", cr)
    for side, g in (("imp", 1), ("conv", 4)):            # a file that fails when it is read
        (tmp_path / side / f"hour_group={g}" / "part-bad.gz").write_bytes(b"not gzip")
    got = agg_rate_from_folders(spark, ir, cr).collect()
    assert [(r.key, r.imp, r.conv) for r in got] == [("2\ts\to\tb\tc", 5.0, 1.0)]
    write_intermediate(conv.where("hour_group = '4'"), TAG_CONV, "conv", cr)
    assert agg_rate_from_folders(spark, ir, cr).count() == 0


def test_one_cookie_with_half_of_a_day(spark):
    """The hot cookie is one row a second before the window, in several slices; labels stay the same."""
    from pixelflow.operators.sequence import hot_cookies, hot_winners, label_next, label_slices, seq_events, sliced
    from pixelflow.sources.config import pixel_lookups
    H = ck("h")
    imps = [imp(i, H, "c1", str(1704067200000 + 1000 * (i % 40))) for i in range(2000)]
    imps += [imp(3000 + i, f"{i:032d}", "c1", ms(8)) for i in range(2000)]
    convs = [(5000 + i, H, [payload("p0", date=f"20240101 00:00:{10 + i % 5 * 7:02d}")]) for i in range(300)]
    convs += [(6000 + i, f"{i:032d}", [payload("p0", date=cdate(9))]) for i in range(0, 2000, 2)]
    lk = pixel_lookups(spark, PIX)
    tl = seq_events(imp_frame(spark, imps), conv_frame(spark, convs), lk).cache()
    want = sorted(tuple(r) for r in label_next(tl, lk).collect())
    assert sum(r[-1] for r in want) == 1000 + 5
    hot = hot_cookies(tl, 500)
    assert [tuple(r) for r in hot.collect()] == [(H,)]
    few = hot_winners(tl, hot)
    assert few.count() == 40
    for slices in (1, 7, 60):
        parts = sliced(few, slices).cache()
        sizes = [r["count"] for r in parts.groupBy("_slice").count().collect()]
        assert sum(sizes) == 40 and max(sizes) <= -(-40 // slices) + 2        # no slice holds the day
        assert sorted(tuple(r) for r in label_slices(tl, hot, parts, lk).collect()) == want
        parts.unpersist()
    none = hot_cookies(tl, 10**6)
    assert none.count() == 0
    assert sorted(tuple(r) for r in label_slices(tl, none, sliced(hot_winners(tl, none), 1), lk).collect()) == want
    tl.unpersist()


def test_small_slices_share_a_task(spark, tmp_path):
    """The tasks that store the slices follow from the winners, not from the number of slices."""
    from pixelflow.operators.sequence import label_next, seq_events_mixed
    from pixelflow.plans import sequence_labels_split
    from pixelflow.sources import logs
    from pixelflow.sources.config import pixel_lookups
    imps = imp_frame(spark, [imp(i, ck("abcdefg"[i % 7]), "c1", ms(i % 20, i % 50)) for i in range(600)])
    convs = [(1000 + i, ck("abcdefg"[i % 7]), [payload("p0", date=cdate(i % 20, i % 40))]) for i in range(300)]
    lines = logs.to_lines(imps, logs.LOG_FIELDS, keep=("event_id",)).union(
        conv_frame(spark, convs).selectExpr("event_id", "concat_ws('\\t', cookie, payloads) AS value"))
    got = sequence_labels_split(spark, lines, PIX, tie_col="event_id", hot_rows=1, folder=str(tmp_path / "t"), slice_rows=4)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t" / "slices")).groupBy("_slice").count().collect()]
    assert max(sizes) == 4 and len(sizes) == -(-sum(sizes) // 4) > 100
    assert len(list((tmp_path / "t" / "slices").glob("part-*"))) == 1
    lk = pixel_lookups(spark, PIX)
    want = label_next(seq_events_mixed(lines, lk, "event_id"), lk)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.where("label = 1").count() > 0
