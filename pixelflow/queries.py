"""Registered queries: one per operator / job, each run over the whole
test tables through the library's own code.

Every query reads ``events`` (through the adapter in
:mod:`pixelflow.sources.fixtures`) and returns a DataFrame whose column
names match the DuckDB statement of the same key in
:mod:`pixelflow.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pixelflow import functions as pf
from pixelflow.constants import (RE_BRWSOS, RE_CMPN, RE_CONV_HOUR, RE_DATE, RE_SEQ_HOUR,
                                 RE_STATE, TAG_CONV, TAG_IMP)
from pixelflow.operators import aggregates as agg
from pixelflow.operators import filters as flt
from pixelflow.operators import joins as jn
from pixelflow.operators import sequence as seq
from pixelflow.plans import (agg_rate, agg_rate_bucketed, agg_rate_from_folders, agg_rate_from_lines, collect_conversions,
                             collect_impressions, ctr_leaves, sequence_labels, sequence_labels_mixed,
                             sequence_labels_split)
from pixelflow.plans.ctr import ctr_dims as _ctr_dims
from pixelflow.session import shared_dir
from pixelflow.sources import fixtures as fx
from pixelflow.sources import logs, sinks
from pixelflow.sources.config import adgroup_table, lookups_from_entries, pixel_lookups, pixel_map
from pixelflow.sources.intermediate import parse_intermediate, to_intermediate_lines, write_bucketed, write_intermediate

PIX = fx.PIXEL_SPEC
ADG = fx.ADGROUP_SPEC
SCAN_START, SCAN_DAYS = "20240105", 20
CREDIT_DECIMALS = 6


def _ev(spark, d):
    return fx.read_events(spark, d)


def _imp(spark, d):
    return fx.impressions(_ev(spark, d))


def _conv(spark, d):
    return fx.conversions(_ev(spark, d))


def _lk(spark):
    return pixel_lookups(spark, PIX)


def _credit(df: DataFrame, c: str = "conv") -> DataFrame:
    return df.withColumn(c, F.round(c, CREDIT_DECIMALS))


# ---------------------------------------------------------------- sources
def q_scan_hour_range(spark, d):
    """Write the impression log as hourly folders, scan a day range back."""
    lines = fx.impression_lines(_ev(spark, d), with_hour=True)
    root = shared_dir(spark, "hourly")
    lines.select("value", "dthr").hint("rebalance", "dthr").write.partitionBy("dthr").text(root)
    out = logs.scan_hour_range(spark, root, SCAN_START, SCAN_DAYS)
    return out.select(F.col("dthr").cast("string").alias("dthr"), "value")


def q_scan_manifest(spark, d):
    """The same day range through a stored hour manifest."""
    lines = fx.impression_lines(_ev(spark, d), with_hour=True)
    root, kept = shared_dir(spark, "hourly"), shared_dir(spark, "manifest")
    lines.select("value", "dthr").hint("rebalance", "dthr").write.partitionBy("dthr").text(root)
    logs.hour_manifest(spark, root).write.parquet(kept)
    return logs.scan_manifest(spark, spark.read.schema(logs.MANIFEST_SCHEMA).parquet(kept), SCAN_START, SCAN_DAYS).select("dthr", "value")


def q_parse_impressions_tokens(spark, d):
    lines = fx.impression_lines(_ev(spark, d))
    return logs.parse_impressions_tokens(lines, keep=("event_id",))


def q_parse_impressions_fields(spark, d):
    lines = fx.impression_lines(_ev(spark, d))
    return logs.parse_impressions_fields(lines, keep=("event_id",))


def q_parse_retarg_first(spark, d):
    return logs.parse_retarg_first(fx.conversion_lines(_ev(spark, d)), keep=("event_id",))


def q_parse_retarg_all(spark, d):
    p = logs.parse_retarg_all(fx.conversion_lines(_ev(spark, d)), keep=("event_id",))
    return p.select("event_id", "cookie", F.posexplode("payloads").alias("pos", "payload"))


def _mixed_lines(spark, d):
    ev = _ev(spark, d)
    return fx.impression_lines(ev).unionByName(fx.conversion_lines(ev))


def q_route_mixed(spark, d):
    return logs.route_mixed(_mixed_lines(spark, d), keep=("event_id",)).select("event_id", "kind")


def q_pixel_map(spark, d):
    """Parsed map entries with how many conversions / impressions hit them."""
    lk = _lk(spark)
    pm = lk.entries
    conv = flt.filter_known_pixels(_conv(spark, d), lk)
    nconv = conv.groupBy(F.regexp_extract("payload", RE_CMPN, 1).alias("pixel")).agg(
        F.count(F.lit(1)).alias("n_conv"))
    imp = flt.filter_known_campaigns(_imp(spark, d), lk)
    nimp = imp.groupBy(pf.norm_marker("campaign_id").alias("campaign_id")).agg(
        F.count(F.lit(1)).alias("n_imp"))
    out = pm.join(nconv, "pixel", "left").join(nimp, "campaign_id", "left")
    return out.select("ord", "pixel", "campaign_id", "category",
                      F.coalesce("n_conv", F.lit(0)).alias("n_conv"),
                      F.coalesce("n_imp", F.lit(0)).alias("n_imp"))


def q_adgroup_filter(spark, d):
    adg = adgroup_table(spark, ADG)
    kept = flt.filter_adgroups(_imp(spark, d), adg)
    return kept.groupBy("adgroup_id").agg(F.count(F.lit(1)).alias("n_imp"))


def _intermediate_lines(spark, d):
    imp_agg = collect_impressions(spark, _imp(spark, d), PIX)
    conv_agg = _credit(collect_conversions(spark, _conv(spark, d), PIX))
    return (to_intermediate_lines(imp_agg, TAG_IMP, "imp")
            .unionByName(to_intermediate_lines(conv_agg, TAG_CONV, "conv")))


def q_agg_row_parse(spark, d):
    return parse_intermediate(_intermediate_lines(spark, d))


def q_sink_partitioned(spark, d):
    out = shared_dir(spark, "imp_by_group")
    sinks.write_partitioned(collect_impressions(spark, _imp(spark, d), PIX), out, "hour_group")
    back = spark.read.parquet(out)
    return back.select(F.col("hour_group").cast("string").alias("hour_group"),
                       "state", "os", "browser", "category", "imp")


SEQ_SCHEMA = "cookie string, hour string, state string, os string, browser string, category string, label int"


def q_sink_flat(spark, d):
    out = shared_dir(spark, "seq_flat")
    sinks.write_flat(q_seq_label(spark, d), out)
    return sinks.read_flat(spark, out, SEQ_SCHEMA)


# ---------------------------------------------------------------- scalar functions
def q_norm_marker(spark, d):
    i = _imp(spark, d)
    return i.select("event_id", *[pf.norm_marker(c).alias(c) for c in
                                  ("browser", "os", "timestamp", "geo_location", "cookie", "visibility")])


def q_payload_extract(spark, d):
    c = _conv(spark, d)
    pats = {"cmpn": RE_CMPN, "brwsos": RE_BRWSOS, "pdate": RE_DATE, "st": RE_STATE, "phour": RE_CONV_HOUR}
    return c.select("event_id", *[pf.payload_extract("payload", p).alias(n) for n, p in pats.items()])


def q_clean_browser(spark, d):
    return _imp(spark, d).select("event_id", pf.clean_browser(pf.norm_marker("browser")).alias("browser"))


def q_clean_os(spark, d):
    return _imp(spark, d).select("event_id", pf.clean_os(pf.norm_marker("os")).alias("os"))


def q_seq_features(spark, d):
    i = _imp(spark, d)
    date = pf.format_epoch_ms(pf.norm_marker("timestamp"))
    return i.select("event_id", F.regexp_extract(date, RE_SEQ_HOUR, 1).alias("hour"),
                    pf.clean_os(pf.norm_marker("os"), False).alias("os"),
                    pf.clean_browser(pf.norm_marker("browser"), False).alias("browser"))


def q_classify_user_agent(spark, d):
    c = _conv(spark, d)
    ua = pf.payload_extract("payload", RE_BRWSOS)
    return c.select("event_id", pf.classify_os(ua).alias("os_name"),
                    pf.classify_browser(ua).alias("browser_name"),
                    pf.clean_os(pf.classify_os(ua)).alias("os"),
                    pf.clean_browser(pf.classify_browser(ua)).alias("browser"))


def q_format_epoch_ms(spark, d):
    return _imp(spark, d).select("event_id", pf.format_epoch_ms("timestamp").alias("formatted"))


def q_day_shift(spark, d):
    c = _conv(spark, d)
    day = F.substring(pf.payload_extract("payload", RE_DATE), 1, 8)
    return c.select("event_id", day.alias("day"), pf.day_shift(day, 1).alias("next_day"),
                    pf.day_shift(day, -1).alias("prev_day"), pf.day_shift(day, 45).alias("plus_45"),
                    pf.day_shift(day, 0).alias("same_day"))


def q_hour_group_impressions(spark, d):
    return _imp(spark, d).select("event_id", pf.hour_group_impressions(pf.norm_marker("timestamp")).alias("hour_group"))


def q_hour_group_conversions(spark, d):
    return _conv(spark, d).select("event_id", pf.hour_group_conversions("payload").alias("hour_group"))


def q_hour_group_ctr(spark, d):
    return _imp(spark, d).select("event_id", pf.hour_group_ctr("date").alias("hour_group"))


def q_geo_state_dma(spark, d):
    i = _imp(spark, d)
    g = pf.norm_marker("geo_location")
    return i.select("event_id", pf.geo_state(g).alias("state"), pf.geo_dma(g).alias("dma"),
                    pf.ctr_state("geo_location").alias("ctr_state"))


def q_ctr_dims(spark, d):
    return _ctr_dims(_imp(spark, d), keep=("event_id",))


def q_weighted_argmax(spark, d):
    return _imp(spark, d).select("event_id", pf.weighted_argmax("verticle_list").alias("vertical"))


def q_weighted_pick(spark, d):
    return _imp(spark, d).select("event_id", pf.weighted_pick("user_seg_list", "event_id", "0").alias("segment"))


# ---------------------------------------------------------------- filters and joins
def q_filter_known_pixels(spark, d):
    kept = flt.filter_known_pixels(_conv(spark, d), _lk(spark))
    return kept.select("event_id", F.regexp_extract("payload", RE_CMPN, 1).alias("pixel"))


def q_filter_known_campaigns(spark, d):
    kept = flt.filter_known_campaigns(_imp(spark, d), _lk(spark))
    return kept.select("event_id", "campaign_id")


def q_conv_fanout(spark, d):
    c = _conv(spark, d).withColumn("pixel", F.regexp_extract("payload", RE_CMPN, 1))
    return jn.fan_out(c, _lk(spark)).select("event_id", "pixel", "category", "weight")


def q_campaign_category(spark, d):
    i = _imp(spark, d).withColumn("_camp", pf.norm_marker("campaign_id"))
    j = jn.with_category(i, _lk(spark), key="_camp")
    return j.select("event_id", F.col("_camp").alias("campaign_id"), pf.norm_marker("category").alias("category"))


def q_pixel_lists(spark, d):
    lk = _lk(spark)
    lists = agg.pixel_lists(lk.entries, "campaign_id").select(
        "pixel", F.concat_ws(",", "campaign_ids").alias("campaigns"))
    conv = flt.filter_known_pixels(_conv(spark, d), lk)
    n = conv.groupBy(F.regexp_extract("payload", RE_CMPN, 1).alias("pixel")).agg(F.count(F.lit(1)).alias("n_conv"))
    return lists.join(n, "pixel", "left").select("pixel", "campaigns", F.coalesce("n_conv", F.lit(0)).alias("n_conv"))


# ---------------------------------------------------------------- sequence job
def _seq_inputs(spark, d):
    """Both logs as text lines, each read with its field-mode parser (the
    logs live in separate folders; :func:`q_seq_label_mixed` covers a mixed input)."""
    ev = _ev(spark, d)
    imp = logs.parse_impressions_fields(fx.impression_lines(ev), keep=("event_id",))
    conv = logs.parse_retarg_all(fx.conversion_lines(ev), keep=("event_id",))
    return imp, conv


def q_seq_events(spark, d):
    imp, conv = _seq_inputs(spark, d)
    return seq.seq_events(imp, conv, _lk(spark))


def q_seq_dedup(spark, d):
    """The last-wins dedup of the timeline with its key coarsened from the
    second to the hour: the test tables have no same-cookie same-second
    pairs, so the hour key is what exercises the tie rule (conversion first,
    then the larger tie value, then the later payload)."""
    imp, conv = _seq_inputs(spark, d)
    tl = seq.seq_events(imp, conv, _lk(spark))
    tl = tl.withColumn("event_hour", F.substring("event_date", 1, 11))
    return seq.dedup_last_wins(tl, key=("cookie", "event_hour"))


def q_seq_label_mixed(spark, d):
    """Sequence job on one mixed input (both logs as text lines in one frame),
    read in one pass by the job (the stand-in lines themselves come from two
    reads of ``events``; on stored mixed files the job is a single scan)."""
    return sequence_labels_mixed(spark, _mixed_lines(spark, d), PIX, tie_col="event_id")


def q_seq_label_split(spark, d):
    """Sequence job with its hot cookies combined by second and cut into ranges
    ahead of the window; the bound of one row makes every cookie of two events
    a hot one, as the test tables have no hotter one."""
    return sequence_labels_split(spark, _mixed_lines(spark, d), PIX, tie_col="event_id", hot_rows=1, slice_rows=500)


def q_seq_label(spark, d):
    imp, conv = _seq_inputs(spark, d)
    return sequence_labels(spark, imp, conv, PIX)


# ---------------------------------------------------------------- aggregate jobs
def q_collect_impressions(spark, d):
    return collect_impressions(spark, _imp(spark, d), PIX)


def _table_map(spark):
    return lookups_from_entries(pixel_map(spark, PIX))


def q_collect_impressions_table_map(spark, d):
    """The map as a table: log rows pass its key filter ahead of the join."""
    return collect_impressions(spark, _imp(spark, d), _table_map(spark))


def q_collect_conversions_table_map(spark, d):
    return _credit(collect_conversions(spark, _conv(spark, d), _table_map(spark)))


def q_seq_label_table_map(spark, d):
    return sequence_labels_mixed(spark, _mixed_lines(spark, d), _table_map(spark), tie_col="event_id")


def q_collect_impressions_text(spark, d):
    """Impression job on the text log read in token mode (empty fields shift columns)."""
    return collect_impressions(spark, logs.parse_impressions_tokens(fx.impression_lines(_ev(spark, d))), PIX)


def q_collect_conversions_text(spark, d):
    """Conversion job on the retargeting text log (first payload)."""
    conv = logs.parse_retarg_first(fx.conversion_lines(_ev(spark, d)))
    return _credit(collect_conversions(spark, conv, PIX))


def q_collect_conversions(spark, d):
    return _credit(collect_conversions(spark, _conv(spark, d), PIX))


def q_agg_pivot(spark, d):
    return agg.tag_pivot(parse_intermediate(_intermediate_lines(spark, d)))


def q_agg_rate(spark, d):
    imp_agg = collect_impressions(spark, _imp(spark, d), PIX)
    conv_agg = collect_conversions(spark, _conv(spark, d), PIX)
    return _credit(agg_rate(imp_agg, conv_agg))


def q_ctr_leaves(spark, d):
    return ctr_leaves(spark, _imp(spark, d), ADG)


def q_ctr_leaves_text(spark, d):
    """CTR job on the text log read in token mode (empty fields shift columns)."""
    lines = fx.impression_lines(_ev(spark, d))
    return ctr_leaves(spark, logs.parse_ctr_log(lines), ADG)


def q_agg_rate_text(spark, d):
    """Rate job on the text intermediates of both collect jobs."""
    txt = _intermediate_lines(spark, d)
    return agg_rate_from_lines(txt.where(F.col("value").contains("\tIMP\t")),
                               txt.where(F.col("value").contains("\tCONV\t")))


def q_agg_rate_files(spark, d):
    """Collect jobs write tagged text per hour-group folder; the rate job
    reads groups 1..4 back (partition pruning) and joins them."""
    imp_root, conv_root = shared_dir(spark, "imp_groups"), shared_dir(spark, "conv_groups")
    write_intermediate(collect_impressions(spark, _imp(spark, d), PIX), TAG_IMP, "imp", imp_root)
    write_intermediate(_credit(collect_conversions(spark, _conv(spark, d), PIX)), TAG_CONV, "conv", conv_root)
    return agg_rate_from_folders(spark, imp_root, conv_root)


def q_agg_rate_bucketed(spark, d):
    """Both aggregates kept as tables in buckets of the five dimensions, joined
    bucket by bucket."""
    tables = []
    for side, agg in (("imp", collect_impressions(spark, _imp(spark, d), PIX)), ("conv", collect_conversions(spark, _conv(spark, d), PIX))):
        path = shared_dir(spark, f"{side}_buckets")
        tables.append(path.rsplit("/", 1)[1].replace("-", "_"))
        write_bucketed(agg, tables[-1], path, 8)
    return _credit(agg_rate_bucketed(spark, *tables))


def q_ctr_leaves_all(spark, d):
    return ctr_leaves(spark, _imp(spark, d), "")


# ---------------------------------------------------------------- invariants
def _one_row(**parts: DataFrame) -> DataFrame:
    """Single-row frames (each one column) side by side without a join:
    tag, union, then one global aggregate."""
    tagged = None
    for name, df in parts.items():
        t = df.select(F.lit(name).alias("_k"), F.col(df.columns[0]).cast("double").alias("_v"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.agg(*[F.max(F.when(F.col("_k") == n, F.col("_v"))).alias(n) for n in parts])


def q_check_credit_conserved(spark, d):
    credit = collect_conversions(spark, _conv(spark, d), PIX).agg(F.sum("conv"))
    kept = flt.filter_known_pixels(_conv(spark, d), _lk(spark)).agg(F.count(F.lit(1)))
    out = _one_row(kept=kept, credit=credit)
    return out.select(F.col("kept").cast("bigint").alias("kept"),
                      F.round("credit", CREDIT_DECIMALS).alias("credit"))


def q_check_label_bound(spark, d):
    lab = q_seq_label(spark, d)
    _, conv = _seq_inputs(spark, d)
    out = _one_row(labels=lab.agg(F.sum("label")), rows=lab.agg(F.count(F.lit(1))),
                   conversions=conv.agg(F.count(F.lit(1))))
    out = out.select(*[F.coalesce(F.col(c), F.lit(0.0)).cast("bigint").alias(c)
                       for c in ("labels", "rows", "conversions")])
    return out.withColumn("bounded", F.col("labels") <= F.col("conversions"))


# ------------------------------------------- absent fields and malformed lines
def q_required_fields(spark, d):
    """Which rows the required-field filters keep, with the CTR state of rows
    whose location may be absent."""
    df = fx.sparse_impressions(_ev(spark, d)).withColumn("state", pf.ctr_state("geo_location"))
    kept = [(flt.require_ctr_ids, "ids"), (flt.require_timestamp, "timestamp"), (flt.require_cookie, "cookie")]
    parts = [f(df).select("event_id", F.lit(name).alias("has"), "state") for f, name in kept]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_route_malformed(spark, d):
    return logs.route_mixed(fx.malformed_lines(_ev(spark, d)), keep=("event_id",)).select("event_id", "kind")


def q_retarg_all_malformed(spark, d):
    c = logs.parse_retarg_all(fx.malformed_lines(_ev(spark, d)), keep=("event_id",))
    return c.select("event_id", "cookie", F.posexplode("payloads").alias("pos", "payload"))


def q_retarg_first_malformed(spark, d):
    return logs.parse_retarg_first(fx.malformed_lines(_ev(spark, d)), keep=("event_id",))


def q_fields_malformed(spark, d):
    return logs.parse_impressions_fields(fx.malformed_lines(_ev(spark, d)), fields=("f1", "f2", "f3", "f4", "f5"), keep=("event_id",))


def q_agg_row_malformed(spark, d):
    return parse_intermediate(fx.malformed_intermediate(_ev(spark, d)).select("value"))


def q_agg_rate_one_sided(spark, d):
    """The rate job where one hour group has no conversions: its impressions go."""
    conv = fx.conversions(_ev(spark, d).where(F.hour("ts").between(1, 17)))
    return _credit(agg_rate(collect_impressions(spark, _imp(spark, d), PIX), collect_conversions(spark, conv, PIX)))


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items())
           if name.startswith("q_") and callable(fn)}
