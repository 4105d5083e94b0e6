"""Per-cookie event timeline and next-event labels.

Plan: both logs are projected to narrow timeline rows before any shuffle; one
exchange by (cookie, day) and one sort then give, in a window over the text
date, the winner of every second and the winner that follows it the same day.
The last winner of each (cookie, day) is settled from the next day's first
winner in a second window (one row per cookie and day), so a hot cookie is
split by day.

With the timeline stored (:func:`label_slices`) the counts of its cookies are
known first: cookies within a bound take one window each, the others are
combined to one row a second, dealt into ranges of (cookie, date), and the
event after each range is carried over from the next one's first row.  Then
there is one exchange of the timeline and one sort, and no window is larger
than the bound, whatever a cookie holds of a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pixelflow.constants import COOKIE_LENGTH, LOG_FIELDS, MISSING, RE_CMPN, RE_DATE, RE_SEQ_HOUR
from pixelflow.functions.dates import format_epoch_ms
from pixelflow.functions.geo import geo_state
from pixelflow.functions.markers import norm_marker
from pixelflow.functions.text import clean_browser, clean_os, payload_extract
from pixelflow.operators.filters import require_cookie, require_timestamp
from pixelflow.operators.joins import with_category
from pixelflow.operators.keyfilter import key_filter, may_match, reduced
from pixelflow.sources.config import PixelLookups
from pixelflow.sources.logs import split_once

def _tie(df: DataFrame, tie_col: str | None, fields):
    """Order key for same-cookie same-second rows: ``tie_col`` when given,
    else a hash of the fields the job reads.  Rows with equal hashes then
    carry identical output values, so either winner gives the same result;
    unlike ``monotonically_increasing_id`` it is stable under recomputation."""
    if tie_col and tie_col in df.columns:
        return F.col(tie_col).cast("bigint")
    return F.xxhash64(*[F.col(c) for c in fields])


def timeline_impressions(imp: DataFrame, lk: PixelLookups,
                         tie_col: str | None = "event_id") -> DataFrame:
    """Impression rows of the timeline: campaign in the map, a cookie, a
    timestamp field.  Date = formatted UTC timestamp (``''`` if unparsable)."""
    df = require_timestamp(require_cookie(imp.where(F.col("campaign_id").isNotNull())))
    used = ("cookie", "timestamp", "campaign_id", "geo_location", "os", "browser")
    df = df.withColumn("_tie", _tie(df, tie_col, used)).withColumn("_camp", norm_marker("campaign_id"))
    df = with_category(df, lk, key="_camp")
    date = format_epoch_ms(norm_marker("timestamp"))
    return df.select(
        F.col("cookie"), date.alias("event_date"), F.lit(0).alias("is_conv"),
        F.col("_tie").alias("tie"), F.lit(0).alias("ord"), F.lit(None).cast("string").alias("pixel"),
        F.col("_camp").alias("campaign_id"),
        F.regexp_extract(date, RE_SEQ_HOUR, 1).alias("hour"),
        geo_state(norm_marker("geo_location")).alias("state"),
        F.when(F.col("os").isNull(), F.lit("")).otherwise(clean_os(norm_marker("os"), False)).alias("os"),
        F.when(F.col("browser").isNull(), F.lit("")).otherwise(
            clean_browser(norm_marker("browser"), False)).alias("browser"),
        norm_marker("category").alias("category"))


def timeline_conversions(conv_all: DataFrame, lk: PixelLookups,
                         tie_col: str | None = "event_id") -> DataFrame:
    """Conversion rows of the timeline from ``(cookie, payloads[])``.

    Only payloads whose ``cmpn`` is a mapped pixel enter."""
    df = conv_all.withColumn("_tie", _tie(conv_all, tie_col, ("cookie", "payloads")))
    ex = df.select("cookie", "_tie", F.posexplode("payloads").alias("_pos", "_p"))
    # pixel id once per payload (generator barrier, see split_once)
    ex = split_once(ex, F.regexp_extract("_p", RE_CMPN, 1), keep=("cookie", "_tie", "_pos", "_p")) \
        .withColumnRenamed("_arr", "_pix")
    known = lk.pixels.withColumnRenamed("pixel", "_known")
    ex = reduced(ex, "_pix", lk, "pixels").join(known, F.col("_pix") == F.col("_known"), "left_semi")
    null = F.lit(None).cast("string")
    return ex.select(
        "cookie", payload_extract("_p", RE_DATE).alias("event_date"), F.lit(1).alias("is_conv"),
        F.col("_tie").alias("tie"), (F.col("_pos") + 1).alias("ord"), norm_marker("_pix").alias("pixel"),
        null.alias("campaign_id"), null.alias("hour"), null.alias("state"), null.alias("os"),
        null.alias("browser"), null.alias("category"))


def seq_events(imp: DataFrame, conv_all: DataFrame, lk: PixelLookups,
               tie_col: str | None = "event_id") -> DataFrame:
    """Union of both logs as timeline rows (no shuffle yet)."""
    return timeline_impressions(imp, lk, tie_col).unionByName(
        timeline_conversions(conv_all, lk, tie_col))


def dedup_last_wins(timeline: DataFrame, key=("cookie", "event_date"),
                    order=("is_conv", "tie", "ord")) -> DataFrame:
    """One row per ``key``: a conversion beats an impression, then the larger
    tie value, then the later payload position.

    Written as an aggregate (max of a struct led by the order columns) so
    Spark combines map-side before the exchange: duplicates of a hot key
    never travel to one task together."""
    rest = [c for c in timeline.columns if c not in key and c not in order]
    win = F.max(F.struct(*order, *rest)).alias("_w")
    return (timeline.groupBy(*key).agg(win)
                    .select(*key, *[F.col("_w." + c).alias(c) for c in (*order, *rest)]))


def hot_cookies(timeline: DataFrame, rows: int) -> DataFrame:
    """``cookie`` of more than ``rows`` timeline rows: at most ``count / rows``
    of them, counted map-side, so a cookie of any size is a few partial counts."""
    return timeline.groupBy("cookie").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select("cookie")


def hot_winners(timeline: DataFrame, hot: DataFrame) -> DataFrame:
    """The winner of each second of the hot cookies, combined ahead of the exchange."""
    return dedup_last_wins(timeline.join(hot, "cookie", "left_semi"))


def sliced(winners: DataFrame, ranges: int, rows: int | None = None) -> DataFrame:
    """``winners`` dealt into ``ranges`` ranges of (cookie, date) of about the
    same size, one task each.  A range is one slice, or is cut in its order into
    slices of at most ``rows`` winners, so that small slices need no task of
    their own.  ``_slice`` numbers them in the order of (cookie, date); a second
    is never cut, a cookie is wherever a slice ends.  Store it before it is used
    twice."""
    dealt = winners.repartitionByRange(ranges, "cookie", "event_date")
    if rows is None:
        return dealt.withColumn("_slice", F.spark_partition_id())
    # range << 33 plus the row's place in its range, in the rows' order
    at = F.monotonically_increasing_id()
    dealt = dealt.sortWithinPartitions("cookie", "event_date").withColumn("_at", at)
    first = F.shiftleft(F.shiftright("_at", 33), 33)
    return dealt.withColumn("_slice", first + F.floor((F.col("_at") - first) / rows)).drop("_at")


def carry_over(parts: DataFrame) -> DataFrame:
    """``cookie, _slice, _after, _latest``: the winner that opens the cookie's
    next slice, and the last line of the cookie's conversions.  One row per
    cookie and slice, aggregated map-side."""
    first = F.min(F.struct("event_date", "is_conv", "pixel", "tie")).alias("_first")
    edges = parts.groupBy("cookie", "_slice").agg(first, F.max(F.when(F.col("is_conv") == 1, F.col("tie"))).alias("_line"))
    of = Window.partitionBy("cookie")
    return edges.select("cookie", "_slice", F.lead("_first").over(of.orderBy("_slice")).alias("_after"), F.max("_line").over(of).alias("_latest"))


def label_slices(timeline: DataFrame, hot: DataFrame, parts: DataFrame, lk: PixelLookups) -> DataFrame:
    """The rows of :func:`label_next`, with one exchange and one sort of the
    timeline: a cookie that is not ``hot`` lies in one window, a hot one in its
    slices ``parts`` (:func:`sliced`), whose ends meet the event after them by
    :func:`carry_over`.  No window holds more than a slice, or the rows
    a cookie may have without being hot.

    Conversions without a cookie follow no impression and are left out."""
    cold = timeline.where(F.col("cookie").isNotNull()).join(hot, "cookie", "left_anti").withColumn("_slice", F.lit(-1))
    t = cold.unionByName(parts)
    # latest first: a second's winner is its first row, the event after it the winner before
    w = Window.partitionBy("cookie", "_slice").orderBy(*[F.desc(c) for c in ("event_date", "is_conv", "tie", "ord")])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("_later", F.lag("event_date").over(w))
    wins = F.col("_later").isNull() | (F.col("_later") != F.col("event_date"))
    t = t.withColumn("_win", F.when(wins, F.struct("event_date", "is_conv", "pixel", "tie")))
    t = t.withColumn("_next", F.last("_win", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    # undated impressions come last here, so what was seen up to them is all of the window
    t = t.withColumn("_line", F.max(F.when(F.col("is_conv") == 1, F.col("tie"))).over(upto))
    imps = t.where(F.col("_win").isNotNull() & (F.col("is_conv") == 0)).join(carry_over(parts), ["cookie", "_slice"], "left")
    imps = imps.withColumn("_next", F.coalesce("_next", "_after"))
    imps = imps.withColumn("_last_line", F.col("_next.tie") == F.coalesce("_latest", "_line"))
    return _matched(imps, lk)


def _matched(imps: DataFrame, lk: PixelLookups) -> DataFrame:
    """Labels of winning impressions from the event ``_next`` after them;
    ``_last_line`` says whether that belongs to the cookie's last line."""
    pairs = lk.pairs.withColumnRenamed("pixel", "_pp").withColumnRenamed("campaign_id", "_pc").withColumn("_hit", F.lit(1))
    may = (F.col("_next.is_conv") == 1) & (
        (F.col("event_date") != "") | ((F.col("_next.event_date") == MISSING) & F.col("_last_line")))
    # rows without a conversion next carry a key of their own, which no pixel has
    key = F.when(may, F.col("_next.pixel")).otherwise(F.concat(F.lit("\x00"), "cookie"))
    imps = imps.withColumn("_np", key)
    j = imps.join(pairs, (F.col("_np") == F.col("_pp")) & (F.col("campaign_id") == F.col("_pc")), "left")
    return j.select("cookie", "hour", "state", "os", "browser", "category",
                    F.when(F.col("_hit").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("label"))


def label_next(timeline: DataFrame, lk: PixelLookups) -> DataFrame:
    """Label each impression that wins its second 1 iff the next event of its
    cookie (by date text) is a conversion whose pixel lists the impression's
    campaign; the last impression of a cookie gets 0.

    Every retargeting line also stands at date ``-`` of its cookie, where the
    last line decides: an undated impression (before ``-``) is followed by an
    undated conversion only if that belongs to the cookie's last line.

    Same-second rows: a conversion beats an impression, then the larger tie
    value, then the later payload position."""
    t = timeline.withColumn("_day", F.substring("event_date", 1, 8))
    # latest first: a second's winner is its first row, the event after it the winner before
    w = Window.partitionBy("cookie", "_day").orderBy(*[F.desc(c) for c in ("event_date", "is_conv", "tie", "ord")])
    wins = F.lag("event_date").over(w).isNull() | (F.lag("event_date").over(w) != F.col("event_date"))
    t = t.withColumn("_win", F.when(wins, F.struct("event_date", "is_conv", "pixel", "tie")))
    t = t.withColumn("_next", F.last("_win", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("_first", F.last("_win", ignorenulls=True).over(whole))
    t = t.withColumn("_line", F.max(F.when(F.col("is_conv") == 1, F.col("tie"))).over(whole)).where(F.col("_win").isNotNull())
    keep = ["cookie", "event_date", "is_conv", "campaign_id", "hour", "state", "os", "browser", "category", "_next"]
    within = t.where(F.col("_next").isNotNull() & (F.col("is_conv") == 0)).select(*keep, F.lit(True).alias("_last_line"))
    # the last winner of a day: the next day's first winner follows it
    days = Window.partitionBy("cookie").orderBy("_day")
    last = t.where(F.col("_next").isNull()).withColumn("_next", F.lead("_first").over(days))
    latest = F.max("_line").over(Window.partitionBy("cookie"))
    last = last.withColumn("_last_line", F.col("_next.tie") == latest)
    imps = within.unionByName(last.where(F.col("is_conv") == 0).select(*keep, "_last_line"))
    return _matched(imps, lk)


def seq_events_mixed(lines: DataFrame, lk: PixelLookups, tie_col: str | None = None) -> DataFrame:
    """Timeline rows from a mixed input (both logs in the same files) in a
    single scan: each line is split once and routed by its first field (32
    characters = retargeting line); raw fields meet the lookups, and only kept
    rows are cleaned.  Same rows as :func:`seq_events` on the separated logs."""
    idx = {f: i for i, f in enumerate(LOG_FIELDS)}
    base = split_once(lines, F.split(F.regexp_replace("value", "\t+\\z", ""), "\t"), keep=(tie_col,) if tie_col else ())
    base = base.withColumnRenamed("_arr", "_a").where(F.size("_a") > 1)
    a = F.col("_a")

    def fld(name):
        return F.try_element_at(a, F.lit(idx[name] + 1))
    is_conv_line = F.length(a.getItem(0)) == COOKIE_LENGTH
    payloads = F.slice(a, 2, F.size(a) - 1)
    used = ("cookie", "timestamp", "campaign_id", "geo_location", "os", "browser")
    tie = F.col(tie_col).cast("bigint") if tie_col else F.when(
        is_conv_line, F.xxhash64(a.getItem(0), payloads)).otherwise(F.xxhash64(*[fld(c) for c in used]))
    # one row per payload for a retargeting line, one row (no payload) otherwise
    ex = base.select(
        is_conv_line.alias("_c"), tie.alias("tie"), F.when(is_conv_line, a.getItem(0)).otherwise(fld("cookie")).alias("cookie"),
        *[fld(c).alias("_" + c) for c in used if c != "cookie"],
        F.posexplode_outer(F.when(is_conv_line, payloads)).alias("_i", "_p"))
    ex = split_once(ex, F.when(F.col("_c"), F.regexp_extract("_p", RE_CMPN, 1)),
                    keep=[c for c in ex.columns]).withColumnRenamed("_arr", "_pix")
    # one lookup of both kinds, one inner join: a row meets the ids of its own kind
    ids = lk.category.select(F.lit(False).alias("_kind"), F.col("campaign_id").alias("_known"), "category").unionByName(
        lk.pixels.select(F.lit(True).alias("_kind"), F.col("pixel").alias("_known"), F.lit(None).cast("string").alias("category")))
    ex = ex.withColumn("_id", F.when(F.col("_c"), F.col("_pix")).when(F.col("_campaign_id").isNotNull(), norm_marker("_campaign_id")))
    if lk.is_table:
        ex = may_match(ex, "_id", key_filter(ids, "_known"))
    ex = ex.join(ids, (F.col("_c") == F.col("_kind")) & (F.col("_id") == F.col("_known")))
    ex = ex.where(F.col("_c") | (F.col("_timestamp").isNotNull() & F.col("cookie").isNotNull() & (norm_marker("cookie") != MISSING)))
    conv = F.col("_c")
    date = F.when(conv, payload_extract("_p", RE_DATE)).otherwise(format_epoch_ms(norm_marker("_timestamp")))
    ex = ex.withColumn("event_date", date)

    def of_imp(c):
        return F.when(~conv, c)
    return ex.select(
        "cookie", "event_date", F.when(conv, 1).otherwise(0).alias("is_conv"), "tie",
        F.when(conv, F.col("_i") + 1).otherwise(0).alias("ord"), F.when(conv, norm_marker("_pix")).alias("pixel"),
        of_imp(F.col("_id")).alias("campaign_id"), of_imp(F.regexp_extract("event_date", RE_SEQ_HOUR, 1)).alias("hour"),
        of_imp(geo_state(norm_marker("_geo_location"))).alias("state"),
        of_imp(F.when(F.col("_os").isNull(), F.lit("")).otherwise(clean_os(norm_marker("_os"), False))).alias("os"),
        of_imp(F.when(F.col("_browser").isNull(), F.lit("")).otherwise(clean_browser(norm_marker("_browser"), False))).alias("browser"),
        of_imp(norm_marker("category")).alias("category"))
