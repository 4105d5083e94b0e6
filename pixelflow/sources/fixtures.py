"""Adapter from the ``events`` test table to log-shaped frames.

It only gives rows in the schema the jobs expect; it does none of the
jobs' work.  ``event_type`` view/click become impression-log rows,
purchase/signup become retargeting-log rows; error becomes rows with absent
fields and malformed lines for the operators that drop them.  ``k`` is the integer at
``$.k`` of ``props``.  Fields the jobs never read carry the text ``null``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pixelflow.constants import LOG_FIELDS

# --- fixed values: job configuration used with the test tables ---
PIXEL_SPEC = ("p0|c0|auto,p0|c1|auto,p1|c2|retail,p2|c3|travel,"
              "p2|c4|retail,p2|c0|finance,p2|c5|travel,p3|c5|retail")
ADGROUP_SPEC = "x|a0,x|a1,x|a2"

# --- fixed values: picks used to fill log fields ---
GEOS = ("CA|US|807", "NY|US|501", "TX|US|618", "unknown|US|0", "WA", "|US|1")
BROWSERS = ("Chrome 38", "Internet Explorer 11", "Firefox 33", "unknown", "Safari")
OSES = ("Windows 7", "Windows 8.1", "Mac OS X", "iOS 8 (iPhone)", "null")
VISIBILITY = ("IN_VIEW", "OUT_VIEW", "", "NO_DETECTION")
STATES = ("CA", "NY", "TX", "unknown", "", "")
AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/38.0.2125.104 Safari/537.36",
    "Mozilla/5.0 (Windows NT 6.3; WOW64; Trident/7.0; rv:11.0) like Gecko",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_10) AppleWebKit/600.1.25 (KHTML, like Gecko) Version/8.0 Safari/600.1.25",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 8_0 like Mac OS X) AppleWebKit/600.1.4 (KHTML, like Gecko) Version/8.0 Mobile/12A365 Safari/600.1.4",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1 like Mac OS X) AppleWebKit/537.51 (KHTML, like Gecko) CriOS/38.0.2125.59 Mobile/11D167 Safari/9537.53",
    "Mozilla/5.0 (iPad; CPU OS 8_1 like Mac OS X) AppleWebKit/600.1.4 (KHTML, like Gecko) Version/8.0 Mobile/12B410 Safari/600.1.4",
    "Mozilla/5.0 (Linux; Android 4.4.2; SM-G900P) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/37.0.2062.117 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; U; Android 2.3.6; en-us) AppleWebKit/533.1 (KHTML, like Gecko) Version/4.0 Mobile Safari/533.1",
    "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/42.0.2311.135 Safari/537.36 Edge/12.10136",
    "Mozilla/5.0 (Windows NT 6.2; rv:33.0) Gecko/20100101 Firefox/33.0",
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1; Trident/4.0)",
    "Mozilla/5.0 (compatible; MSIE 10.0; Windows NT 6.2; Trident/6.0)",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/38.0.2125.101 Safari/537.36 OPR/25.0.1614.50",
    "Opera/9.80 (Windows NT 6.0) Presto/2.12.388 Version/12.16",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "curl/7.35.0",
    "Mozilla/5.0 (X11; CrOS x86_64 6310.68.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/38.0.2125.110 Safari/537.36",
)

IMP_TYPES = ("view", "click")
CONV_TYPES = ("purchase", "signup")


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _epoch_ms(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> epoch milliseconds (no time-zone conversion)."""
    secs = F.expr("extract(SECOND FROM ts)")
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000
            + F.hour(ts).cast("bigint") * 3_600_000 + F.minute(ts).cast("bigint") * 60_000
            + F.floor(secs * 1000).cast("bigint"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def impressions(events: DataFrame, with_hour: bool = False) -> DataFrame:
    """Typed impression log: ``event_id`` plus the 59 log fields as strings
    (and ``dthr``, the ``yyyyMMddHH`` hour of the event, when asked)."""
    ev = events.where(F.col("event_type").isin(*IMP_TYPES)).withColumn("k", _k())
    k, uid = F.col("k"), F.col("user_id")
    seg = F.concat(F.lit("v"), (k % 3).cast("string"), F.lit(",0."), (k % 10).cast("string"),
                   F.lit("|v"), ((k + 1) % 3).cast("string"), F.lit(",0.5"))
    filled = {
        "campaign_id": F.concat(F.lit("c"), (k % 7).cast("string")),
        "adgroup_id": F.concat(F.lit("a"), (k % 5).cast("string")),
        "cookie": F.when(k % 17 == 0, F.lit("-")).otherwise(F.md5(uid.cast("string"))),
        "timestamp": F.when(k == 98, F.lit("null")).otherwise(_epoch_ms(F.col("ts")).cast("string")),
        "date": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "geo_location": _pick(GEOS, uid % 6),
        "browser": _pick(BROWSERS, k % 5),
        "os": _pick(OSES, uid % 5),
        "visibility": _pick(VISIBILITY, k % 4),
        "verticle_list": seg,
        "user_seg_list": seg,
        "click_flag": F.when(F.col("event_type") == "click", F.lit("1")).otherwise(F.lit("0")),
    }
    cols = [filled.get(f, F.lit("null")).alias(f) for f in LOG_FIELDS]
    hour = [F.date_format("ts", "yyyyMMddHH").alias("dthr")] if with_hour else []
    return ev.select(F.col("event_id"), *cols, *hour)


def conversions(events: DataFrame) -> DataFrame:
    """Typed retargeting log: ``event_id``, ``cookie``, ``payload``."""
    ev = events.where(F.col("event_type").isin(*CONV_TYPES)).withColumn("k", _k())
    k, uid = F.col("k"), F.col("user_id")
    ua = _pick(AGENTS, (uid + 7 * k) % len(AGENTS))
    payload = F.concat(
        F.lit('{"cmpn":"p'), (k % 5).cast("string"),
        F.lit('","brwsos":"'), ua,
        F.lit('","date":"'), F.date_format("ts", "yyyyMMdd HH:mm:ss"),
        F.lit('","st":"'), _pick(STATES, uid % 6), F.lit('"}'))
    return ev.select("event_id", F.md5(uid.cast("string")).alias("cookie"), payload.alias("payload"))


def impression_lines(events: DataFrame, with_hour: bool = False) -> DataFrame:
    """Impression log as tab lines: ``event_id``, ``value`` (and ``dthr``)."""
    imp = impressions(events, with_hour)
    cols = [F.coalesce(F.col(f), F.lit("")) for f in LOG_FIELDS]
    hour = ["dthr"] if with_hour else []
    return imp.select("event_id", F.concat_ws("\t", *cols).alias("value"), *hour)


def conversion_lines(events: DataFrame) -> DataFrame:
    """Retargeting log as tab lines: ``event_id``, ``value``."""
    c = conversions(events)
    return c.select("event_id", F.concat_ws("\t", "cookie", "payload").alias("value"))


def sparse_impressions(events: DataFrame) -> DataFrame:
    """``error`` events as impression rows that lack one field each (``k`` mod 6:
    timestamp, ad group, campaign absent or empty, location, cookie)."""
    ev = events.where(F.col("event_type") == "error").withColumn("k", _k())
    gap, uid = F.col("k") % 6, F.col("user_id")
    return ev.select(
        "event_id", F.when(gap != 0, _epoch_ms(F.col("ts")).cast("string")).alias("timestamp"),
        F.when(gap != 1, F.concat(F.lit("a"), (F.col("k") % 5).cast("string"))).alias("adgroup_id"),
        F.when(gap == 2, F.lit("")).when(gap != 3, F.concat(F.lit("c"), (F.col("k") % 7).cast("string"))).alias("campaign_id"),
        F.when(gap != 4, _pick(GEOS, uid % 6)).alias("geo_location"),
        F.when(gap != 5, F.md5(uid.cast("string"))).alias("cookie"))


def malformed_lines(events: DataFrame) -> DataFrame:
    """``error`` events as log lines (``k`` mod 6): tabs only, one field, a
    32-character first field alone, one with three payloads and trailing empty
    fields, a short cookie with a payload, an interior empty field."""
    ev = events.where(F.col("event_type") == "error").withColumn("k", _k())
    cookie, k = F.md5(F.col("user_id").cast("string")), F.col("k").cast("string")
    line = (F.when(F.col("k") % 6 == 0, F.lit("\t\t\t")).when(F.col("k") % 6 == 1, k).when(F.col("k") % 6 == 2, cookie)
            .when(F.col("k") % 6 == 3, F.concat_ws("\t", cookie, F.concat(F.lit("x"), k), F.lit(""), F.concat(F.lit("z"), k), F.lit(""), F.lit("")))
            .when(F.col("k") % 6 == 4, F.concat_ws("\t", F.substring(cookie, 1, 31), k)).otherwise(F.concat_ws("\t", F.lit("b"), F.lit(""), k)))
    return ev.select("event_id", line.alias("value"))


def malformed_intermediate(events: DataFrame) -> DataFrame:
    """``error`` events as intermediate lines of six, seven and eight fields."""
    ev = events.where(F.col("event_type") == "error").withColumn("k", _k())
    k = F.col("k").cast("string")
    dims = F.concat_ws("\t", F.lit("1"), F.lit("CA"), F.lit("os"), F.lit("b"), F.concat(F.lit("cat"), k))
    line = (F.when(F.col("k") % 3 == 0, F.concat_ws("\t", dims, F.lit("IMP"))).when(
        F.col("k") % 3 == 1, F.concat_ws("\t", dims, F.lit("IMP"), k)).otherwise(F.concat_ws("\t", dims, F.lit("IMP"), k, k)))
    return ev.select("event_id", line.alias("value"))


def materialize(spark: SparkSession, sf_dir: str, out_dir: str, copies: int = 1) -> dict[str, str]:
    """Write the log-shaped inputs once (typed parquet and tab-separated text
    logs), so jobs can be run and timed on stored logs as in production.
    ``copies``: every event so many times, each copy with users of its own."""
    ev = read_events(spark, sf_dir)
    if copies > 1:
        ev = ev.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        ev = ev.withColumn("event_id", F.col("event_id") * copies + F.col("_c"))
        ev = ev.withColumn("user_id", F.col("user_id") + F.col("_c").cast("bigint") * 1_000_000).drop("_c")
    paths = {k: f"{out_dir.rstrip('/')}/{k}" for k in ("imp", "conv", "imp_lines", "conv_lines")}
    impressions(ev).write.mode("overwrite").parquet(paths["imp"])
    conversions(ev).write.mode("overwrite").parquet(paths["conv"])
    impression_lines(ev).select("value").write.mode("overwrite").text(paths["imp_lines"])
    conversion_lines(ev).select("value").write.mode("overwrite").text(paths["conv_lines"])
    return paths
