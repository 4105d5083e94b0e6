"""Hourly log scans and tab-separated log parsers.

Two split modes exist in the original jobs and both are kept:

* token mode drops empty fields, so later columns move left
  (:func:`parse_impressions_tokens`, :func:`parse_ctr_log`,
  :func:`parse_retarg_first`);
* field mode keeps interior empty fields and drops trailing ones
  (:func:`parse_impressions_fields`, :func:`parse_retarg_all`,
  :func:`route_mixed`).

Parsers take a DataFrame with a string column ``value`` (what
``spark.read.text`` returns) and return typed string columns; an absent
field is SQL NULL.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pixelflow.constants import LOG_FIELDS, CTR_FIELD_COUNT, COOKIE_LENGTH, TAG_CONV, TAG_IMP


def _tokens(value: Column) -> Column:
    return F.array_remove(F.split(value, "\t"), "")


def _fields(value: Column) -> Column:
    # split that drops trailing empty fields; a line of tabs only has none,
    # an empty line is one empty field
    return F.when(value.rlike("^\t+\\z"), F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(value, "\t+\\z", ""), "\t"))


def split_once(lines: DataFrame, arr: Column, keep=(), extra=()) -> DataFrame:
    """``keep`` columns plus the split array ``_arr``, evaluated once per line.

    The array comes out of a generator (one row per line): filters on parsed
    fields then stay above it, instead of being pushed below the projection
    with the split substituted into them, which evaluates the split again
    for every pushed predicate."""
    return lines.select(*[F.col(k) for k in keep], *extra, F.explode(F.array(arr)).alias("_arr"))


def _named(arr: Column, fields) -> list[Column]:
    return [F.try_element_at(arr, F.lit(i + 1)).alias(name) for i, name in enumerate(fields)]


def _split_then_name(lines: DataFrame, arr: Column, fields, keep) -> DataFrame:
    # the split runs once per line; the named columns index into its result
    return split_once(lines, arr, keep).select(*[F.col(k) for k in keep], *_named(F.col("_arr"), fields))


def parse_impressions_tokens(lines: DataFrame, fields=LOG_FIELDS, keep=()) -> DataFrame:
    """Token-mode impression parse: empty fields are dropped (columns shift)."""
    return _split_then_name(lines, _tokens(F.col("value")), fields, keep)


def parse_ctr_log(lines: DataFrame, keep=()) -> DataFrame:
    """Token-mode parse of the CTR log: the first 56 fields."""
    return parse_impressions_tokens(lines, LOG_FIELDS[:CTR_FIELD_COUNT], keep)


def parse_impressions_fields(lines: DataFrame, fields=LOG_FIELDS, keep=()) -> DataFrame:
    """Field-mode impression parse: interior empty fields are kept."""
    return _split_then_name(lines, _fields(F.col("value")), fields, keep)


def parse_retarg_first(lines: DataFrame, keep=()) -> DataFrame:
    """Retargeting log, token mode: ``cookie`` and the first payload only;
    lines lacking either are dropped."""
    arr = split_once(lines, _tokens(F.col("value")), keep)
    out = arr.select(*[F.col(k) for k in keep],
                     F.try_element_at("_arr", F.lit(1)).alias("cookie"),
                     F.try_element_at("_arr", F.lit(2)).alias("payload"))
    return out.where(F.col("cookie").isNotNull() & F.col("payload").isNotNull())


def parse_retarg_all(lines: DataFrame, keep=()) -> DataFrame:
    """Retargeting log, field mode: ``cookie`` (32 characters) and all payloads."""
    arr = split_once(lines, _fields(F.col("value")), keep)
    arr = arr.where((F.size("_arr") > 1) & (F.length(F.col("_arr").getItem(0)) == COOKIE_LENGTH))
    return arr.select(*[F.col(k) for k in keep], F.col("_arr").getItem(0).alias("cookie"),
                      F.slice("_arr", 2, F.size("_arr") - 1).alias("payloads"))


def route_mixed(lines: DataFrame, keep=()) -> DataFrame:
    """Route a mixed input: a first field of 32 characters marks a retargeting
    line (``CONV``), anything else is an impression line (``IMP``); lines with
    at most one field are dropped."""
    arr = split_once(lines, _fields(F.col("value")), keep, extra=(F.col("value"),))
    kind = F.when(F.length(F.col("_arr").getItem(0)) == COOKIE_LENGTH, F.lit(TAG_CONV)).otherwise(F.lit(TAG_IMP))
    return (arr.where(F.size("_arr") > 1)
               .select(*[F.col(k) for k in keep], F.col("value"), kind.alias("kind")))


def to_lines(df: DataFrame, fields, keep=()) -> DataFrame:
    """Serialise typed string columns to one tab-separated ``value`` column
    (NULL written as an empty field)."""
    cols = [F.coalesce(F.col(f), F.lit("")) for f in fields]
    return df.select(*[F.col(k) for k in keep], F.concat_ws("\t", *cols).alias("value"))


def hour_keys(start: str, days: int) -> list[str]:
    """``yyyyMMddHH`` keys for ``days`` days from ``start`` (``yyyyMMdd``)."""
    if not start:
        raise ValueError("start date is required")
    if days < 0:
        raise ValueError("days must be >= 0")
    d0 = _dt.datetime.strptime(start, "%Y%m%d")
    return [(d0 + _dt.timedelta(days=d, hours=h)).strftime("%Y%m%d%H")
            for d in range(days) for h in range(24)]


def hour_paths(root: str, start: str, days: int) -> list[str]:
    """Plain-directory layout ``<root>/<yyyyMMddHH>``: the candidate folders."""
    return [f"{root.rstrip('/')}/{k}" for k in hour_keys(start, days)]


def scan_hour_range(spark: SparkSession, root: str, start: str, days: int = 1,
                    layout: str = "partitioned", partition_col: str = "dthr",
                    leaf: str | None = None) -> DataFrame:
    """Text lines of ``days`` days of hourly folders from ``start``.

    ``layout="partitioned"``: ``<root>/<partition_col>=yyyyMMddHH/...``, with
    the folder's hour as a string column.  ``layout="dirs"``:
    ``<root>/<yyyyMMddHH>[/<leaf>]`` (``leaf``: a file or a folder of part
    files under each hour), with the hour taken from the path in the same column.  Ranges of any length take the same path: one
    glob with a day pattern per day, so only the folders of the range are
    listed below the root.  A missing hour is skipped; a missing root, or a
    range without any hour, raises Spark's path-not-found error.
    """
    keys = hour_keys(start, days)
    base = root.rstrip("/")
    if layout not in ("partitioned", "dirs"):
        raise ValueError(f"unknown layout {layout!r}")
    schema = f"value string, {partition_col} string"
    if not keys:
        return spark.createDataFrame([], schema)
    hours = "{" + ",".join(dict.fromkeys(k[:8] for k in keys)) + "}[0-9][0-9]"
    if layout == "partitioned":
        scan = spark.read.schema("value string").option("basePath", base).text(f"{base}/{partition_col}={hours}")
        # folders without any file give no partition column
        hour = F.col(partition_col).cast("string") if partition_col in scan.columns else F.lit(None).cast("string")
        return scan.where(hour.between(keys[0], keys[-1])).withColumn(partition_col, hour)
    scan = spark.read.text(f"{base}/{hours}" + (f"/{leaf}" if leaf else ""))
    return scan.withColumn(partition_col, _path_hour(F.col("_metadata.file_path"), partition_col))


def _path_hour(path, partition_col: str):
    """The hour of a file: its deepest folder named ``yyyyMMddHH``, with or
    without ``<partition_col>=`` before it (``''`` without any)."""
    return F.regexp_extract(path, f".*/(?:{re.escape(partition_col)}=)?([0-9]{{10}})(?:/|$)", 1)


MANIFEST_SCHEMA = "hour string, path string, files bigint, bytes bigint"


def hour_manifest(spark: SparkSession, root: str, partition_col: str = "dthr") -> DataFrame:
    """``(hour, path, files, bytes)``: one row per folder of data files below
    ``root``, whatever the layout or leaf, from one listing that Spark spreads
    over its executors; no file is opened.  Files outside an hour's folder are
    left out.  Kept as a table (and appended to as hours arrive), it replaces
    the listing of every later scan."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root.rstrip("/"))
               .select("path", "length"))
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    rows = listing.select(_path_hour(F.concat(folder, F.lit("/")), partition_col).alias("hour"), folder.alias("path"), "length")
    return (rows.where(F.col("hour") != "").groupBy("hour", "path")
                .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def scan_manifest(spark: SparkSession, manifest: DataFrame, start: str, days: int = 1,
                  partition_col: str = "dthr", leaf: str | None = None) -> DataFrame:
    """Text lines and hour of ``days`` days from ``start``, read from exactly
    the manifest's folders of the range (``leaf``: only folders of that name).
    Below the root nothing else is listed, and of the manifest only the
    range's paths (at most a few an hour) reach the driver.  An hour without a
    row is skipped; a range without any raises ``ValueError``."""
    keys = hour_keys(start, days)
    empty = spark.createDataFrame([], f"value string, {partition_col} string")
    if not keys:
        return empty
    rows = manifest.where(F.col("hour").between(keys[0], keys[-1]) & (F.col("files") > 0))
    if leaf:
        rows = rows.where(F.substring_index("path", "/", -1) == leaf)
    paths = sorted(r.path for r in rows.select("path").distinct().collect())
    if not paths:
        raise ValueError(f"the manifest has no hour from {keys[0]} to {keys[-1]}")
    scan = spark.read.schema("value string").text(paths)
    return scan.select("value", _path_hour(F.col("_metadata.file_path"), partition_col).alias(partition_col))
