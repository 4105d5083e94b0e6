"""Collect conversions: fractional conversion credit by hour group, state,
OS, browser and category.  A conversion of a pixel with n map entries
gives 1/n to each entry's category (duplicate entries kept)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelflow.constants import RE_CMPN, RE_STATE, RE_BRWSOS
from pixelflow.functions.hours import hour_group_conversions
from pixelflow.functions.text import clean_browser, clean_os, payload_extract
from pixelflow.functions.useragent import classify_browser, classify_os
from pixelflow.operators.aggregates import CONV_DIMS, count_by, sum_by
from pixelflow.operators.joins import fan_out
from pixelflow.operators.keyfilter import reduced
from pixelflow.sources.logs import split_once
from pixelflow.sources.config import PixelLookups, pixel_lookups


def raw_dims(conv: DataFrame, lk: PixelLookups) -> DataFrame:
    """Per conversion of a known pixel: ``_pix``, its hour group and state, and
    the user agent as it stands (``_ua``).

    ``conv`` has ``cookie`` and ``payload`` (first payload of the line).
    The semi join on the pixel comes first (unknown pixels leave before any
    regex work), then the payload dimensions."""
    df = conv.where((F.coalesce(F.col("cookie"), F.lit("")) != "")
                    & (F.coalesce(F.col("payload"), F.lit("")) != ""))
    # the pixel id once per conversion (generator barrier, see split_once),
    # then a broadcast semi join on it
    df = split_once(df, F.regexp_extract("payload", RE_CMPN, 1), keep=("payload",)).withColumnRenamed("_arr", "_pix")
    known = lk.pixels.withColumnRenamed("pixel", "_known")
    df = reduced(df, "_pix", lk, "pixels").join(known, F.col("_pix") == F.col("_known"), "left_semi")
    return df.select(
        F.col("_pix"),
        hour_group_conversions("payload").alias("hour_group"),
        payload_extract("payload", RE_STATE).alias("state"),
        payload_extract("payload", RE_BRWSOS).alias("_ua"))


def collect_conversions(spark: SparkSession, conv: DataFrame, pixels: str | PixelLookups) -> DataFrame:
    """``(hour_group, state, os, browser, category, conv)`` with ``conv`` DOUBLE.

    Conversions are counted per pixel, hour group, state and raw user agent
    first, so the agent rules run once per distinct agent of a group and not
    once per conversion; the counts are then named, spread over the pixel's
    categories and summed.  ``pixels``: the map as a string, or lookups of a
    map kept as a table."""
    if pixels is None:
        raise ValueError("pixel map is required")
    lk = pixel_lookups(spark, pixels)
    counts = count_by(raw_dims(conv, lk), ("_pix", "hour_group", "state", "_ua"), "_n")
    named = counts.select("_pix", "hour_group", "state", clean_os(classify_os("_ua")).alias("os"),
                          clean_browser(classify_browser("_ua")).alias("browser"), "_n")
    spread = fan_out(named, lk, key="_pix").withColumn("_credit", F.col("_n") * F.col("weight"))
    return sum_by(spread, "_credit", CONV_DIMS, "conv")
