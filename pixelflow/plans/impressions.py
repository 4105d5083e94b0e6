"""Collect impressions: impression count by hour group, state, OS, browser,
category for impressions of mapped campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelflow.functions.geo import geo_state
from pixelflow.functions.hours import hour_group_impressions
from pixelflow.functions.markers import norm_marker
from pixelflow.functions.text import clean_browser, clean_os
from pixelflow.constants import MISSING
from pixelflow.operators.aggregates import CONV_DIMS, count_by
from pixelflow.operators.joins import with_category
from pixelflow.sources.config import PixelLookups, pixel_lookups


def _cleaned(c: str, fn) -> "F.Column":
    return F.when(F.col(c).isNull(), F.lit(MISSING)).otherwise(fn(norm_marker(c)))


def impression_dims(imp: DataFrame, lk: PixelLookups) -> DataFrame:
    """Per kept impression: the five dimensions (campaign in map; category is
    the campaign's last map entry, markers folded to ``-``)."""
    df = imp.where(F.col("campaign_id").isNotNull()).withColumn("_camp", norm_marker("campaign_id"))
    # broadcast join = membership filter and category lookup in one step;
    # the per-row cleaning below only runs on the kept rows
    df = with_category(df, lk, key="_camp")
    return df.select(
        hour_group_impressions(norm_marker("timestamp")).alias("hour_group"),
        geo_state(norm_marker("geo_location")).alias("state"),
        _cleaned("os", clean_os).alias("os"),
        _cleaned("browser", clean_browser).alias("browser"),
        norm_marker("category").alias("category"))


def collect_impressions(spark: SparkSession, imp: DataFrame, pixels: str | PixelLookups) -> DataFrame:
    """``(hour_group, state, os, browser, category, imp)`` with ``imp`` BIGINT.
    ``pixels``: the map as a string, or lookups of a map kept as a table."""
    if pixels is None:
        raise ValueError("pixel map is required")
    return count_by(impression_dims(imp, pixel_lookups(spark, pixels)), CONV_DIMS, "imp")
