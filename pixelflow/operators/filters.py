"""Row filters: map membership, ad-group list, required fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pixelflow.constants import MISSING, RE_CMPN
from pixelflow.functions.markers import norm_marker
from pixelflow.operators.keyfilter import reduced
from pixelflow.sources.config import PixelLookups


def filter_known_campaigns(imp: DataFrame, lk: PixelLookups) -> DataFrame:
    """Impressions whose (normalised) ``campaign_id`` is in the pixel map."""
    known = lk.campaigns.withColumnRenamed("campaign_id", "_known")
    df = imp.where(F.col("campaign_id").isNotNull()).withColumn("_camp", norm_marker("campaign_id"))
    df = reduced(df, "_camp", lk, "campaigns")
    return df.join(known, F.col("_camp") == F.col("_known"), "left_semi").drop("_camp")


def filter_known_pixels(conv: DataFrame, lk: PixelLookups, payload: str = "payload") -> DataFrame:
    """Conversions whose payload ``cmpn`` is a pixel of the map."""
    known = lk.pixels.withColumnRenamed("pixel", "_known")
    df = reduced(conv.withColumn("_pix", F.regexp_extract(F.col(payload), RE_CMPN, 1)), "_pix", lk, "pixels")
    return df.join(known, F.col("_pix") == F.col("_known"), "left_semi").drop("_pix")


def filter_adgroups(imp: DataFrame, adgroups: DataFrame | None) -> DataFrame:
    """Rows whose ``adgroup_id`` is in the list; ``adgroups=None`` (empty list)
    keeps every row that has an ad group."""
    df = imp.where(F.col("adgroup_id").isNotNull())
    if adgroups is None:
        return df
    lk = adgroups.withColumnRenamed("adgroup_id", "_adg")
    return df.join(lk, F.col("adgroup_id") == F.col("_adg"), "left_semi")


def require_cookie(df: DataFrame) -> DataFrame:
    """Drop rows without a cookie (absent or a missing marker)."""
    return df.where(F.col("cookie").isNotNull() & (norm_marker("cookie") != MISSING))


def require_ctr_ids(df: DataFrame) -> DataFrame:
    """Ad group and campaign must be present and non-empty."""
    return df.where((F.coalesce(F.col("adgroup_id"), F.lit("")) != "")
                    & (F.coalesce(F.col("campaign_id"), F.lit("")) != ""))


def require_timestamp(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp").isNotNull())
