"""Lookup joins against the pixel-map tables of
:func:`pixelflow.sources.config.pixel_lookups`; the planner broadcasts them
while their size statistics stay under its threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pixelflow.operators.keyfilter import reduced
from pixelflow.sources.config import PixelLookups


def with_category(df: DataFrame, lk: PixelLookups, key: str = "campaign_id",
                  how: str = "inner") -> DataFrame:
    """Attach the last-wins ``category`` of ``key``; ``inner`` also drops rows
    whose campaign is not in the map (semi join and lookup in one join)."""
    if how == "inner":
        df = reduced(df, key, lk, "campaigns")
    cat = lk.category.withColumnRenamed("campaign_id", "_lk_campaign")
    out = df.join(cat, F.col(key) == F.col("_lk_campaign"), how)
    return out.drop("_lk_campaign")


def fan_out(df: DataFrame, lk: PixelLookups, key: str = "pixel") -> DataFrame:
    """Repeat each row once per map entry of its pixel, with ``weight = 1/n``
    and the entry's ``category``; rows of unknown pixels are dropped."""
    df = reduced(df, key, lk, "pixels")
    w = lk.weights.withColumnRenamed("pixel", "_fan_pixel")
    return df.join(w, F.col(key) == F.col("_fan_pixel"), "inner").drop("_fan_pixel")
