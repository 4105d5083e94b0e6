"""Aggregations (all partial + final: map-side combine before the shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pixelflow.constants import TAG_IMP, TAG_CONV
from pixelflow.functions.scalars import ctr_ratio

CONV_DIMS = ("hour_group", "state", "os", "browser", "category")
CTR_DIMS = ("hour_group", "state", "view", "vertical", "campaign")


def count_by(df: DataFrame, dims=CONV_DIMS, name: str = "imp") -> DataFrame:
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, value: str, dims=CONV_DIMS, name: str = "conv") -> DataFrame:
    return df.groupBy(*dims).agg(F.sum(value).cast("double").alias(name))


def ctr_by(df: DataFrame, dims=CTR_DIMS) -> DataFrame:
    agg = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("imp"),
                                F.sum("click").cast("bigint").alias("clk"))
    return agg.withColumn("ctr", ctr_ratio("clk", "imp"))


def tag_pivot(tagged: DataFrame, key: str = "key") -> DataFrame:
    """``(key, tag, value)`` rows -> ``(key, imp, conv)``; a tag missing for a
    key gives 0.  Keys are unique per tag, so the sum equals the last value."""
    return (tagged.groupBy(key)
                  .agg(F.coalesce(F.sum(F.when(F.col("tag") == TAG_IMP, F.col("value"))), F.lit(0.0)).alias("imp"),
                       F.coalesce(F.sum(F.when(F.col("tag") == TAG_CONV, F.col("value"))), F.lit(0.0)).alias("conv")))


def pixel_lists(pm: DataFrame, of: str = "campaign_id") -> DataFrame:
    """``pixel -> sorted list`` of campaigns (or categories), duplicates kept.

    Meant for the configuration map (bounded by its size check); the jobs
    themselves test membership with the distinct pair table and a join
    instead of gathering lists."""
    return pm.groupBy("pixel").agg(F.array_sort(F.collect_list(of)).alias(of + "s"))
