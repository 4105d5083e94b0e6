"""CTR leaves: impressions, clicks and CTR by hour group, state,
viewability, top vertical and campaign."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelflow.functions.geo import ctr_state
from pixelflow.functions.hours import hour_group_ctr
from pixelflow.functions.scalars import click_flag, viewability
from pixelflow.functions.weights import pick_top, rank_pairs, weighted_pairs
from pixelflow.operators.aggregates import ctr_by
from pixelflow.operators.filters import filter_adgroups, require_ctr_ids
from pixelflow.sources.config import adgroup_table, spec_entries


def ctr_dims(imp: DataFrame, keep=()) -> DataFrame:
    """Per row: hour_group, state, view, vertical, campaign, click (no marker folding).

    Three projections for the vertical: id / weight arrays, the ranked
    array, then the pick (small generated methods; each array is computed
    once)."""
    ids, ws = weighted_pairs("verticle_list")
    staged = imp.select(
        *[F.col(k) for k in keep],
        hour_group_ctr("date").alias("hour_group"),
        ctr_state("geo_location").alias("state"),
        viewability("visibility").alias("view"),
        F.col("verticle_list").isNull().alias("_no_list"), ids.alias("_ids"), ws.alias("_ws"),
        F.col("campaign_id").alias("campaign"),
        click_flag("click_flag").alias("click"))
    ranked, non_nan = rank_pairs("_ids", "_ws")
    ranked_df = staged.select(*[F.col(k) for k in keep], "hour_group", "state", "view", "_no_list",
                              ranked.alias("_ranked"), non_nan.alias("_non_nan"), "campaign", "click")
    return ranked_df.select(
        *[F.col(k) for k in keep], "hour_group", "state", "view",
        F.when(F.col("_no_list"), F.lit("")).otherwise(pick_top("_ranked", "_non_nan")).alias("vertical"),
        "campaign", "click")


def ctr_leaves(spark: SparkSession, imp: DataFrame, adgroups: str | None = None) -> DataFrame:
    """``(hour_group, state, view, vertical, campaign, imp, clk, ctr)``.

    ``adgroups``: ``pixel|adgroup_id,...``; with no two-part entry every row
    with an ad group is kept."""
    adg = adgroup_table(spark, adgroups) if spec_entries(adgroups, 2) > 0 else None
    df = require_ctr_ids(filter_adgroups(imp, adg))
    return ctr_by(ctr_dims(df))
