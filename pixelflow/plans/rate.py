"""Aggregate: smoothed conversion rate per context.

Only hour groups 1..4 are read, and only groups present on both sides
(folder-exists test of the original).  Impressions left-join conversions
on the five dimensions; conversions without impressions are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pixelflow.constants import RATE_HOUR_GROUPS, TAG_IMP, TAG_CONV
from pixelflow.functions.scalars import smoothed_rate
from pixelflow.operators.aggregates import CONV_DIMS
from pixelflow.sources.config import local_table
from pixelflow.sources.intermediate import parse_intermediate


def _rate_groups(spark) -> DataFrame:
    return local_table(spark, [(g,) for g in RATE_HOUR_GROUPS], "hour_group string not null")


def _groups_with(side: DataFrame, value: str) -> DataFrame:
    """Hour groups 1..4 that have rows on ``side``: at most four rows (semi
    join with the four-row group table), so safe to broadcast."""
    present = side.where(F.col(value).isNotNull()).select("hour_group").distinct()
    return F.broadcast(present.join(F.broadcast(_rate_groups(side.sparkSession)), "hour_group", "left_semi"))


def agg_rate(imp_agg: DataFrame, conv_agg: DataFrame) -> DataFrame:
    """``(dims, imp, conv, rate)`` from the two aggregates.

    The hour groups kept (1..4, present on the conversion side) come from a
    broadcast semi join rather than an IN filter, so the optimizer cannot
    push the group test below the aggregates into the scans, where it would
    evaluate the hour expression a second time per input row.  The join
    with the conversions is on the aggregates' own grouping keys, so it
    reuses their hash partitioning."""
    kept = imp_agg.join(_groups_with(conv_agg, "conv"), "hour_group", "left_semi")
    return _rates(kept, conv_agg)


def _rates(imp_agg: DataFrame, conv_agg: DataFrame) -> DataFrame:
    j = imp_agg.join(conv_agg, list(CONV_DIMS), "left")
    out = j.select(*CONV_DIMS, F.col("imp").cast("double").alias("imp"),
                   F.coalesce(F.col("conv"), F.lit(0.0)).alias("conv"))
    return out.where(F.col("imp") > 0).withColumn("rate", smoothed_rate("conv", "imp"))


def agg_rate_bucketed(spark, imp_table: str, conv_table: str) -> DataFrame:
    """:func:`agg_rate` on tables written by
    :func:`pixelflow.sources.intermediate.write_bucketed`: bucket meets bucket,
    so the plan has no exchange.  The hour groups (four at most) that have
    conversions are looked up first and are filters of both scans."""
    imp, conv = spark.table(imp_table), spark.table(conv_table)
    present = conv.where(F.col("hour_group").isin(*RATE_HOUR_GROUPS) & F.col("conv").isNotNull())
    groups = sorted(r[0] for r in present.select("hour_group").distinct().collect())
    kept = F.col("hour_group").isin(*groups) if groups else F.lit(False)
    return _rates(imp.where(kept), conv.where(kept))


def agg_rate_from_lines(imp_lines: DataFrame, conv_lines: DataFrame) -> DataFrame:
    """The same job on text intermediates (``hg state os browser category TAG
    value`` lines, one DataFrame per side); returns ``(key, imp, conv, rate)``
    with ``key`` the five dimensions joined by tabs."""
    def side(lines, tag):
        p = parse_intermediate(lines).where(F.col("tag") == tag)
        return p.withColumn("hour_group", F.split("key", "\t")[0])
    imp, conv = side(imp_lines, TAG_IMP), side(conv_lines, TAG_CONV)
    # the groups present on both sides come from the (much smaller) pivoted
    # rows, so each side's lines are read once
    tagged = imp.unionByName(conv).where(F.col("hour_group").isin(*RATE_HOUR_GROUPS) & F.col("value").isNotNull())
    rows = tagged.groupBy("key", "hour_group").agg(
        *[F.coalesce(F.sum(F.when(F.col("tag") == t, F.col("value"))), F.lit(0.0)).alias(t.lower()) for t in (TAG_IMP, TAG_CONV)],
        *[F.max((F.col("tag") == t).cast("int")).alias("_" + t) for t in (TAG_IMP, TAG_CONV)])
    both = rows.groupBy("hour_group").agg(F.max("_" + TAG_IMP).alias("_i"), F.max("_" + TAG_CONV).alias("_c"))
    both = both.where("_i = 1 AND _c = 1").select("hour_group")          # four rows at most
    piv = rows.where(F.col("imp") > 0).join(F.broadcast(both), "hour_group", "left_semi")
    return piv.select("key", "imp", "conv").withColumn("rate", smoothed_rate("conv", "imp"))


def _group_folders(spark, root: str) -> set[str]:
    """The hour groups 1..4 that have a folder under ``root`` (four look-ups)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return {g for g in RATE_HOUR_GROUPS if fs.exists(hadoop.Path(f"{root.rstrip('/')}/hour_group={g}"))}


def agg_rate_from_folders(spark, imp_root: str, conv_root: str) -> DataFrame:
    """The rate job on intermediates written by
    :func:`pixelflow.sources.intermediate.write_intermediate`: of the hour
    group folders 1..4 only those that stand on both sides are read (partition
    pruning); returns ``(key, imp, conv, rate)``."""
    groups = sorted(_group_folders(spark, imp_root) & _group_folders(spark, conv_root))

    def side(root):
        lines = spark.read.schema("value string").text(root)
        if not groups:                                 # nothing in common
            return lines.select("value").where(F.lit(False))
        group = F.col("hour_group").cast("string")
        return lines.where(group.isin(*RATE_HOUR_GROUPS)).where(group.isin(*groups)).select("value")
    return agg_rate_from_lines(side(imp_root), side(conv_root))
