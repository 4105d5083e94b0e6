"""The five jobs with the original job parameters: log folders, start date
(``yyyyMMdd``), number of days, configuration string and output folder.

Each runner is scan -> parse -> job -> write, one Spark plan per output;
outputs replace existing ones.  With ``layout="manifest"`` a log folder is
instead the path of a stored hour manifest of the logs.  A missing start date or output path is a
``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelflow.constants import TAG_CONV, TAG_IMP
from pixelflow.plans.conversions import collect_conversions
from pixelflow.plans.ctr import ctr_leaves
from pixelflow.plans.impressions import collect_impressions
from pixelflow.plans.rate import agg_rate_from_folders
from pixelflow.plans.sequence import HOT_ROWS, sequence_labels_split
from pixelflow.session import delete_dir, shared_dir
from pixelflow.sources import logs, sinks
from pixelflow.sources.intermediate import write_intermediate


def _check(start: str | None, out: str | None, *inputs: str | None) -> None:
    if not start:
        raise ValueError("start date (yyyyMMdd) is required")
    if not out:
        raise ValueError("output path is required")
    if not all(inputs):
        raise ValueError("input path is required")


def _scan(spark, root, start, days, layout, leaf=None) -> DataFrame:
    if layout == "manifest":
        kept = spark.read.schema(logs.MANIFEST_SCHEMA).parquet(root)
        return logs.scan_manifest(spark, kept, start, days, leaf=leaf).select("value")
    return logs.scan_hour_range(spark, root, start, days, layout=layout, leaf=leaf).select("value")


def run_collect_impressions(spark: SparkSession, log_root: str, start: str, days: int, pixels: str,
                            out: str, layout: str = "partitioned", leaf: str | None = None) -> None:
    """Impression log (token mode) -> counts -> tagged text per hour-group folder."""
    _check(start, out, log_root)
    imp = logs.parse_impressions_tokens(_scan(spark, log_root, start, days, layout, leaf))
    write_intermediate(collect_impressions(spark, imp, pixels), TAG_IMP, "imp", out)


def run_collect_conversions(spark: SparkSession, retarg_root: str, start: str, days: int, pixels: str,
                            out: str, layout: str = "partitioned", leaf: str | None = None) -> None:
    """Retargeting log (first payload) -> fractional credit -> tagged text per hour-group folder."""
    _check(start, out, retarg_root)
    conv = logs.parse_retarg_first(_scan(spark, retarg_root, start, days, layout, leaf))
    write_intermediate(collect_conversions(spark, conv, pixels), TAG_CONV, "conv", out)


def run_agg_rate(spark: SparkSession, imp_out: str, conv_out: str, out: str) -> None:
    """Rate per context from the two collect outputs; one folder per hour
    group, lines ``hg state os browser category imp conv rate`` (rate with 8
    decimals)."""
    _check("-", out, imp_out, conv_out)
    rate = agg_rate_from_folders(spark, imp_out, conv_out)
    lines = rate.select(F.split("key", "\t")[0].alias("hour_group"),
                        F.concat_ws("\t", "key", F.col("imp").cast("string"), F.col("conv").cast("string"),
                                    F.format_string("%.8f", "rate")).alias("value"))
    lines.hint("rebalance", "hour_group").write.mode("overwrite").partitionBy("hour_group").text(out)


def run_sequence(spark: SparkSession, log_root: str, retarg_root: str, start: str, days: int,
                 pixels: str, out: str, layout: str = "partitioned", log_leaf: str | None = None,
                 retarg_leaf: str | None = None, compression: str | None = None, hot_rows: int = HOT_ROWS) -> None:
    """Both logs -> labelled sequence rows, flat text.  Every line of either
    folder is routed by its first field; the timeline stands in the shared
    folder while the job runs, and a cookie with more than ``hot_rows``
    rows is combined by second and cut into ranges."""
    _check(start, out, log_root, retarg_root)
    lines = _scan(spark, log_root, start, days, layout, log_leaf).unionByName(
        _scan(spark, retarg_root, start, days, layout, retarg_leaf))
    folder = shared_dir(spark, "timeline")
    try:
        sinks.write_flat(sequence_labels_split(spark, lines, pixels, hot_rows=hot_rows, folder=folder), out, compression=compression)
    finally:
        delete_dir(spark, folder)


def run_ctr_leaves(spark: SparkSession, log_root: str, start: str, days: int, adgroups: str | None,
                   out: str, layout: str = "partitioned", leaf: str | None = None) -> None:
    """CTR log (token mode, 56 fields) -> leaves, one text folder per hour
    group; the line keeps the group as its first of eight fields."""
    _check(start, out, log_root)
    ctr = ctr_leaves(spark, logs.parse_ctr_log(_scan(spark, log_root, start, days, layout, leaf)), adgroups)
    sinks.write_partitioned(ctr, out, "hour_group", fmt="text", keep_by=True)
