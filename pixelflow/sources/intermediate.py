"""Text intermediate format ``hg state os browser category TAG value``.

The jobs hand typed DataFrames to each other; this format is only for
reading or writing files in the original layout.
"""

from pyspark.sql import DataFrame, functions as F

from pixelflow.functions.scalars import join_slice

DIMS = ("hour_group", "state", "os", "browser", "category")


def _line(tag: str, value_col: str):
    return F.concat_ws("\t", *[F.col(d) for d in DIMS], F.lit(tag), F.col(value_col).cast("string"))


def to_intermediate_lines(agg: DataFrame, tag: str, value_col: str) -> DataFrame:
    """Aggregate rows -> tab lines with a tag column (``IMP`` or ``CONV``)."""
    return agg.select(_line(tag, value_col).alias("value"))


def parse_intermediate(lines: DataFrame) -> DataFrame:
    """Lines with exactly 7 fields -> ``(key, tag, value)``: key = first five
    fields joined by tabs, tag = field 6, value = field 7 as DOUBLE."""
    arr = F.split(F.regexp_replace("value", "\t+\\z", ""), "\t")
    return (lines.select(arr.alias("a")).where(F.size("a") == 7)
                 .select(join_slice("a", 0, 4).alias("key"), F.col("a")[5].alias("tag"),
                         F.col("a")[6].try_cast("double").alias("value")))


def write_intermediate(agg: DataFrame, tag: str, value_col: str, path: str) -> None:
    """Write an aggregate as tagged 7-field text lines, one folder per hour
    group (``<path>/hour_group=<g>/``); the line keeps the group as its first
    field.  No folder is written for a group without rows; output replaced."""
    lines = agg.select(F.col("hour_group").alias("_g"), _line(tag, value_col).alias("value"))
    (lines.hint("rebalance", "_g").withColumnRenamed("_g", "hour_group")
          .write.mode("overwrite").partitionBy("hour_group").text(path))


def write_bucketed(agg: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write an aggregate as the catalog table ``table`` at ``path``: Parquet
    in ``buckets`` buckets of the five dimensions, sorted by them, one file a
    bucket.  Two sides with the same number of buckets join without an
    exchange, as often as they are read.  Output replaced."""
    (agg.repartition(buckets, *DIMS).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, *DIMS).sortBy(*DIMS).saveAsTable(table))
