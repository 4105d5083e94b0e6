"""Writers: one folder per hour group, or one flat folder; output replaced.

The text format is the original one: fields joined by tabs, no quoting,
no header; NULL is written as an empty field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _as_line(df: DataFrame, cols) -> DataFrame:
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
                     .alias("value"))


def write_partitioned(df: DataFrame, path: str, by: str = "hour_group",
                      fmt: str = "parquet", keep_by: bool = False) -> None:
    """One sub-folder per value of ``by``; no file is written for a value that
    has no rows; an existing output is replaced.  Rows are rebalanced by
    ``by`` first (``REBALANCE`` hint): few files per folder, and AQE splits a
    value holding a large share of the rows over several tasks instead of
    funnelling it through one.  ``keep_by``: text lines keep ``by`` in its place."""
    df = df.hint("rebalance", by)
    if fmt == "text":
        rest = [c for c in df.columns if keep_by or c != by]
        df = df.select(F.col(by), F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                      for c in rest]).alias("value"))
        df.write.mode("overwrite").partitionBy(by).text(path)
    else:
        df.write.mode("overwrite").partitionBy(by).format(fmt).save(path)


def write_flat(df: DataFrame, path: str, fmt: str = "text", compression: str | None = None) -> None:
    """Flat output folder (tab-separated text by default); replaced if present.
    ``compression``: a text codec such as ``gzip`` (default: none, the
    original format); readers decompress by file suffix."""
    if fmt == "text":
        w = _as_line(df, df.columns).write.mode("overwrite")
        if compression:
            w = w.option("compression", compression)
        w.text(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def read_flat(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read tab-separated text written by :func:`write_flat` into ``schema``."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arr = F.split(F.col("value"), "\t", -1)
    lines = spark.read.text(path).select(arr.alias("_a"))
    return lines.select(*[F.try_element_at("_a", F.lit(i + 1)).try_cast(f.dataType).alias(f.name)
                          for i, f in enumerate(schema.fields)])
