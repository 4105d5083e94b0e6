"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pixelflow.session import shared_dir

#: Fixed value: the character class of a word, as Java / RE2 / Python regex text.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), native."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_SCOPES: list[list[str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the
    lineage, survives lost executors, and later reads do not redo the work."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored inside are deleted at the end, but for those stored by
    the function it gives: results must not read the others lazily."""
    _SCOPES.append([])
    kept: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = stored(df, name)
        kept.append(_SCOPES[-1].pop())
        return out
    try:
        yield keep
    finally:
        made = _SCOPES.pop()
        if _SCOPES:
            _SCOPES[-1].extend(kept)
        for p in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def importable(spark: SparkSession) -> None:
    """Python workers on this machine find this package where the driver has
    it (on a cluster, ship it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def release() -> None:
    """Give free memory of this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
                rows: int = 1024, done: Callable[[], None] | None = None) -> DataFrame:
    """``fn`` over slices of at most ``rows`` rows of the Arrow batches, one at
    a time (memory bounded by a slice).  After a partition, ``done`` is called
    and free memory goes back to the system: a Python worker lives on and serves
    other stages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                yield fn(b.slice(at, rows))
        if done:
            done()
        release()
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)
