"""Sequence rows: per-cookie impression sequence labelled by whether the next
event is a matching conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixelflow.operators.sequence import hot_cookies, hot_winners, label_next, label_slices, seq_events, seq_events_mixed, sliced
from pixelflow.session import shared_dir
from pixelflow.sources.config import PixelLookups, pixel_lookups

#: Timeline rows of one cookie beyond which they are combined by second and cut into slices of that size.
HOT_ROWS = 1_000_000
#: Combined rows a task deals into slices, however small these are.
RANGE_ROWS = 100_000


def sequence_labels(spark: SparkSession, imp: DataFrame, conv_all: DataFrame, pixels: str | PixelLookups,
                    tie_col: str | None = "event_id") -> DataFrame:
    """``(cookie, hour, state, os, browser, category, label)``.

    ``imp``: typed impression log (field mode); ``conv_all``: ``(cookie,
    payloads[])``.  ``tie_col`` orders same-cookie same-second events
    (a conversion always wins over an impression)."""
    if pixels is None:
        raise ValueError("pixel map is required")
    lk = pixel_lookups(spark, pixels)
    return label_next(seq_events(imp, conv_all, lk, tie_col), lk)


def sequence_labels_mixed(spark: SparkSession, lines: DataFrame, pixels: str | PixelLookups,
                          tie_col: str | None = None) -> DataFrame:
    """Same job on one mixed text input (both logs in the same files), read
    in a single scan; ``lines`` has the text column ``value``."""
    if pixels is None:
        raise ValueError("pixel map is required")
    lk = pixel_lookups(spark, pixels)
    return label_next(seq_events_mixed(lines, lk, tie_col), lk)


def sequence_labels_split(spark: SparkSession, lines: DataFrame, pixels: str | PixelLookups, tie_col: str | None = None,
                          hot_rows: int = HOT_ROWS, folder: str | None = None, slice_rows: int = HOT_ROWS) -> DataFrame:
    """Same rows as :func:`sequence_labels_mixed`, for logs in which one cookie
    may hold any share of a day.

    The narrow timeline is written once under ``folder`` (a fresh one in the
    shared folder if not given), so the input is parsed once; cookies of more
    than ``hot_rows`` rows are counted on it, kept as a table whose size lets
    the planner choose the join, combined by second, and stored in slices
    of at most ``slice_rows`` rows, many of which share a task where they are small."""
    if pixels is None:
        raise ValueError("pixel map is required")
    if hot_rows < 1 or slice_rows < 1:
        raise ValueError("hot_rows and slice_rows must be positive")
    lk = pixel_lookups(spark, pixels)
    base = folder or shared_dir(spark, "timeline")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")
    events = kept(seq_events_mixed(lines, lk, tie_col), "events")
    hot = kept(hot_cookies(events, hot_rows), "hot")
    winners = kept(hot_winners(events, hot), "winners")
    parts = kept(sliced(winners, -(-winners.count() // max(slice_rows, RANGE_ROWS)) or 1, slice_rows), "slices")
    return label_slices(events, hot, parts, lk)
