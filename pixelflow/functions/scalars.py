"""Small scalar helpers: click flag, viewability, ratios, slice join."""

from pyspark.sql import Column, functions as F

from pixelflow.constants import (NO_DETECTION, RATE_PRIOR_CONV, RATE_PRIOR_IMP,
                                 RATE_DECIMALS)
from pixelflow.functions._util import col


def click_flag(c) -> Column:
    """Exactly ``1`` -> 1, anything else (or absent) -> 0."""
    return F.when(col(c) == "1", F.lit(1)).otherwise(F.lit(0))


def viewability(c) -> Column:
    """Absent or empty -> ``NO_DETECTION``."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(NO_DETECTION))


def ctr_ratio(clk, imp) -> Column:
    """Clicks / impressions as DOUBLE (-1 when there are no impressions)."""
    return F.when(col(imp) > 0, col(clk).cast("double") / col(imp).cast("double")).otherwise(F.lit(-1.0))


def smoothed_rate(conv, imp) -> Column:
    """``(conv + 1) / (imp + 1000)`` rounded to 8 decimals."""
    return F.round((col(conv) + F.lit(RATE_PRIOR_CONV)) / (col(imp) + F.lit(RATE_PRIOR_IMP)),
                   RATE_DECIMALS)


def join_slice(arr, start: int, end: int, sep: str = "\t") -> Column:
    """Elements ``start..end`` (0-based, inclusive) joined with ``sep``."""
    return F.concat_ws(sep, F.slice(col(arr), start + 1, end - start + 1))
