"""Geo field ``state|country|dma...`` parsing."""

from pyspark.sql import Column, functions as F

from pixelflow.constants import CTR_NULL
from pixelflow.functions._util import col
from pixelflow.functions.markers import norm_marker


def geo_parts(c) -> Column:
    """Split on ``|`` after dropping trailing empty parts (as a tokenising split does)."""
    return F.split(F.regexp_replace(col(c), r"\|+\z", ""), r"\|")


def geo_state(c) -> Column:
    """Part 1 when there are at least 3 parts, else ``-``; markers -> ``-``."""
    p = geo_parts(c)
    return norm_marker(F.when(F.size(p) >= 3, p.getItem(0)))


def geo_dma(c) -> Column:
    """Part 3 under the same rule as :func:`geo_state`."""
    p = geo_parts(c)
    return norm_marker(F.when(F.size(p) >= 3, p.getItem(2)))


def ctr_state(c) -> Column:
    """CTR state: ``''`` when the field is absent; part 1 when there are at
    least 3 parts; empty or ``null`` -> ``null`` text."""
    c = col(c)
    p = geo_parts(c)
    s = F.when(F.size(p) >= 3, p.getItem(0)).otherwise(F.lit(""))
    s = F.when((s == "") | (F.lower(s) == CTR_NULL), F.lit(CTR_NULL)).otherwise(s)
    return F.when(c.isNull(), F.lit("")).otherwise(s)
