"""Hour extraction and the hour-group lookup."""

from itertools import chain

from pyspark.sql import Column, functions as F

from pixelflow.constants import (HOUR_GROUPS, MISSING, CTR_NULL, RE_HOUR,
                                 RE_CONV_HOUR)
from pixelflow.functions._util import col
from pixelflow.functions.dates import epoch_hour
from pixelflow.functions.markers import norm_marker


def _group_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(HOUR_GROUPS.items()))])


def hour_group(hh) -> Column:
    """Two-digit hour text -> hour group ``1``..``4``; NULL when not in the table
    (one-digit hours are not in it)."""
    return F.try_element_at(_group_map(), col(hh))


def hour_group_impressions(timestamp) -> Column:
    """Impression hour group from the epoch-ms ``timestamp`` field: hour of the
    formatted UTC time, unknown hour -> group ``1``."""
    # the first "HH:" of the formatted time is its hour, so take it arithmetically
    return F.coalesce(hour_group(epoch_hour(col(timestamp))), F.lit("1"))


def hour_group_conversions(payload) -> Column:
    """Conversion hour group from the payload ``"date"``; unknown -> ``-``."""
    hh = norm_marker(F.regexp_extract(col(payload), RE_CONV_HOUR, 1))
    return F.coalesce(hour_group(hh), F.lit(MISSING))


def hour_group_ctr(date) -> Column:
    """CTR hour group from the log ``date`` text: the group when the hour is in
    the table, else the raw hour, else ``null`` text (absent or no hour)."""
    # the captured hour is digits only, so it is never the text "null"
    hh = F.coalesce(F.nullif(F.regexp_extract(col(date), RE_HOUR, 1), F.lit("")), F.lit(CTR_NULL))
    return F.coalesce(hour_group(hh), hh)
