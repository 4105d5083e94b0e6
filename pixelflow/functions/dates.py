"""Epoch-millisecond formatting and day arithmetic on ``yyyyMMdd`` text.

The epoch value is added to a TIMESTAMP_NTZ epoch, so the result is UTC
whatever the session time zone is.
"""

from pyspark.sql import Column, functions as F

from pixelflow.constants import DAY_FORMAT
from pixelflow.functions._util import col

# Epoch-ms range that renders with a 4-digit year: 0001-01-01 .. 9999-12-31.
_MIN_MS, _MAX_MS = -62_135_596_800_000, 253_402_300_799_999
_EPOCH_NTZ = "1970-01-01 00:00:00"


def _epoch(c) -> Column:
    """Epoch milliseconds of a plain (optionally signed) integer text, else NULL."""
    return F.regexp_extract(col(c), r"^([+-]?[0-9]+)\z", 1).try_cast("bigint")


def epoch_hour(c) -> Column:
    """Two-digit UTC hour of an epoch-ms text (the ``HH`` of
    :func:`format_epoch_ms`), ``''`` when that gives ``''``; plain arithmetic,
    no formatting."""
    ms = _epoch(c)
    hh = F.lpad((F.pmod(ms, F.lit(86_400_000)) / F.lit(3_600_000)).cast("int").cast("string"), 2, "0")
    return F.when(ms.between(_MIN_MS, _MAX_MS), hh).otherwise(F.lit(""))


def format_epoch_ms(c) -> Column:
    """Epoch milliseconds as text -> ``yyyyMMdd HH:mm:ss`` (UTC); anything that
    is not a plain (optionally signed) integer gives ``''``.

    Added to a TIMESTAMP_NTZ epoch, so no session time zone is involved."""
    ms = _epoch(c)
    ntz = F.timestamp_add("MILLISECOND", ms, F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
    return F.when(ms.between(_MIN_MS, _MAX_MS), F.date_format(ntz, "yyyyMMdd HH:mm:ss")).otherwise(F.lit(""))


def day_shift(c, n: int) -> Column:
    """``yyyyMMdd`` text shifted by ``n`` days; invalid input gives ``''``.
    A shift of 0 returns the input unchanged (not validated)."""
    c = col(c)
    if n == 0:
        return c
    d = F.try_to_timestamp(c, F.lit(DAY_FORMAT))
    strict = c.rlike(r"^[0-9]{8}$")
    shifted = F.date_format(F.date_add(F.to_date(d), n), DAY_FORMAT)
    return F.when(strict & d.isNotNull(), shifted).otherwise(F.lit(""))
