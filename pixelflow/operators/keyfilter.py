"""Row reduction ahead of a join whose lookup is too large to broadcast.

The keys of the lookup set one bit each in a table of at most
:data:`FILTER_WORDS` rows of 64 bits, whatever their number; a log row whose
bit is not set is dropped before it is shuffled.  A row may pass by chance (a
share of about keys / bits), and the join itself then drops it: results never
depend on the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pixelflow.sources.config import PixelLookups

FILTER_WORDS = 262_144      # 4 MB broadcast at most, 16.8 million bits


def _word_bit(key: Column, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(h, F.lit(64)).cast("int"))
    return F.shiftrightunsigned(h, 6) % words, bit


def key_filter(keys: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """``(_word, _bits)`` of the non-null keys, at most ``words`` rows."""
    word, bit = _word_bit(F.col(key), words)
    return keys.where(F.col(key).isNotNull()).select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def may_match(df: DataFrame, key: str, bits: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The rows of ``df`` whose key may be among those of ``bits``; null never is."""
    word, bit = _word_bit(F.col(key), words)
    hit = (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0)
    return df.where(F.col(key).isNotNull()).join(F.broadcast(bits), hit, "left_semi")


def reduced(df: DataFrame, key: str, lk: PixelLookups, of: str) -> DataFrame:
    """``df`` without rows whose ``key`` is surely not in ``lk``'s ``campaigns``
    or ``pixels``, for a map kept as a table; a map given as a string is small
    and its joins need no filter."""
    if not lk.is_table:
        return df
    column = {"campaigns": "campaign_id", "pixels": "pixel"}[of]
    return may_match(df, key, key_filter(lk.entries, column))
