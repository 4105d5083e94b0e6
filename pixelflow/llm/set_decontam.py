"""Benchmark decontamination by a prefix-filtered set join, on DataFrame and
SQL functions only.

An item's windows are its runs of ``window`` words (an item of fewer words is
one window).  A window is the set of its word shingles (``shingle`` words; a
shorter window is one shingle), each with its offset.  A text that contains a
window contains all of its shingles, so a prefix of one shingle is necessary;
the global order is by rarity in the documents, so that one is the rarest.

1. The documents' shingles meet the windows' shingles; the matches, with their
   positions, are stored.  A bitmap of the benchmark's
   hashes, of at most MAP_BITS / 64 rows whatever the benchmark's size, is
   broadcast and drops most shingles ahead of that join.
2. Counts of the matches give the rarity; every window keeps its rarest shingle.
   A window with a shingle that never matched occurs nowhere.
3. A match of that shingle at its offset proposes where the window would start;
   positional and length bounds drop starts that leave the document or whose
   window could not end within it.
4. Verification: a window of ``window`` words is covered by its first and its
   last shingle, both of which must match at exactly their positions (so
   ``shingle`` must be at least half of ``window``).  Matches carry the
   shingles' words, so every comparison is of words; hashes only drop rows.

Nulls and edges: a null, empty or wordless text has no words, is hit by
nothing and contains nothing; a null or wordless item has no window; an item
with a null id hits words but is no named item (not in items); items with one
id count as one; repeated documents give repeated rows; a null doc_id is a
document like others; very long texts are read whole; empty tables give no
rows, or no hits; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pixelflow.llm.common import stored

#: What is between the words of lower-cased text, and of any text (words
#: are of letters, digits and what is not ASCII).  Splitting there is several times
#: faster than matching the words' negated class.
BETWEEN, BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MAP_BITS = 1 << 24        # bits of the bitmap of benchmark shingles (at most 262,144 rows are broadcast)


@dataclass(frozen=True)
class DecontamConfig:
    window: int = 10       # words of a window
    shingle: int = 5       # words of a shingle; 2 * shingle >= window

    def __post_init__(self):
        if not 0 < self.shingle <= self.window <= 2 * self.shingle:
            raise ValueError("a window must be covered by two shingles")


def words(text: Column) -> Column:
    """The words of a text (null: none), lower-cased in A-Z."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def _shingles(df: DataFrame, ws: str, width: int, keep: list[str]) -> DataFrame:
    """``keep``, pos (from 0) and the ``width`` words from there on, _w0, _w1, ...
    (null past the end): one row per word of the array ``ws``."""
    later = [F.slice(ws, k + 1, F.greatest(F.size(ws) - k, F.lit(0))) for k in range(width)]
    each = df.select(*keep, F.posexplode(F.arrays_zip(*[x.alias(f"_w{k}") for k, x in enumerate(later)])).alias("pos", "_z"))
    return each.select(*keep, "pos", *[F.col(f"_z._w{k}") for k in range(width)])


def _hash(width: int) -> Column:
    """Hash of the first ``width`` words (of a row that has them)."""
    return F.xxhash64(F.lit(width), *[F.col(f"_w{k}") for k in range(width)])


def _text(width: int) -> Column:
    return F.concat_ws(" ", *[F.col(f"_w{k}") for k in range(width)])


def windows(items: DataFrame, cfg: DecontamConfig) -> tuple[DataFrame, DataFrame]:
    """(windows, owners): win, n, off, h, sh (a shingle's hash and words) of
    every distinct window and offset; and (win, item_id) of the items with it."""
    ws = items.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("ws") - cfg.window + 1, F.lit(1))))
    each = ws.select("item_id", "ws", starts.alias("at")).select("item_id", F.slice("ws", F.col("at"), cfg.window).alias("ws"))
    each = each.withColumn("win", F.concat_ws(" ", "ws"))
    owners = each.select("win", "item_id").distinct()
    size = F.least(F.size("ws"), F.lit(cfg.shingle))
    one = each.select("win", "ws").distinct().withColumn("n", F.size("ws")).withColumn("width", size)
    off = F.explode(F.sequence(F.lit(0), F.col("n") - F.col("width")))
    one = one.select("win", "n", "width", off.alias("off"), "ws")
    parts = F.slice("ws", F.col("off") + 1, F.col("width"))
    one = one.select("win", "n", "width", "off", F.concat_ws(" ", parts).alias("sh"), *[
        F.get(parts, F.lit(k)).alias(f"_w{k}") for k in range(cfg.shingle)])
    of_width = F.coalesce(*[F.when(F.col("width") == k, _hash(k)) for k in range(1, cfg.shingle + 1)])
    return one.select("win", "n", "width", "off", "sh", of_width.alias("h")), owners


def matches(docs: DataFrame, wins: DataFrame, cfg: DecontamConfig) -> DataFrame:
    """Shingles that documents share with the benchmark: doc_id, key (digest
    of the text), size (words of the text), pos and sh, the shingle's words."""
    wanted = wins.select("h", "width", "sh").distinct()
    widths = sorted(r.width for r in wanted.select("width").distinct().collect())      # cfg.shingle numbers at most
    if not widths:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key string, size int, pos int, sh string")
    full = docs.select("doc_id", F.md5("text").alias("key"), words(F.col("text")).alias("ws"))
    each = _shingles(full.withColumn("size", F.size("ws")), "ws", max(widths), ["doc_id", "key", "size"])
    if len(widths) == 1:
        each = each.withColumn("width", F.lit(widths[0])).withColumn("h", _hash(widths[0]))
    else:
        both = F.explode(F.array(*[F.struct(F.lit(k).alias("width"), _hash(k).alias("h")) for k in widths]))
        each = each.withColumn("_s", both).withColumn("width", F.col("_s.width")).withColumn("h", F.col("_s.h"))
    # the bitmap drops most shingles before their words are put together
    spot = F.shiftright(F.pmod("h", F.lit(MAP_BITS)), 6)
    bit = F.expr("shiftleft(1L, cast(pmod(h, 64) as int))")
    bitmap = wanted.groupBy(spot.alias("_at")).agg(F.bit_or(bit).alias("_map"))
    near = each.withColumn("_at", spot).join(F.broadcast(bitmap), "_at").where(F.col("_map").bitwiseAND(bit) != 0)
    of_width = [F.when((F.col("width") == k) & F.col(f"_w{k - 1}").isNotNull(), _text(k)) for k in widths]
    near = near.select("doc_id", "key", "size", "pos", "h", F.coalesce(*of_width).alias("sh"))
    # an inner join: a semi join would be moved below the bitmap's join
    return near.join(wanted.select("h", "sh"), ["h", "sh"]).select("doc_id", "key", "size", "pos", "sh").distinct()


def occurrences(found: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, key, start, n, win): every place where a window stands."""
    df = found.groupBy("sh").agg(F.count(F.lit(1)).alias("df"))
    ranked = wins.join(df, "sh", "left")
    end = F.col("off") == F.col("n") - F.col("width")
    prefix = ranked.groupBy("win").agg(
        F.max("n").alias("n"), F.max(F.col("n") - F.col("width")).alias("last"), F.bool_and(F.col("df").isNotNull()).alias("all"),
        F.min(F.struct("df", "h", "off", "sh")).alias("p"), F.max(F.when(F.col("off") == 0, F.col("sh"))).alias("sh_first"),
        F.max(F.when(end, F.col("sh"))).alias("sh_last")).where("all")
    prefix = prefix.select("win", "n", "last", "sh_first", "sh_last", F.col("p.sh").alias("sh"), F.col("p.off").alias("off"))
    may = found.join(prefix, "sh").withColumn("start", F.col("pos") - F.col("off"))
    may = may.where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("size")))
    may = may.select("doc_id", "key", "start", "n", "last", "win", "sh_first", "sh_last")
    for at, sh in ((F.col("start"), "sh_first"), (F.col("start") + F.col("last"), "sh_last")):
        other = found.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("pos").alias("_p"), F.col("sh").alias("_s"))
        may = may.join(other, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")) & (at == F.col("_p"))
                       & (F.col(sh) == F.col("_s")), "left_semi")
    return may.select("doc_id", "key", "start", "n", "win")


def scan(docs: DataFrame, items: DataFrame, cfg: DecontamConfig = DecontamConfig()) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurring window),
    n_items, items (their ids as strings, sorted as strings), contaminated."""
    wins, owners = windows(items, cfg)
    wins = stored(wins, "decontam-windows")
    found = stored(matches(docs, wins, cfg), "decontam-matches")
    occ = stored(occurrences(found, wins), "decontam-occurrences")
    # a null key is no document's: texts with words only
    hit = occ.select("doc_id", "key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at")).distinct()
    hit = hit.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n_hit"))
    named = occ.select("doc_id", "key", "win").distinct().join(owners.where(F.col("item_id").isNotNull()), "win")
    named = named.select("doc_id", "key", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    tags = hit.join(named.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "items"),
                    F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left")
    tags = stored(tags.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "n_hit", "items"), "decontam-documents")
    n = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), BETWEEN_ANY_CASE), "")).cast("long")
    each = docs.select("doc_id", F.md5("text").alias("key"), n.alias("n_words"))
    out = each.join(tags, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
