"""Mixing sources to target weights by Sainte-Lague apportionment.

The target tokens of the sources are turned into integer numbers of
equal-token blocks by highest quotients (votes / (2 seats + 1)), first over
the sources and then, per source, over its shards.  In a shard the documents
lie in a seeded order and form a circular token stream of blocks; the quota
is taken from a seeded start block, in whole turns first.  What a small shard
cannot take of its quota goes to the source's other shards, those with fewer
turns first; a source of less than half a block takes its rounded target.

DataFrame functions only.  The documents are scanned once into a narrow
table (id, size, source, shard, order key); everything global is a table of
(source, shard) totals of at most sources x ``max_shards`` rows.

Nulls and edges: a null text counts 0 words and is taken 0 times; a null
source is a source of its own, ordered last; null or repeated ids are fine
(identical rows are interchangeable); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pixelflow.llm.common import n_words, stored


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[int, ...] = (5, 2, 1)   # repeating over the sources in code point order, null last
    max_repeat: int = 3                    # a target stops at this many times its source's size
    block_tokens: int = 64                 # tokens of a block
    shard_tokens: int = 65536              # aimed tokens of a shard over all sources
    max_shards: int = 8192                 # more data then gives larger shards
    seed: str = "mix-1"


def source_key(source: Column) -> Column:
    """A non-null key: ``+name``, or ``-`` for null."""
    return F.coalesce(F.concat(F.lit("+"), source), F.lit("-"))


def _hex_int(text: Column, start: int, width: int = 8) -> Column:
    return F.conv(F.substring(text, start, width), 16, 10).cast("long")


def sized(docs: DataFrame, cfg: MixConfig, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, size, _src (source key) and _key (seeded order key) per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    key = F.md5(F.concat_ws("|", F.lit(cfg.seed), doc, F.md5(text)))
    return docs.select(*[F.col(k) for k in keep], n_words(F.col("text")).alias("size"),
                       source_key(F.col("source")).alias("_src"), key.alias("_key"))


def targets(sizes: DataFrame, cfg: MixConfig) -> DataFrame:
    """(_src, source_size) -> (_src, source_size, target): weights by code
    point order of the source; targets stop at ``max_repeat`` times the size
    and the excess is reshared by weight.  The fixed point of the resharing is
    target = min(cap, level * weight) with one common level, found by cumulative
    sums over the sources ordered by cap / weight (one row per source)."""
    order = W.orderBy(F.col("_src").eqNullSafe("-"), "_src")
    weights = F.array(*[F.lit(w) for w in cfg.weights])
    pos = (F.row_number().over(order) - 1) % len(cfg.weights)
    t = sizes.withColumn("_w", F.get(weights, pos))
    t = t.withColumn("_cap", F.lit(cfg.max_repeat) * F.col("source_size"))
    up = W.orderBy(F.col("_cap") / F.col("_w"), "_src")
    before = up.rowsBetween(W.unboundedPreceding, -1)
    after = up.rowsBetween(W.currentRow, W.unboundedFollowing)
    t = t.withColumn("_level", (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
                     / F.sum("_w").over(after))
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), "_src", "_level"))
    t = t.withColumn("_lv", F.min(fits).over(W.partitionBy())["_level"])
    return t.select("_src", "source_size",
                    F.least(F.col("_cap").cast("double"), F.col("_lv") * F.col("_w")).alias("target"))


def sainte_lague(items: DataFrame, group: list[str], item: str, votes: str, seats: str, out: str) -> DataFrame:
    """Seats by highest quotients votes / (2k + 1), ``seats`` per ``group``.

    Rounding votes / (total / seats) gives each item its seats up to a
    difference of at most half the number of items; the difference is then
    settled by the highest quotients not yet seated (or the lowest seated).
    An item of share p can gain or lose at most 1.5 * m * p + 1 of them
    (m items), so about 5 m quotients decide, whatever the number of seats.
    Of equal quotients the
    smaller item's is settled first.  Items without votes get nothing."""
    g = W.partitionBy(*group)
    t = items.withColumn("_total", F.sum(votes).over(g)).withColumn("_m", F.count(F.lit(1)).over(g))
    share = F.when(F.col("_total") > 0, F.col(votes) / F.col("_total")).otherwise(F.lit(0.0))
    t = t.withColumn("_share", share)
    t = t.withColumn("_s0", F.floor(F.col("_share") * F.col(seats) + F.lit(0.5)))
    t = t.withColumn("_diff", F.col(seats) - F.sum("_s0").over(g))
    reach = F.ceil(F.lit(1.5) * F.col("_m") * F.col("_share")).cast("int") + 1
    more = F.col("_diff") > 0
    steps = F.when((F.col("_diff") == 0) | (F.col(votes) <= 0), F.expr("array(cast(null as int))")).otherwise(
        F.sequence(F.lit(0), F.least(reach, F.abs("_diff").cast("int"))))
    q = t.withColumn("_j", F.explode(steps))
    quotient = F.when(more, F.col(votes) / (2 * (F.col("_s0") + F.col("_j")) + 1)).when(
        F.col("_s0") - F.col("_j") >= 1, F.col(votes) / (2 * (F.col("_s0") - F.col("_j")) - 1))
    q = q.withColumn("_q", quotient)
    best = F.when(more, -F.col("_q")).otherwise(F.col("_q"))
    q = q.withColumn("_pos", F.row_number().over(
        W.partitionBy(*group).orderBy(F.col("_q").isNull(), best, item)))
    won = F.col("_q").isNotNull() & (F.col("_pos") <= F.abs("_diff"))
    keys = [*group, item]
    extra = q.groupBy(*keys).agg(F.sum(F.when(won, F.lit(1)).otherwise(F.lit(0))).alias("_x"),
                                 F.first("_s0").alias("_s0"), F.first("_diff").alias("_diff"))
    seats_of = F.col("_s0") + F.when(F.col("_diff") > 0, F.col("_x")).otherwise(-F.col("_x"))
    return extra.select(*keys, seats_of.cast("long").alias(out))


def hand_on(per: DataFrame, cfg: MixConfig) -> DataFrame:
    """``_take``: the quota in tokens, never above max_repeat turns of the
    shard's stream; what is cut off fills the first turn of the source's shards
    in shard order, then the second, and so on (one row per source and shard)."""
    g = W.partitionBy("_src")
    before = g.orderBy("_shard").rowsBetween(W.unboundedPreceding, -1)
    goal = F.when(F.col("_blocks") > 0, F.col("_blocks") * cfg.block_tokens).otherwise(F.round("target").cast("long"))
    t = per.withColumn("_cut", F.least(F.col("_quota") * cfg.block_tokens, F.col("_t") * cfg.max_repeat))
    t = t.withColumn("_left", goal - F.sum("_cut").over(g))
    take, lower = F.col("_cut"), F.lit(0)
    for turn in range(1, cfg.max_repeat + 1):
        room = F.greatest(F.col("_t") * turn - F.greatest(F.col("_cut"), F.col("_t") * (turn - 1)), F.lit(0))
        open_ = F.col("_left") - lower - F.coalesce(F.sum(room).over(before), F.lit(0))
        take = take + F.greatest(F.least(room, open_), F.lit(0))
        lower = lower + F.sum(room).over(g)
    return t.withColumn("_take", take)


def mix(docs: DataFrame, cfg: MixConfig = MixConfig(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` (the id first), size, source_size, target, taken (words the mix
    takes, repeats counted) and ``from_word`` / ``part_words`` (the range of words taken
    beyond whole repeats, from word ``from_word`` on, around the end of the
    text if it is longer than what is left) per row of ``docs``."""
    narrow = stored(sized(docs, cfg, keep[:1]), "mix-sized")
    wide = narrow if len(keep) == 1 else sized(docs, cfg, keep)       # texts are not written a second time
    total = narrow.agg(F.sum("size")).first()[0] or 0
    n_shards = max(1, min(cfg.max_shards, -(-total // cfg.shard_tokens)))
    shard = (_hex_int(F.col("_key"), 1) % n_shards).alias("_shard")

    shards = narrow.select("_src", shard, "size").groupBy("_src", "_shard").agg(F.sum("size").alias("_t"))
    shards = stored(shards, "mix-shards")
    tgt = targets(shards.groupBy("_src").agg(F.sum("_t").alias("source_size")), cfg)
    tgt = tgt.withColumn("_all", F.lit(1)).withColumn(
        "_n", F.round(F.sum("target").over(W.partitionBy()) / cfg.block_tokens).cast("long"))
    tgt = stored(tgt, "mix-targets")
    blocks = sainte_lague(tgt, ["_all"], "_src", "target", "_n", "_blocks")
    per = shards.join(blocks.select("_src", "_blocks"), "_src")
    per = sainte_lague(per, ["_src"], "_shard", "_t", "_blocks", "_quota").join(shards, ["_src", "_shard"])
    per = per.join(tgt.join(blocks, "_src").select("_src", "source_size", "target", "_blocks"), "_src")
    per = hand_on(per, cfg)
    t1 = F.greatest(F.col("_t"), F.lit(1))
    per = per.withColumn("_turns", F.floor(F.col("_take") / t1)).withColumn("_rest", F.col("_take") - F.col("_turns") * F.col("_t"))
    start = _hex_int(F.md5(F.concat_ws("|", F.lit(cfg.seed), "_src", F.col("_shard").cast("string"))), 1)
    per = per.withColumn("_from", (start % F.ceil(t1 / cfg.block_tokens)) * cfg.block_tokens)
    per = per.select("_src", "_shard", "source_size", "target", "_t", "_turns", "_rest", "_from")

    run = (W.partitionBy("_src", "_shard").orderBy("_key", *keep[:1], "size")
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    d = wide.select("*", shard).withColumn("_hi", F.sum("size").over(run)).withColumn("_lo", F.col("_hi") - F.col("size"))
    d = d.join(per, ["_src", "_shard"])
    end = F.col("_from") + F.col("_rest")

    def overlap(lo: Column, hi: Column) -> Column:
        return F.greatest(F.least(F.col("_hi"), hi) - F.greatest(F.col("_lo"), lo), F.lit(0))
    first = overlap(F.col("_from"), F.least(end, F.col("_t")))
    wrapped = overlap(F.lit(0), end - F.col("_t"))
    part = first + wrapped
    taken = F.col("_turns") * F.col("size") + part
    begin = F.when(first > 0, F.greatest(F.col("_from"), F.col("_lo")) - F.col("_lo")).otherwise(F.lit(0))
    return d.select(*[F.col(k) for k in keep], "size", "source_size", "target", taken.cast("long").alias("taken"),
                    begin.cast("long").alias("from_word"), part.cast("long").alias("part_words"))


PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def materialise(docs: DataFrame, cfg: MixConfig = MixConfig(), columns: tuple[str, ...] = ("doc_id", "text", "lang", "source", "n_chars")) -> DataFrame:
    """The mixed corpus: one row per whole repeat of a document, and one row
    with the words of its partial take (white space between words kept);
    ``n_chars`` follows the text.  Documents that are not taken go."""
    m = mix(docs.select(*columns), cfg, columns)
    pieces = F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))
    n = F.col("size").cast("int")
    begin, part = F.col("from_word").cast("int"), F.col("part_words").cast("int")
    straight = F.least(part, n - begin)
    # a take that runs over the end goes on at the start, on a new line
    over = F.concat(F.array_join(F.slice(pieces, begin + 1, straight), ""), F.lit("\n"), F.array_join(F.slice(pieces, F.lit(1), part - straight), ""))
    some = F.regexp_replace(F.when(part > straight, over).otherwise(F.array_join(F.slice(pieces, begin + 1, part), "")), r"^[\x20\x09-\x0D]+", "")
    whole = F.array_repeat(F.col("text"), ((F.col("taken") - F.col("part_words")) / F.greatest("size", F.lit(1))).cast("int"))
    texts = F.when(part > 0, F.concat(whole, F.array(some))).otherwise(whole)
    out = m.where("taken > 0").withColumn("text", F.explode(texts))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*columns) if "n_chars" in columns else out.select(*columns)
