"""Trie of conversation prefixes by collapsing whole sequences.

A conversation is a sequence of turns (role, text).  Identical ones become one
weighted sequence with the list of their ids.  A sequence that is a proper
prefix of another ends inside the trie: what is left after an anti-join with
all proper prefixes are the leaves.  Prefixes of the distinct sequences,
weighted, are then grouped into nodes, so copies are counted and never
repeated turn by turn.

A prefix is named by its depth and 128 bits: the sum of position-tagged hashes
of its turns.  Sums can be taken in segments, so no conversation passes through
one task whole: :func:`ranked` cuts the table by ranges of (conversation,
order) and carries counts over the cuts; later steps know the depth and take
segments of SEGMENT turns.

Subtree sums are linear, too.  Every node is owned by the smallest leaf below
it; the nodes that a leaf owns are the end of its sequence.  With T(s) the cost
that leaf s owns, a node's subtree costs the sum of T over the leaves below it,
less what its owner owns above it.

Nulls and edges: a null role or text is empty; null turns come first; equal
turns of a conversation are ordered by the digest of role and text; rows with
a null conv_id belong to no conversation and are left out; repeated rows are turns of
their own; very long texts count by their hash and length; an empty table has
no node, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pixelflow.llm.common import importable, release, stored

SEGMENT = 512             # turns of a segment
CHUNK = 1 << 16           # ids (by value) of a part of an end list
HEAD = 6                  # heads are of crc32 % HEAD turns
_SUMS = ["s0", "s1", "s2", "s3"]
_KEY = ["depth", "k1", "k2"]
_LOW = 0xFFFFFFFF


def ranked(turns: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``turns`` with ``rank``, each row's number (from 0) within ``keys`` by
    ``order``.  Rows are cut into ranges by (keys, order); a range counts its
    own rows, and the counts of earlier ranges are added."""
    cut = turns.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())
    cut = stored(cut, "trie-ranges")
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counts = cut.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where("_before > 0").drop("_n")
    at = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order)) - 1
    out = cut.withColumn("_at", at).join(counts, [*keys, "_range"], "left")
    return out.withColumn("rank", (F.col("_at") + F.coalesce("_before", F.lit(0))).cast("long")).drop("_at", "_before", "_range")


def running(df: DataFrame, key: str, depth: str, sums: dict[str, Column]) -> DataFrame:
    """``df`` with the sum of each of ``sums`` up to its row, by ``depth``
    within ``key``: within segments of SEGMENT depths, then carried over."""
    df = stored(df.withColumn("_seg", F.floor(F.col(depth) / SEGMENT)).withColumns({f"_x{c}": x for c, x in sums.items()}), "trie-sums")
    w = W.partitionBy(key, "_seg").orderBy(depth).rowsBetween(W.unboundedPreceding, 0)
    total = df.groupBy(key, "_seg").agg(*[F.sum(f"_x{c}").alias(f"_t{c}") for c in sums])
    before = W.partitionBy(key).orderBy("_seg").rowsBetween(W.unboundedPreceding, -1)
    carry = total.select(key, "_seg", *[F.sum(f"_t{c}").over(before).alias(f"_b{c}") for c in sums]).where(f"_b{next(iter(sums))} IS NOT NULL")
    each = df.withColumns({c: F.sum(f"_x{c}").over(w) for c in sums}).join(carry, [key, "_seg"], "left")
    return each.withColumns({c: F.col(c) + F.coalesce(f"_b{c}", F.lit(0)) for c in sums}).drop(
        "_seg", *[f"{p}{c}" for p in ("_x", "_b") for c in sums])


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes over: unsigned crc32 of its decimal id, modulo HEAD."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD).cast("long")


def narrow(conversations: DataFrame) -> DataFrame:
    """(c, turn, h1, h2, len): the halves of the digest of each turn's role and
    text, and the code points of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"), text.alias("text"))
    whole = F.md5(F.concat(F.length("role").cast("string"), F.lit(" "), "role", "text"))
    half = lambda a: F.conv(F.substring(whole, a, 16), 16, -10).cast("long")
    return t.select("c", "turn", half(1).alias("h1"), half(17).alias("h2"), F.length("text").cast("long").alias("len"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, convs): c, depth (from 1), h1, h2, len of every conversation
    whose first turns are those of its hundred's first conversation, and (c, n)
    of every conversation, n turns."""
    t = stored(ranked(narrow(conversations), ["c"], [F.asc_nulls_first("turn"), F.asc("h1"), F.asc("h2")]).drop("turn"), "trie-turns")
    convs = t.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.withColumn("base", F.col("c") - F.col("c") % 100).withColumn("take", head_turns(F.col("c")))
    sizes = convs.select(F.col("c").alias("base"), F.col("own").alias("_n"))
    convs = convs.join(sizes, "base", "left").withColumn("head", F.least("take", F.coalesce("_n", F.lit(0)))).drop("_n")
    convs = stored(convs, "trie-conversations")
    shared = t.where((F.col("c") % 100 == 0) & (F.col("rank") < HEAD)).withColumnRenamed("c", "base")
    heads = convs.select("c", "base", "take").join(shared, "base").where(F.col("rank") < F.col("take"))
    heads = heads.select("c", (F.col("rank") + 1).alias("depth"), "h1", "h2", "len")
    tails = t.where(F.col("rank") >= head_turns(F.col("c"))).join(convs.select("c", "take", "head"), "c")
    tails = tails.select("c", (F.col("rank") - F.col("take") + F.col("head") + 1).alias("depth"), "h1", "h2", "len")
    n = F.col("head") + F.greatest(F.col("own") - F.col("take"), F.lit(0))
    return heads.unionByName(tails), convs.select("c", n.alias("n"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the key (k1, k2) of the prefix that ends with each, and
    (p1, p2) of the prefix before it."""
    x, y = F.xxhash64("depth", "h1", "h2"), F.xxhash64("h2", "depth", "h1")
    lanes = [F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(y, 32), y.bitwiseAND(F.lit(_LOW))]
    lanes = dict(zip(_SUMS, lanes))
    out = running(turns, "c", "depth", lanes)
    pack = lambda a, b: F.shiftleft(a.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(b.bitwiseAND(F.lit(_LOW)))
    s = {c: F.col(c) for c in _SUMS}
    p = {c: F.col(c) - x for c, x in lanes.items()}
    return out.select("c", "depth", "len", pack(s["s0"], s["s1"]).alias("k1"), pack(s["s2"], s["s3"]).alias("k2"),
                      pack(p["s0"], p["s1"]).alias("p1"), pack(p["s2"], p["s3"]).alias("p2"))


def end_digests(members: DataFrame, keys: list[str]) -> DataFrame:
    """SHA-256 of the comma-joined decimal ids ``c`` (ascending) of each key:
    ids are joined in chunks of CHUNK values anywhere, and each key's chunks
    run through one hash in order, so a list is never held whole."""
    part = members.groupBy(*keys, F.floor(F.col("c") / CHUNK).alias("_chunk")).agg(F.array_sort(F.collect_list("c")).alias("l"))
    part = part.select(*keys, "_chunk", F.concat_ws(",", F.col("l").cast("array<string>")).alias("s"))
    part = part.repartition(*keys).sortWithinPartitions(*keys, "_chunk")

    def run(batches):
        now, h = None, None
        for b in batches:
            rows, out = zip(*[b.column(k).to_pylist() for k in keys]), []
            for key, s in zip(rows, b.column("s").to_pylist()):
                if key != now:
                    out += [(*now, h.hexdigest())] if now is not None else []
                    now, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(s.encode())
            yield batch(out)
        if now is not None:
            yield batch([(*now, h.hexdigest())])
        release()

    def batch(out):
        cols = [pa.array([r[k] for r in out], pa.int64()) for k in range(len(keys))]
        return pa.RecordBatch.from_arrays([*cols, pa.array([r[-1] for r in out], pa.string())], [*keys, "ends_sha256"])
    importable(members.sparkSession)
    return part.mapInArrow(run, ", ".join(f"{k} bigint" for k in keys) + ", ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256."""
    turns, convs = rebuilt(conversations)
    pre = stored(prefixes(turns), "trie-prefixes")
    # whole sequences: the prefix at a conversation's last turn, the root where it has none
    last = convs.join(pre.select("c", F.col("depth").alias("n"), "k1", "k2"), ["c", "n"], "left")
    last = stored(last.select("c", F.col("n").alias("depth"), F.coalesce("k1", F.lit(0)).alias("k1"), F.coalesce("k2", F.lit(0)).alias("k2")), "trie-ends")
    seqs = last.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("c").alias("c"))
    seqs = stored(seqs, "trie-sequences")
    # weighted prefixes of the distinct sequences, the root among them
    each = pre.join(seqs.select("c", "weight", F.col("depth").alias("n")), "c")
    root = [F.lit(0).cast("long").alias(k) for k in ("depth", "len", "k1", "k2", "p1", "p2")]
    each = stored(each.unionByName(seqs.select("c", *root, "weight", F.col("depth").alias("n"))), "trie-weighted")
    leaves = seqs.join(each.where("depth < n").select(*_KEY).distinct(), _KEY, "left_anti").select(F.col("c").alias("leaf"))
    leaves = stored(leaves, "trie-leaves")
    each = each.join(leaves, F.col("c") == F.col("leaf"), "left")
    nodes = stored(each.groupBy(*_KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("c").alias("conv_id"), F.count("leaf").alias("n_leaves"), F.min("leaf").alias("owner"),
        F.max("len").alias("len"), F.max("p1").alias("p1"), F.max("p2").alias("p2")), "trie-nodes")
    # what each leaf owns, and what it owns up to a node
    owned = nodes.select("owner", *_KEY, ((F.col("n_convs") - 1) * F.col("len")).alias("cost"))
    owned = stored(running(owned, "owner", "depth", {"upto": F.col("cost")}), "trie-owned")
    total = owned.groupBy("owner").agg(F.sum("cost").alias("total")).withColumnRenamed("owner", "leaf")
    below = each.where(F.col("leaf").isNotNull()).join(total, "leaf").groupBy(*_KEY).agg(F.sum("total").alias("below"))
    saved = below.join(owned.select(*_KEY, (F.col("upto") - F.col("cost")).alias("above")), _KEY).select(
        *_KEY, (F.col("below") - F.col("above")).alias("saved_tokens"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, ["depth", "p1", "p2"], "left").join(children, _KEY, "left").join(saved, _KEY)
    out = out.join(end_digests(last, _KEY), _KEY, "left")
    parent = F.when(F.col("depth") > 0, F.col("parent_conv_id"))
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
