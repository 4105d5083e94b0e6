"""N-gram Jaccard self-join with rare-first prefix filtering.

A document's set is its distinct word shingles (64-bit hashes).  Documents
with equal sets become one node, so exact copies are never paired.  Two nodes
link when 100 * intersection >= percent * union.

Global order of the shingles: those whose hash falls into the lead class (one
in ``lead``) come first, the rest after them, and within either the rarer
ones first (document frequency, then hash).  A linked pair must share a
shingle among the first n - ceil(percent * n / 100) + 1 of each set.  Where a
node's lead shingles are enough for its prefix, only those (a fifth of its
set) are counted and joined; otherwise all of them are.  Any fixed order is
exact; the lead class only saves counting the other four fifths.

Filters on a shared prefix shingle at positions i and j, taken as the first
shared one: length; positional (all i + j before it differ); suffix (a
512-bit parity map of all shingles: each differing bit is a differing
shingle).  A pair they wrongly drop at a later shared shingle has passed at
its first.

No list of prefix holders is expanded into all its pairs.  First every holder
meets the pivot of its length band and of the next band; verified links give
components.  In lists that still hold several, what is outside the largest
meets the list's PIVOTS best pivots.  Then only what is left outside meets the
rest of its lists, across components.  So a group of near copies costs its size times
the pivots, not its square; what the pivots miss, the last step finds.

Nulls and edges: a null, empty or blank text has an empty set, is linked with
nothing and is its own component; a text with fewer words than a shingle is
one shingle; ids may repeat (a component's id is its smallest) or be null; an
empty table gives no rows; very long texts are hashed whole; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pixelflow.llm.common import map_batches, scratch, stored

PARITY_WORDS = 8          # 64-bit words of the parity map
PIVOTS = 8                # further pivots of a list and length band
MAP_BITS = 1 << 24        # bits of the bitmap of wanted sets (at most 262,144 rows are broadcast)


@dataclass(frozen=True)
class JoinConfig:
    words: int = 3         # words of a shingle
    percent: int = 90      # similarity threshold
    lead: int = 5          # one in so many shingles is of the lead class


#: Multipliers of the hashes (odd constants of splitmix64 and the golden ratio).
_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection on 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _G)


BLOCK_BYTES = 1 << 18     # texts hashed at once, in bytes (a longer text alone)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    up, down = np.full(size, _G), np.full(size, np.uint64(pow(int(_G), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(blob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word: the polynomial sum of its bytes' codes in
    powers of an odd base, taken from prefix sums and divided by the power at
    the word's start."""
    space = _SPACE[blob]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if len(blob) <= 2 * BLOCK_BYTES:
        powers, inverse = _powers(2 * BLOCK_BYTES + 1)
    else:
        powers, inverse = _powers.__wrapped__(len(blob) + 1)
    sums = np.zeros(len(blob) + 1, np.uint64)
    np.cumsum(_BYTE[blob] * powers[:len(blob)], out=sums[1:])
    return start, mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text."""
    out, some, size = [], [], 0
    for t in texts:
        some.append((t or "").encode("utf-8").lower())            # bytes: A-Z only
        size += len(some[-1])
        if size >= BLOCK_BYTES:
            out += _block_sets(some, words)
            some, size = [], 0
    return out + _block_sets(some, words) if some else out


def _block_sets(raw: list[bytes], words: int) -> list[np.ndarray]:
    blob = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    start, h = word_hashes(blob)
    ends = np.cumsum([len(r) + 1 for r in raw])
    cut = np.concatenate([[0], np.searchsorted(start, ends)])
    n = len(h)
    rolled = np.full(max(n - words + 1, 0), np.uint64(words), np.uint64)
    for k in range(words):
        rolled = mix(rolled * _G + h[k:n - words + 1 + k])
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = mix(np.array([one], np.uint64) * _G + x)[0]
            out.append(np.array([one], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def keys_of(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit key of a set."""
    a, b = mix(s + _G), mix(s * _M1 + _M2)
    return int(a.sum(dtype=np.uint64).view(np.int64)), int((b.sum(dtype=np.uint64) ^ np.uint64(len(s))).view(np.int64))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _profiles(docs: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Per document: doc_id, k1, k2 (set key), n, n_lead, cand (the shingles
    that may be in the prefix), the parity map of all, and tk (a hash of the text)."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column("text").to_pylist(), cfg.words)
        keys, n, lead, cand, par = [], [], [], [], []
        for s in sets:
            is_lead = s % np.uint64(cfg.lead) == 0
            keys.append(keys_of(s))
            n.append(len(s))
            lead.append(int(is_lead.sum()))
            cand.append((s[is_lead] if lead[-1] >= prefix_size(len(s), cfg.percent) else s).view(np.int64))
            bits = np.bincount((s >> np.uint64(40)) % np.uint64(64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
            par.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in cand])]).astype(np.int32)
        values = np.concatenate(cand) if cand else np.zeros(0, np.int64)
        par = np.array(par, np.int64).reshape(len(sets), PARITY_WORDS)
        cols = [b.column("doc_id"), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                pa.array(n, pa.int64()), pa.array(lead, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64())),
                *[pa.array(par[:, k]) for k in range(PARITY_WORDS)], b.column("tk")]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "k1", "k2", "n", "n_lead", "cand", *_PARITY, "tk"])
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, k1 bigint, k2 bigint, n bigint, n_lead bigint, cand array<bigint>, "
    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("tk")), batch,
                       ddl + ", ".join(f"{p} bigint" for p in [*_PARITY, "tk"]), rows=512)


_PARITY = [f"s{k}" for k in range(PARITY_WORDS)]


def _keyed(docs: DataFrame, cfg: JoinConfig, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and each document's set key and size (_k1, _k2, _n)."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    names = [f.name for f in fields]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column("text").to_pylist(), cfg.words)
        keys = [keys_of(s) for s in sets]
        return pa.RecordBatch.from_arrays(
            [*map(b.column, names), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([len(s) for s in sets], pa.int64())], [*names, "_k1", "_k2", "_n"])
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return map_batches(docs.select(*dict.fromkeys([*names, "text"])), batch, ddl + "_k1 bigint, _k2 bigint, _n bigint", rows=512)


def _sets(texts: DataFrame, cfg: JoinConfig) -> DataFrame:
    """(k1, k2, set) of each text."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column("text").to_pylist(), cfg.words)
        keys = [keys_of(s) for s in sets]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))], ["k1", "k2", "set"])
    return map_batches(texts.select("text"), batch, "k1 bigint, k2 bigint, set array<bigint>", rows=512)


def postings(nodes: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Prefix entries shared by two nodes at least: h, node, n, pos, band and
    the parity map."""
    each = nodes.select("node", F.explode("cand").alias("h"))
    df = each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = each.join(stored(df, "join-df"), "h")
    unsigned = F.pmod(F.pmod("h", F.lit(cfg.lead)) + F.when(F.col("h") < 0, F.lit((1 << 64) % cfg.lead)).otherwise(F.lit(0)), F.lit(cfg.lead))
    lead = unsigned == 0
    per = shared.groupBy("node").agg(F.array_sort(F.collect_list(F.struct((~lead).alias("tail"), "df", "h"))).alias("c"))
    full = per.join(nodes.drop("cand"), "node")
    n_lead = F.size(F.filter("c", lambda x: ~x["tail"]))
    at = F.posexplode(F.col("c"))
    e = full.withColumn("_nl", n_lead).withColumn("_nt", F.size("c") - F.col("_nl"))
    e = e.select("node", "n", "n_lead", "_nl", "_nt", *_PARITY, at.alias("_r", "_x"))
    pos = F.when(F.col("_x.tail"), F.col("n") - F.col("_nt") + F.col("_r") - F.col("_nl")).otherwise(
        F.col("n_lead") - F.col("_nl") + F.col("_r"))
    size = F.col("n") - F.ceil(F.col("n") * cfg.percent / 100) + 1
    # linked sizes differ by less than one band
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.1 / cfg.percent)))
    return (e.withColumn("pos", pos).where(F.col("pos") < size)
            .select(F.col("_x.h").alias("h"), "node", "n", "pos",
                    band.cast("int").alias("band"), *_PARITY))


def passes(a: str, b: str, cfg: JoinConfig) -> Column:
    """Length, positional and suffix filter of two entries of one list."""
    col = lambda side, c: F.col(f"{side}.{c}")
    na, nb = col(a, "n"), col(b, "n")
    need = F.ceil((na + nb) * cfg.percent / (100 + cfg.percent) - 1e-9)
    most = na + nb - 2 * need                     # differing shingles a linked pair can have
    before = col(a, "pos") + col(b, "pos")
    parity = reduce(lambda x, y: x + y, [F.bit_count(col(a, p).bitwiseXOR(col(b, p))) for p in _PARITY])
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * cfg.percent) & (F.greatest(before, parity) <= most)


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")).distinct()


def pivot_pairs(post: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Every entry with the pivot of its band and of the next band of its list:
    the entry with the fewest rarer shingles, so likely the nearest to all."""
    rest = [c for c in post.columns if c not in ("h", "band", "pos", "node")]
    pivot = post.groupBy("h", "band").agg(F.min(F.struct("pos", "node", *rest)).alias("p")).select("h", "band", "p.*")
    near = post.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    met = near.alias("a").join(pivot.alias("b"), ["h", "band"])
    return _pairs(met.where((F.col("a.node") != F.col("b.node")) & passes("a", "b", cfg)))


def open_lists(post: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries, with their component ``label``, of lists that hold more
    than one, and each list's largest component ``main`` and ``size``."""
    full = post.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    count = full.groupBy("h", "label").agg(F.count(F.lit(1)).alias("c"))
    top = count.groupBy("h").agg(F.max(F.struct("c", "label")).alias("t"), F.count(F.lit(1)).alias("k"), F.sum("c").alias("size")).where("k > 1")
    return stored(full.join(top.select("h", F.col("t.label").alias("main"), "size"), "h"), "join-open")


def next_pivots(opened: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Pairs of each entry outside its list's largest component with PIVOTS
    entries of each length band near its own: those with the fewest rarer
    shingles."""
    side = opened.where("label <> main").withColumn("band", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)))
    r = F.row_number().over(W.partitionBy("h", "band").orderBy("pos", "node"))
    pivots = opened.withColumn("_r", r).where(F.col("_r") <= PIVOTS).drop("_r")
    met = side.alias("a").join(pivots.alias("b"), ["h", "band"])
    return _pairs(met.where((F.col("a.label") != F.col("b.label")) & passes("a", "b", cfg)))


def cross_pairs(opened: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Pairs across components: the entries outside a list's largest component
    meet all others of their band and the bands beside it."""
    side = opened.where("label <> main").withColumn("band", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)))
    met = side.alias("a").join(opened.alias("b"), ["h", "band"])
    # two entries outside the main component meet twice: keep one direction
    once = (F.col("b.label") == F.col("b.main")) | (F.col("a.node") < F.col("b.node"))
    return _pairs(met.where((F.col("a.label") != F.col("b.label")) & once & passes("a", "b", cfg)))


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, cfg: JoinConfig) -> DataFrame:
    """The pairs (x, y) that link, by the exact sets of both sides (stored)."""
    with scratch(docs.sparkSession) as keep:
        return keep(_verified(pairs, nodes, docs, cfg), "join-links")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, cfg: JoinConfig) -> DataFrame:
    wanted = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).distinct()
    ids = stored(nodes.select("node", "k1", "k2", "tk").join(wanted, "node", "left_semi"), "join-wanted")
    # a bitmap of the wanted texts' hashes, of at most MAP_BITS / 64 rows whatever
    # the corpus, drops most other texts before they are hashed anew
    spot = F.shiftright(F.pmod("tk", F.lit(MAP_BITS)), 6)
    bit = F.expr("shiftleft(1L, cast(pmod(tk, 64) as int))")
    bitmap = ids.groupBy(spot.alias("_at")).agg(F.bit_or(bit).alias("_map"))
    texts = docs.select("text", F.xxhash64("text").alias("tk")).withColumn("_at", spot).join(F.broadcast(bitmap), "_at")
    sets = _sets(texts.where(F.col("_map").bitwiseAND(bit) != 0), cfg)
    sets = sets.join(ids, ["k1", "k2"]).groupBy("node").agg(F.first("set").alias("set"))
    sets = stored(sets, "join-sets")
    two = pairs.join(sets.select(F.col("node").alias("x"), F.col("set").alias("sx")), "x")
    two = two.join(sets.select(F.col("node").alias("y"), F.col("set").alias("sy")), "y")
    both = F.size(F.array_intersect("sx", "sy"))
    return two.where(both * 100 >= (F.size("sx") + F.size("sy") - both) * cfg.percent).select("x", "y")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge: label is the component's
    smallest node.  Alternating large-star and small-star steps until nothing
    changes; each round is written to the shared folder."""
    spark = edges.sparkSession
    with scratch(spark) as keep_labels:
        cur = stored(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct(), "cc")
        state = None
        while True:
            now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
            if now == state or not now[0]:
                return keep_labels(cur.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                    cur.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct(), "join-components")
            state = now
            both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            met = large.join(least, "u")
            small = met.select("u", F.col("m").alias("v")).unionByName(met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            cur = stored(small.where("u <> v").distinct(), "cc")


def links(docs: DataFrame, cfg: JoinConfig = JoinConfig()) -> tuple[DataFrame, DataFrame]:
    """(profiles, nodes): doc_id, n, k1, k2 of every document, and of every
    distinct set k1, k2, its smallest doc_id ``low`` and component ``label``."""
    prof = stored(_profiles(docs, cfg).withColumn("row", F.monotonically_increasing_id()), "join-profiles")
    with scratch(docs.sparkSession) as keep:
        full = prof.where("n > 0")
        # a node is named by its first row; its other columns follow from the set
        nodes = stored(full.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min("doc_id").alias("low"), F.min_by("tk", "row").alias("tk")), "join-nodes")
        reps = full.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node").drop("doc_id", "tk")
        post = stored(postings(reps, cfg), "join-postings")
        first = stored(pivot_pairs(post, cfg), "join-pairs")
        linked = verify(first, nodes, docs, cfg)
        with scratch(docs.sparkSession) as keep_pairs:
            near = next_pivots(open_lists(post, components(linked)), cfg)
            second = keep_pairs(near.join(first, ["x", "y"], "left_anti"), "join-pairs")
        linked = linked.unionByName(verify(second, nodes, docs, cfg))
        with scratch(docs.sparkSession) as keep_pairs:
            rest = cross_pairs(open_lists(post, components(linked)), cfg)
            third = keep_pairs(rest.join(first.unionByName(second), ["x", "y"], "left_anti"), "join-pairs")
        labels = components(linked.unionByName(verify(third, nodes, docs, cfg)))
        nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        return prof.select("doc_id", "n", "k1", "k2"), keep(nodes, "join-labels")


def cluster(docs: DataFrame, cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable)."""
    prof, nodes = links(docs, cfg)
    low = stored(nodes.groupBy("label").agg(F.min("low").alias("component_id")), "join-low")
    of = nodes.join(low, "label").select("k1", "k2", "component_id")
    d = prof.join(of, ["k1", "k2"], "left")
    return d.select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def deduplicate(docs: DataFrame, cfg: JoinConfig = JoinConfig(), columns: tuple[str, ...] = ("doc_id", "text", "lang", "source", "n_chars")) -> DataFrame:
    """One document of each component stays: the smallest id (null last), then
    the smaller set key; of rows equal in both, the smallest by ``columns``.
    Documents with an empty set are linked with nothing and all stay."""
    prof, nodes = links(docs, cfg)
    first = F.min(F.struct(F.col("low").isNull().alias("last"), F.col("low").alias("doc_id"), "k1", "k2")).alias("f")
    best = stored(nodes.groupBy("label").agg(first), "join-best")
    of = nodes.join(best, "label").select("k1", "k2", "f")
    rows = prof.where("n > 0").groupBy("doc_id", "k1", "k2").agg(F.count(F.lit(1)).alias("m"))
    rows = stored(rows.join(of, ["k1", "k2"]).withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("k1") == F.col("f.k1")) & (F.col("k2") == F.col("f.k2")))
        .select(F.col("doc_id").alias("_id"), F.col("k1").alias("_x1"), F.col("k2").alias("_x2"), "m", "stays"), "join-stays")
    keyed = _keyed(docs, cfg, columns)
    same = (F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k1") == F.col("_x1")) & (F.col("_k2") == F.col("_x2")))
    once = keyed.join(rows.where(~F.col("stays") | (F.col("m") > 1)), same, "left_anti")
    # keepers that stand in several rows: the smallest of them
    again = keyed.join(rows.where(F.col("stays") & (F.col("m") > 1)), same, "left_semi")
    again = again.groupBy("doc_id", "_k1", "_k2").agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*")
    return once.select(*columns).unionByName(again)
