"""Nearest neighbours by largest inner product on shifted Hilbert curves.

Each distinct vector is projected (seeded orthonormal projections), shifted
and given its key on several Hilbert curves.  Spark range-partitions the
(curve, key) pairs; their ranks cut every curve into blocks of equal size, so
a crowd of equal keys is split like any other.  A query meets its own block
and the two beside it on every curve; the windows are merged and reranked by
the exact inner product in double precision.

An exact check follows on the first curve's blocks: the k-th score of a query
so far against the largest score a block can hold (its centre and radius).
Blocks that could still beat it are searched too, as blocks of queries
against blocks of rows.  On data with structure few are left; on directions
without any, all are, and the work of the check grows with queries x rows.

Equal vectors are one indexed vector carrying its smallest row ids, as many as
a result can hold.  The coordinate scale is fitted on at most ``fit_rows``
vectors chosen by hash; every vector is indexed.

Nulls and edges: null, empty or zero vectors, vectors holding null or
non-finite components, rows without an id and vectors whose length is not the
most common one take no part; a repeated row is a candidate for its copy;
with fewer than k other rows all are returned; no queries or an empty table
give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from pixelflow.llm.common import importable, stored


@dataclass(frozen=True)
class CurveConfig:
    k: int = 20
    every: int = 20          # a row whose id is divisible by it is a query
    curves: int = 4
    dims: int = 6            # projected dimensions of a curve
    bits: int = 10           # bits per dimension of a key
    block: int = 2048        # rows of a block
    fit_rows: int = 4096
    seed: int = 11


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (n, dims): axes to transposed index
    (inverse undo, then Gray encoding), bits interleaved."""
    x = x.astype(np.int64).T.copy()
    dims, q = len(x), 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """The projections, shifts and scales of the curves."""

    def __init__(self, sample: np.ndarray, cfg: CurveConfig):
        rng = np.random.default_rng(cfg.seed)
        d = sample.shape[1]
        self.cfg, self.maps = cfg, []
        for _ in range(cfg.curves):
            m = np.linalg.qr(rng.normal(size=(d, min(cfg.dims, d))))[0]
            p = sample @ m
            scale = np.maximum(p.std(axis=0), 1e-12)
            self.maps.append((m, p.mean(axis=0), scale, rng.uniform(0, 0.5, m.shape[1])))

    def keys(self, v: np.ndarray) -> list[np.ndarray]:
        out, top = [], 1 << self.cfg.bits
        for m, mean, scale, shift in self.maps:
            unit = np.clip((v @ m - mean) / (8 * scale) + 0.5, 0, 1)       # four deviations each way
            cell = np.minimum((unit + shift) / 1.5 * top, top - 1)
            out.append(hilbert_keys(cell.astype(np.int64), self.cfg.bits))
        return out


def matrix(column) -> np.ndarray:
    """The double-precision rows of a column of equally long arrays."""
    return np.array(list(column), np.float64).reshape(len(column), -1)


def usable(rows: DataFrame) -> DataFrame:
    v = F.col("embedding")
    ok = v.isNotNull() & (F.size(v) > 0) & F.col("vec_id").isNotNull()
    ok &= ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(ok)
    size = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (size.d if size else 0))


def best(scored: DataFrame, cfg: CurveConfig) -> DataFrame:
    """The k + 1 best indexed vectors of each query vector (one may be the
    query itself): score, then the smaller first id."""
    w = W.partitionBy("q").orderBy(F.desc("score"), "low", "node")
    return scored.dropDuplicates(["q", "node"]).withColumn("r", F.row_number().over(w)).where(F.col("r") <= cfg.k + 1)


HITS = "q bigint, node bigint, low bigint, score double"


def hits(qs: np.ndarray, qv: np.ndarray, nodes: np.ndarray, lows: np.ndarray, v: np.ndarray, k: int,
         floor: np.ndarray | None = None) -> pd.DataFrame:
    """The k best rows of ``v`` for each query vector, above its floor."""
    out = []
    for at in range(0, len(qs), 256):
        s = qv[at:at + 256] @ v.T
        for i, row in enumerate(s):
            cut = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
            if floor is not None:
                cut = max(cut, floor[at + i])
            pick = np.flatnonzero(row >= cut)
            if len(pick) > k:
                pick = pick[np.lexsort((lows[pick], -row[pick]))[:k]]
            out.append(pd.DataFrame({"q": qs[at + i], "node": nodes[pick], "low": lows[pick], "score": row[pick]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: [] for c in ("q", "node", "low", "score")})


def search(rows: DataFrame, cfg: CurveConfig = CurveConfig()) -> DataFrame:
    """query_id, rank, vec_id, score."""
    importable(rows.sparkSession)
    rows = stored(usable(rows), "ann-rows")
    # the smallest ids of each distinct vector (Spark limits the groups before the shuffle)
    w = W.partitionBy("embedding").orderBy("vec_id")
    ids = rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= cfg.k + 1)
    ids = ids.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    is_query = rows.where(F.col("vec_id") % cfg.every == 0)
    ids = ids.join(is_query.select("embedding").distinct().withColumn("asks", F.lit(True)), "embedding", "left")
    vectors = stored(ids.select(F.monotonically_increasing_id().alias("node"), "embedding", "ids", F.col("ids")[0].alias("low"),
                                F.coalesce("asks", F.lit(False)).alias("asks")), "ann-vectors")
    n = vectors.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = vectors.orderBy(F.xxhash64("embedding"), "low").limit(cfg.fit_rows).select("embedding").collect()
    curves = rows.sparkSession.sparkContext.broadcast(Curves(matrix([r[0] for r in sample]), cfg))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                nodes = b.column("node")
                for c, keys in enumerate(curves.value.keys(matrix(b.column("embedding").to_pylist()))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), c, np.int32)), pa.array(keys), nodes], ["curve", "key", "node"])
    keyed = vectors.select("node", "embedding").mapInArrow(key, "curve int, key bigint, node bigint")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = keyed.repartitionByRange(parts, "curve", "key", "node").sortWithinPartitions("curve", "key", "node")
    # written before it is used, so a rank never changes when a task runs again
    order = stored(order.withColumn("at", F.monotonically_increasing_id()), "ann-order")
    part = F.shiftright("at", 33)
    sizes = order.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum("m").over(W.orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    order = order.withColumn("p", part).join(sizes.select("p", before.alias("before")), "p")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) - F.col("curve") * n
    order = order.select("curve", "node", F.floor(rank / cfg.block).cast("int").alias("block"))
    placed = stored(order.join(vectors, "node"), "ann-placed")

    cand = placed.select("curve", "block", "node", "low", "embedding")
    ask = placed.where("asks").select("curve", F.explode(F.array(F.col("block") - 1, "block", F.col("block") + 1)).alias("block"),
                                      F.col("node").alias("q"), "embedding")
    k = cfg.k + 1

    def window(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({x: [] for x in ("q", "node", "low", "score")})
        return hits(q.q.to_numpy(), matrix(q.embedding), c.node.to_numpy(), c.low.to_numpy(), matrix(c.embedding), k)
    near = cand.groupBy("curve", "block").cogroup(ask.groupBy("curve", "block")).applyInPandas(window, HITS)
    near = stored(best(near, cfg).select("q", "node", "low", "score", "r"), "ann-near")

    far = check(placed, near, cfg)
    top = best(near.select("q", "node", "low", "score").unionByName(far), cfg)
    # indexed vectors back to rows; the query's own row goes
    rows_of = top.join(vectors.select("node", "ids"), "node").select("q", "node", "score", F.posexplode("ids").alias("pos", "vec_id"))
    w = W.partitionBy("q").orderBy(F.desc("score"), "vec_id", "node", "pos")
    rows_of = rows_of.withColumn("r", F.row_number().over(w)).where(F.col("r") <= cfg.k + 1)
    found = rows_of.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "node", "vec_id", "score"))).alias("found"))
    asked = is_query.join(vectors.where("asks").select("embedding", F.col("node").alias("q")), "embedding").select("q", F.col("vec_id").alias("query_id"))
    out = asked.join(found, "q").withColumn("own", F.expr(
        "array_min(transform(filter(found, x -> x.node = q and x.vec_id = query_id), x -> x.r))"))
    others = F.filter("found", lambda x: F.col("own").isNull() | (x["r"] != F.col("own")))
    out = out.select("query_id", F.posexplode(F.slice(others, 1, cfg.k)).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def check(placed: DataFrame, near: DataFrame, cfg: CurveConfig) -> DataFrame:
    """The exact check: hits in first-curve blocks outside the window that
    could hold a better row."""
    first = placed.where("curve = 0")
    floor = near.groupBy("q").agg(F.min(F.when(F.col("r") == cfg.k + 1, F.col("score"))).alias("floor"))
    floor = floor.select(F.col("q").alias("node"), F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))

    def pack(b: pd.DataFrame) -> pd.DataFrame:
        v = matrix(b.embedding)
        c = v.mean(axis=0)
        r = float(np.sqrt(((v - c) ** 2).sum(axis=1).max())) * (1 + 1e-9) + 1e-12
        return pd.DataFrame({"block": [b.block.iloc[0]], "nodes": [b.node.to_numpy(np.int64).tobytes()],
                             "lows": [b.low.to_numpy(np.int64).tobytes()], "v": [v.tobytes()], "c": [c.tolist()], "radius": [r]})
    ddl = "block int, nodes binary, lows binary, v binary, c array<double>, radius double"
    blocks = stored(first.select("block", "node", "low", "embedding").groupBy("block").applyInPandas(pack, ddl), "ann-blocks")

    def pack_queries(b: pd.DataFrame) -> pd.DataFrame:
        v = matrix(b.embedding)
        c = v.mean(axis=0)
        r = float(np.sqrt(((v - c) ** 2).sum(axis=1).max())) * (1 + 1e-9) + 1e-12
        return pd.DataFrame({"own": [b.block.iloc[0]], "qs": [b.node.to_numpy(np.int64).tobytes()], "qv": [v.tobytes()],
                             "floors": [b.floor.to_numpy(np.float64).tobytes()], "least": [b.floor.min()], "qc": [c.tolist()], "q_radius": [r]})
    asks = first.where("asks").select("block", "node", "embedding").join(floor, "node")
    packed = stored(asks.groupBy("block").applyInPandas(
        pack_queries, "own int, qs binary, qv binary, floors binary, least double, qc array<double>, q_radius double"), "ann-queries")
    count = blocks.count()
    # summaries only: every block of queries against every block of rows
    pairs = packed.select("own", "least", "qc", "q_radius", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("block"))
    pairs = pairs.where(F.abs(F.col("own") - F.col("block")) > 1).join(blocks.select("block", "c", "radius"), "block")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    most = (dot("qc", "c") + F.sqrt(dot("qc", "qc")) * F.col("radius") + F.sqrt(dot("c", "c")) * F.col("q_radius")
            + F.col("radius") * F.col("q_radius"))
    pairs = pairs.where(most + 1e-9 >= F.col("least")).select("own", "block")
    work = pairs.join(packed.select("own", "qs", "qv", "floors"), "own").join(blocks, "block")
    k = cfg.k + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                qs, floors = np.frombuffer(row["qs"], np.int64), np.frombuffer(row["floors"], np.float64)
                nodes, c = np.frombuffer(row["nodes"], np.int64), np.array(row["c"])
                qv = np.frombuffer(row["qv"], np.float64).reshape(len(qs), -1)
                v = np.frombuffer(row["v"], np.float64).reshape(len(nodes), -1)
                some = qv @ c + np.linalg.norm(qv, axis=1) * row["radius"] + 1e-9 >= floors
                got = hits(qs[some], qv[some], nodes, np.frombuffer(row["lows"], np.int64), v, k, floors[some])
                if len(got):
                    yield pa.RecordBatch.from_pandas(got.astype({"q": "int64", "node": "int64", "low": "int64"}), preserve_index=False)
    return work.mapInArrow(scan, HITS)
