"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs of a word: an embedding of its hashed form plus the mean embedding of
its hashed byte n-grams (3 and 5 bytes, with marks at both ends), so parts of
words count as well as whole ones.  Two recurrent layers read a window of
words in both directions; attention pools their states into one logit.

Trained in numpy on a bounded sample of labelled documents (``train_docs`` of
each class, ``train_windows`` random windows of each a pass): a document's
logit is the softmax-weighted mean of its windows' logits, so that the windows
that matter learn the label.  A final two-parameter logistic fit calibrates
the highest window logit.  Scoring runs over all overlapping windows of every
whole text; the document's score is that of its highest window.

Nulls and edges: a text without words (null, empty, symbols only) scores 0; a
missing label row is not used for training, a null label neither; without
both classes every score is 0; a null id counts as the empty string for the
fold; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pixelflow.llm.common import map_batches

WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class GruConfig:
    window: int = 32            # words of a window
    stride: int = 16            # words between window starts
    dim: int = 16               # input size
    hidden: int = 12            # state size per direction
    buckets: int = 1 << 14      # rows of each embedding table
    train_docs: int = 1500      # documents per class, at most
    train_windows: int = 24     # windows of a document used in one pass
    steps: int = 800            # training steps, each on 8 toxic and 16 other documents
    rate: float = 0.01
    seed: int = 7


def held_out(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, mod 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, cfg: GruConfig) -> tuple[list[tuple[str, int]], float]:
    """(text, label) of at most ``train_docs`` documents per class, chosen by
    hash outside the held-out fold, and the toxic share of all such labels."""
    lab = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lab = lab.where(~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))
    n = {r.toxic: r.n for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for y in (0, 1):
        if n.get(y):
            share = min(1.0, cfg.train_docs / n[y])
            pick = lab.where((F.col("toxic") == y) & (F.pmod("h", F.lit(1 << 20)) < share * (1 << 20))).select("doc_id", "h")
            rows = docs.select("doc_id", "text").where(F.length("text") > 0).join(pick, "doc_id").orderBy("h", "text").limit(cfg.train_docs)
            out += [(r.text, y) for r in rows.collect()]
    return out, n.get(1, 0) / max(n.get(0, 0) + n.get(1, 0), 1)


_G, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Inputs:
    """Hash buckets of distinct words: of the word and of its byte n-grams."""

    def __init__(self, words: list[str], buckets: int):
        raw = [b"^" + w.encode("utf-8", "surrogatepass") + b"$" for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        blob = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
        start = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        owner = np.repeat(np.arange(len(raw)), size)
        at = np.arange(len(blob))
        left = start[1:][owner] - at                     # bytes left in the word
        mask = np.uint64(buckets - 1)
        grams, owners = [], []
        h = np.zeros(len(blob), np.uint64)
        for k in range(5):
            h[:len(blob) - k] = (h[:len(blob) - k] ^ blob[k:]) * _G
            if k in (2, 4):
                ok = left > k
                x = h[ok]
                grams.append((((x ^ (x >> np.uint64(29))) * _M) >> np.uint64(40)) & mask)
                owners.append(owner[ok])
        g, o = np.concatenate(grams).astype(np.int64), np.concatenate(owners)
        order = np.argsort(o, kind="stable")
        self.gram, self.owner = g[order], o[order]
        self.count = np.bincount(o, minlength=len(raw)).astype(np.float32)
        self.first = np.concatenate([[0], np.cumsum(self.count)[:-1]]).astype(np.int64)
        powers = np.multiply.accumulate(np.full(int(size.max(initial=1)), _G))
        whole = np.add.reduceat(blob * powers[at - start[owner]], start[:-1]) if len(raw) else np.zeros(0, np.uint64)
        whole = (whole ^ (whole >> np.uint64(31))) * _M
        self.word = ((whole >> np.uint64(40)) & mask).astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, forward and backward passes."""

    def __init__(self, cfg: GruConfig):
        r = np.random.default_rng(cfg.seed)
        d, h = cfg.dim, cfg.hidden
        u = lambda *s: (r.uniform(-1, 1, s) / np.sqrt(s[0])).astype(np.float32)
        self.cfg = cfg
        self.p = {"ew": np.zeros((cfg.buckets, d), np.float32), "ec": (r.normal(0, 0.1, (cfg.buckets, d))).astype(np.float32),
                  "wa": u(2 * h, h), "ba": np.zeros(h, np.float32), "va": u(h, 1)[:, 0], "wo": u(2 * h, 1)[:, 0],
                  "bo": np.zeros(1, np.float32)}
        for s in "fb":
            self.p |= {f"w{s}": u(d, 3 * h), f"u{s}": u(h, 3 * h), f"c{s}": np.zeros(3 * h, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def embed(self, inp: Inputs, keep: np.ndarray | None = None) -> np.ndarray:
        ew = self.p["ew"][inp.word]
        if keep is not None:
            ew = ew * keep[:, None]
        if not len(inp.word):
            return ew
        return ew + np.add.reduceat(self.p["ec"][inp.gram], inp.first, axis=0) / inp.count[:, None]

    def run(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, s: str, trace: list | None = None) -> np.ndarray:
        """States (T, B, H) of one direction; ``table`` holds the words' input
        parts, ``ids`` and ``mask`` are (T, B)."""
        h = self.cfg.hidden
        u, out = self.p[f"u{s}"], np.empty((*ids.shape, h), np.float32)
        state = np.zeros((ids.shape[1], h), np.float32)
        for t in (range(len(ids)) if s == "f" else range(len(ids) - 1, -1, -1)):
            gx, gh = table[ids[t]], state @ u
            rz = gx[:, :2 * h] + gh[:, :2 * h]
            np.negative(rz, rz)
            np.exp(np.clip(rz, -30, 30, rz), rz)
            rz += 1
            np.reciprocal(rz, rz)
            n = np.tanh(gx[:, 2 * h:] + rz[:, :h] * gh[:, 2 * h:])
            new = n + rz[:, h:] * (state - n)
            m = mask[t][:, None]
            if trace is not None:
                trace.append((t, state, rz, n, gh[:, 2 * h:], m))
            state = state + m * (new - state)
            out[t] = state
        return out

    def forward(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """The logit of each window (column of ``ids``)."""
        p, both = self.p, []
        for s in "fb":
            tr = None if trace is None else trace.setdefault(s, [])
            both.append(self.run(x @ p[f"w{s}"] + p[f"c{s}"], ids, mask, s, tr))
        hs = np.concatenate(both, axis=2)
        a = np.tanh(hs @ p["wa"] + p["ba"])
        e = a @ p["va"] + (mask - 1) * 1e4
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", w, hs)
        if trace is not None:
            trace |= {"hs": hs, "a": a, "w": w, "pooled": pooled}
        return pooled @ p["wo"] + p["bo"]

    def backward(self, x, ids, mask, trace, dl, inp: Inputs, keep) -> dict:
        p, h, g = self.p, self.cfg.hidden, {}
        hs, a, w, pooled = (trace[k] for k in ("hs", "a", "w", "pooled"))
        g["wo"], g["bo"] = pooled.T @ dl, dl.sum(keepdims=True)
        dp = dl[:, None] * p["wo"]
        dw = np.einsum("bh,tbh->tb", dp, hs)
        de = w * (dw - (w * dw).sum(axis=0))
        da = de[:, :, None] * p["va"] * (1 - a * a)
        g["va"] = np.einsum("tb,tbh->h", de, a)
        g["wa"], g["ba"] = np.einsum("tbi,tbj->ij", hs, da), da.sum((0, 1))
        dhs = w[:, :, None] * dp + da @ p["wa"].T
        dx = np.zeros_like(x)
        for k, s in enumerate("fb"):
            u = p[f"u{s}"]
            gu, gt = np.zeros_like(u), np.zeros((len(x), 3 * h), np.float32)
            dstate = np.zeros((ids.shape[1], h), np.float32)
            for t, prev, rz, n, ghn, m in reversed(trace[s]):
                d = dstate + dhs[t][:, k * h:(k + 1) * h]
                dnew = d * m
                r, z = rz[:, :h], rz[:, h:]
                dn = dnew * (1 - z) * (1 - n * n)
                dz = dnew * (prev - n) * z * (1 - z)
                dr = dn * ghn * r * (1 - r)
                dgh = np.concatenate([dr, dz, dn * r], axis=1)
                np.add.at(gt, ids[t], np.concatenate([dr, dz, dn], axis=1))
                gu += prev.T @ dgh
                dstate = d * (1 - m) + dnew * z + dgh @ u.T
            g[f"u{s}"], g[f"c{s}"], g[f"w{s}"] = gu, gt.sum(axis=0), x.T @ gt
            dx += gt @ p[f"w{s}"].T
        g["ew"], g["ec"] = np.zeros_like(p["ew"]), np.zeros_like(p["ec"])
        np.add.at(g["ew"], inp.word, dx * keep[:, None])
        np.add.at(g["ec"], inp.gram, (dx / inp.count[:, None])[inp.owner])
        return g


def windows(n: int, cfg: GruConfig) -> list[int]:
    """Starts of the overlapping windows over ``n`` words (the last one ends
    with the text)."""
    if n <= cfg.window:
        return [0] if n else []
    out = list(range(0, n - cfg.window, cfg.stride))
    return out + [n - cfg.window]


def _columns(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, cfg: GruConfig) -> tuple[np.ndarray, np.ndarray]:
    """(T, B) word rows and mask of windows given by start and length."""
    t = np.arange(cfg.window)[:, None]
    mask = t < lengths[None, :]
    return ids[np.where(mask, starts[None, :] + t, starts[None, :])], mask.astype(np.float32)


def train(rows: list[tuple[str, int]], toxic_share: float, cfg: GruConfig = GruConfig()) -> Network | None:
    """The network fitted to (text, label) rows and calibrated to the share of
    toxic documents; None without both classes."""
    rng, net = np.random.default_rng(cfg.seed), Network(cfg)
    vocab: dict[str, int] = {}
    docs = [(np.array([vocab.setdefault(w, len(vocab)) for w in WORDS.findall(t.lower())], np.int64), y) for t, y in rows]
    docs = [(d, y) for d, y in docs if len(d)]
    if len({y for _, y in docs}) < 2:
        return None
    names = list(vocab)
    by_class = [np.flatnonzero([y == c for _, y in docs]) for c in (0, 1)]
    queues: list[list[int]] = [[], []]
    first, second, step = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0

    def batch(some, limit):
        ids, starts, lengths, owner = [], [], [], []
        at = 0
        for k, (d, _) in enumerate(some):
            st = windows(len(d), cfg)
            if limit and len(st) > limit:
                st = sorted(rng.choice(st, limit, replace=False).tolist())
            starts += [at + s for s in st]
            lengths += [min(cfg.window, len(d))] * len(st)
            owner += [k] * len(st)
            ids.append(d)
            at += len(d)
        flat = np.concatenate(ids)
        rows_, mask = _columns(flat, np.array(starts), np.array(lengths), cfg)
        used, local = np.unique(rows_, return_inverse=True)
        return Inputs([names[i] for i in used], cfg.buckets), local.reshape(rows_.shape), mask, np.array(owner)
    for turn in range(cfg.steps):
        rate = cfg.rate * (1 if turn < cfg.steps * 0.6 else 0.3)
        some = []
        for c, n in ((1, 8), (0, 16)):
            while len(queues[c]) < n:
                queues[c] += rng.permutation(by_class[c]).tolist()
            some += [docs[i] for i in queues[c][:n]]
            del queues[c][:n]
        inp, ids, mask, owner = batch(some, cfg.train_windows)
        keep = (rng.random(len(inp.word)) > 0.2).astype(np.float32)
        x, trace = net.embed(inp, keep), {}
        logit = net.forward(x, ids, mask, trace)
        y = np.array([y for _, y in some], np.float32)
        top = np.full(len(some), -np.inf, np.float32)
        np.maximum.at(top, owner, logit)
        w = np.exp(logit - top[owner])
        w /= np.bincount(owner, w)[owner]
        doc = np.bincount(owner, w * logit, len(some))
        dl = ((sigmoid(doc) - y)[owner] * w / len(some)).astype(np.float32)
        g = net.backward(x, ids, mask, trace, dl, inp, keep)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        step += 1
        for k, v in g.items():
            v *= min(1.0, 1.0 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            net.p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    # calibration of the highest window logit
    top = np.array([x for at in range(0, len(docs), 64)
                    for x, _ in _tops(net, [[names[i] for i in d] for d, _ in docs[at:at + 64]])])
    y = np.array([y for _, y in docs], float)
    weight = np.where(y == 1, toxic_share / y.mean(), (1 - toxic_share) / (1 - y.mean()))
    a, b = 1.0, 0.0
    for _ in range(200):                                    # damped Newton steps with a weak pull to (1, 0)
        q = sigmoid(a * top + b)
        r, v = weight * (q - y), weight * np.maximum(q * (1 - q), 1e-6)
        grad = np.array([(r * top).sum() + (a - 1), r.sum() + 0.1 * b])
        hess = np.array([[(v * top * top).sum() + 1, (v * top).sum()], [(v * top).sum(), v.sum() + 0.1]])
        move = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        a, b = max(a - move[0], 0.05), b - move[1]
    net.scale, net.shift = float(a), float(b)
    return net


def _tops(net: Network, docs: list[list[str]], block: int = 4096) -> list[tuple[float, int]]:
    """(highest window logit, windows) of each document's words."""
    cfg = net.cfg
    vocab: dict[str, int] = {}
    row = vocab.setdefault
    ids = np.array([row(w, len(vocab)) for d in docs for w in d], np.int32)
    best, count = np.full(len(docs), -np.inf, np.float32), np.zeros(len(docs), np.int64)
    if not len(ids):
        return list(zip(best.tolist(), count.tolist()))
    x = net.embed(Inputs(list(vocab), cfg.buckets))
    starts, lengths, owner, at = [], [], [], 0
    for k, d in enumerate(docs):
        st = windows(len(d), cfg)
        starts += [at + s for s in st]
        lengths += [min(cfg.window, len(d))] * len(st)
        owner += [k] * len(st)
        at += len(d)
    starts, lengths, owner = np.array(starts), np.array(lengths), np.array(owner)
    for a in range(0, len(starts), block):
        part = slice(a, a + block)
        cols, mask = _columns(ids, starts[part], lengths[part], cfg)
        np.maximum.at(best, owner[part], net.forward(x, cols, mask))
    return list(zip(best.tolist(), np.bincount(owner, minlength=len(docs)).tolist()))


def score(net: Network | None, texts: list[str | None]) -> list[float]:
    words = [WORDS.findall((t or "").lower()) for t in texts]
    if net is None:
        return [0.0] * len(texts)
    return [float(sigmoid(np.float64(net.scale * x + net.shift))) if n else 0.0 for x, n in _tops(net, words)]


def predict(docs: DataFrame, net: Network | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score`` per document."""
    shared = docs.sparkSession.sparkContext.broadcast(net)      # two tables of ``buckets`` rows: about 2 MB
    fields = [f for f in docs.schema.fields if f.name in keep]
    names = [f.name for f in fields]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        out = score(shared.value, b.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(out, pa.float64())], [*names, "score"])
    return map_batches(docs.select(*dict.fromkeys([*names, "text"])), batch, ddl + "score double", rows=256)
