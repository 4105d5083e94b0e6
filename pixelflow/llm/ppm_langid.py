"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes long with the
counts of the byte that follows.  A byte costs its code length in the longest
context that has seen it: -log2(c / (n + d)) there (c of n followers, d of
them distinct), plus -log2(d / (n + d)) for every longer known context that
had to be escaped, down to a uniform byte.  The counts are frozen after
training, so the cost of every (context, byte) pair is a table, and a text's
exact code length per language is a sum of table entries, taken with numpy
over blocks of concatenated whole texts.  The shortest code wins.

Training reads at most ``train_bytes`` bytes per language (a documented
bound; documents are taken in the order of a hash and the last is cut at the
bound), which also bounds the tables that are broadcast.  Scoring reads every byte of every text.

Nulls and edges: ``und`` with score 0 for a null text, a text without a
letter, or when nothing could be learned; ids are carried unread; a null id
counts as the empty string for the fold; ties go to the smaller language
name; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pixelflow.llm.common import map_batches

UNKNOWN = "und"


@dataclass(frozen=True)
class PpmConfig:
    train_bytes: int = 400_000     # bytes of training text per language, at most
    temper_bytes: int = 64         # the score weighs a text as if it had at most so many bytes
    block_bytes: int = 1 << 17     # bytes scored at once


def held_out(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, mod 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def training_texts(docs: DataFrame, cfg: PpmConfig) -> dict[str, list[str]]:
    """Texts per language in the order of their (unsigned) hash until the byte
    bound is reached; the last one is cut there, between characters.  So every
    labelled language has at least one text, and no more than the bound.

    Byte totals per binary size of the hash (at most 64 rows a language) give
    the smallest range of hashes that fills the bound; only it is sorted."""
    h = F.xxhash64("doc_id", "text")
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0))
    rows = rows.select("lang", "text", F.octet_length("text").cast("long").alias("b"), F.length(F.bin(h)).alias("size"),
                       F.lpad(F.hex(h), 16, "0").alias("h"))
    sizes = rows.groupBy("lang", "size").agg(F.sum("b").alias("b"))
    upto = W.partitionBy("lang").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("less", F.coalesce(F.sum("b").over(upto), F.lit(0))).where(F.col("less") < cfg.train_bytes)
    drawn = rows.join(F.broadcast(sizes.select("lang", "size")), ["lang", "size"])      # at most 64 rows a language
    run = W.partitionBy("lang").orderBy("h", "text").rowsBetween(W.unboundedPreceding, -1)
    kept = drawn.withColumn("before", F.coalesce(F.sum("b").over(run), F.lit(0))).where(F.col("before") < cfg.train_bytes)
    left = (F.lit(cfg.train_bytes) - F.col("before")).cast("int")
    kept = kept.select("lang", "h", "text", F.substring(F.encode("text", "UTF-8"), F.lit(1), left).alias("raw"))
    out: dict[str, list[str]] = {}
    for r in kept.orderBy("lang", "h", "text").select("lang", "raw").collect():
        out.setdefault(r.lang, []).append(bytes(r.raw).decode("utf-8", "ignore"))
    return out


class ContextTree:
    """Cost table of one language over its own contexts and byte classes.

    ``cls`` maps a byte to its class (bytes not trained on share the last
    one).  Contexts are numbered: 0 the empty one, then one byte, two and three
    bytes; ``two`` and ``three`` give the number of a context from its parts
    (or of its longest known end), ``cost[context * classes + class]`` the code
    length in bits."""

    def __init__(self, texts: list[str]):
        data = [np.frombuffer(t.encode("utf-8"), np.uint8) for t in texts]
        used = np.unique(np.concatenate(data))
        self.S = S = len(used) + 1
        self.cls = np.full(256, S - 1, np.int64)
        self.cls[used] = np.arange(S - 1)
        # (context, next class) codes with counts, by context length
        grams: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(4):
            codes = []
            for x in data:
                c = self.cls[x]
                code = np.zeros(max(len(c) - k, 0), np.int64)
                for j in range(k + 1):
                    code = code * S + c[j:len(c) - k + j]
                codes.append(code)
            grams.append(np.unique(np.concatenate(codes), return_counts=True))
        known = [np.unique(g[0] // S) for g in grams]
        base = np.cumsum([0] + [len(x) for x in known])
        n_ctx = int(base[-1])

        def number(k: int, code: np.ndarray, other: np.ndarray) -> np.ndarray:
            """The number of a length-k context, or ``other`` if not known."""
            if not len(known[k]):
                return other
            at = np.minimum(np.searchsorted(known[k], code), len(known[k]) - 1)
            return np.where(known[k][at] == code, base[k] + at, other)
        one = number(1, np.arange(S), np.zeros(S, np.int64))
        self.one = one.astype(np.int32)
        # two[a, b]: the longest known end of "ab"
        self.two = number(2, np.arange(S * S), np.tile(one, S)).astype(np.int32)
        # three[context number of "ab", c], -1 where only a shorter end is known
        self.first = int(base[2])
        ab = known[2][:, None] * S + np.arange(S)[None, :]
        self.three = number(3, ab.ravel(), np.full(ab.size, -1, np.int64)).reshape(ab.shape).astype(np.int32)
        # costs, shorter contexts first: a context starts from its end's costs plus the escape
        cost = np.zeros((n_ctx, S), np.float32)
        parent = [None, np.zeros(len(known[1]), np.int64), number(1, known[2] % S, np.zeros(len(known[2]), np.int64)),
                  self.two[known[3] % (S * S)].astype(np.int64)]
        for k, (code, count) in enumerate(grams):
            row = np.searchsorted(known[k], code // S)
            n = np.bincount(row, count, len(known[k]))
            d = np.bincount(row, minlength=len(known[k]))
            esc = -np.log2(d / (n + d))
            below = 8.0 if k == 0 else cost[parent[k]]
            cost[base[k]:base[k + 1]] = below + esc[:, None]
            cost[base[k] + row, code % S] = -np.log2(count / (n + d)[row])
        self.cost = cost.ravel()

    def code_lengths(self, blob: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of the texts concatenated in ``blob``; text i begins at
        ``starts[i]`` (all non-empty)."""
        S, c = self.S, self.cls[blob]
        ctx = np.zeros(len(c), np.int32)
        ctx[1:] = self.one[c[:-1]]
        two = self.two[c[:-2] * S + c[1:-1]] if len(c) > 2 else np.zeros(0, np.int32)
        ctx[2:] = two
        if len(c) > 3 and len(self.three):
            at = two[:-1] - self.first                 # only real two-byte contexts extend
            real = (at >= 0) & (at < len(self.three))
            three = np.where(real, self.three[np.where(real, at, 0), c[2:-1]], -1)
            ctx[3:] = np.where(three >= 0, three, two[1:])
        # contexts do not reach over the start of a text
        ends = np.append(starts[1:], len(c))
        ctx[starts] = 0
        s = starts[starts + 1 < ends] + 1
        ctx[s] = self.one[c[s - 1]]
        s = starts[starts + 2 < ends] + 2
        ctx[s] = self.two[c[s - 2] * S + c[s - 1]]
        return np.add.reduceat(self.cost[ctx.astype(np.int64) * S + c], starts, dtype=np.float64)


class PpmModel:
    """The trees of all languages: their size is the sum of the languages'
    own tables, each bounded by its training bytes."""

    def __init__(self, texts: dict[str, list[str]], cfg: PpmConfig):
        self.cfg = cfg
        self.langs = sorted(texts)
        self.trees = [ContextTree(texts[lang]) for lang in self.langs]

    def code_lengths(self, blob: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits per (text, language), see :meth:`ContextTree.code_lengths`."""
        return np.stack([t.code_lengths(blob, starts) for t in self.trees], axis=1)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, score, bits per byte under it) of each whole text."""
        out: list = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        block: list[tuple[int, bytes]] = []
        size = 0
        for i, t in enumerate(texts):
            if self.langs and t and any(map(str.isalpha, t)):
                raw = t.encode("utf-8")
                block.append((i, raw))
                size += len(raw)
            if block and (size >= self.cfg.block_bytes or i == len(texts) - 1):
                self._flush(block, out)
                block, size = [], 0
        if block:
            self._flush(block, out)
        return out

    def _flush(self, block: list[tuple[int, bytes]], out: list) -> None:
        n = np.array([len(b) for _, b in block])
        # a text longer than a block is scored piece by piece, with three bytes of context
        if len(block) == 1 and n[0] > 2 * self.cfg.block_bytes:
            raw, bits, step = np.frombuffer(block[0][1], np.uint8), 0.0, self.cfg.block_bytes
            for at in range(0, len(raw), step):
                lead = min(at, 3)
                part = raw[at - lead:at + step]
                bits = bits + self.code_lengths(part, np.array([0])) - (
                    self.code_lengths(part[:lead], np.array([0])) if lead else 0.0)
        else:
            blob = np.frombuffer(b"".join(b for _, b in block), np.uint8)
            bits = self.code_lengths(blob, np.concatenate([[0], np.cumsum(n)[:-1]]))
        best = np.argmin(bits, axis=1)
        least = bits[np.arange(len(best)), best]
        weight = np.minimum(1.0, self.cfg.temper_bytes / n)[:, None]
        score = 1.0 / np.exp2(-np.minimum((bits - least[:, None]) * weight, 1000.0)).sum(axis=1)
        for k, (i, _) in enumerate(block):
            out[i] = (self.langs[best[k]], float(score[k]), float(least[k] / n[k]))


def train(docs: DataFrame, cfg: PpmConfig = PpmConfig()) -> PpmModel:
    return PpmModel(training_texts(docs, cfg), cfg)


def predict(docs: DataFrame, model: PpmModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred, score and bits_per_byte per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # bounded by train_bytes x languages
    fields = [f for f in docs.schema.fields if f.name in keep]
    names = [f.name for f in fields]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = shared.value.predict(b.column("text").to_pylist())
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
        return pa.RecordBatch.from_arrays([*map(b.column, names), *cols], [*names, "lang_pred", "score", "bits_per_byte"])
    return map_batches(docs.select(*dict.fromkeys([*names, "text"])), batch,
                       ddl + "lang_pred string, score double, bits_per_byte double")
