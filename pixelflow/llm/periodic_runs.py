"""Periodic runs of words by a dictionary of basic factors.

Every factor of b = 1, 2, 4, ... words gets a name; two positions share the
name exactly where the b words there are equal (a factor of 2b words is the
pair of names b apart).  A run of smallest period q, b/2 < q <= b, repeats the
b words at i in i + q, and nowhere sooner (two periods would leave their
greatest common divisor as one).  So the successor distances of the level's
equal names propose the periods: each maximal arithmetic progression of
positions i, i + 1, ... with successor distance q is one run, already extended
as far as period q holds.

A level keeps positions whose factor occurs three times with gaps of at most
a quarter of the document (a run has four periods at least), so ordinary prose
leaves after two or three levels.

Nulls and edges: a null, empty or blank text has no words and no run; a null
doc_id is planted with nothing; very long texts are read whole; repeated rows
give repeated rows; an empty table gives no rows; columns other than doc_id
and text are read only where asked for.
"""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pixelflow.llm.common import map_batches

MIN_LENGTH, MIN_PERIODS = 6, 4
BLOCK_WORDS = 1 << 17     # words of the documents taken together (a longer one alone)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the repetition that the rule of doc_id puts in, if any."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _progressions(pos: np.ndarray, q: np.ndarray, b: int) -> np.ndarray:
    """(start, length, period) of each maximal stretch of positions one apart
    with one successor distance."""
    order = np.lexsort((pos, q))
    pos, q = pos[order], q[order]
    first = np.ones(len(pos), bool)
    first[1:] = (np.diff(pos) != 1) | (np.diff(q) != 0)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(pos)) - 1
    return np.column_stack((pos[at], pos[last] - pos[at] + q[at] + b, q[at]))


def find_runs(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Runs (start, length, period) over documents laid end to end: ``codes``
    are the words' names, of which no two documents share any, ``ends`` where
    each document ends.  Sorted by start, then period."""
    sizes = np.diff(np.concatenate([[0], ends]))
    widest = np.repeat(sizes // MIN_PERIODS, sizes)        # longest possible period, by position
    pos, name, b, found = np.arange(len(codes)), codes, 1, []
    while len(pos):
        order = np.argsort(name, kind="stable")            # within a name by position
        p, s = pos[order], name[order]
        same = s[1:] == s[:-1]
        gap = p[1:] - p[:-1]
        hit = same & (gap <= b) & (2 * gap > b)
        if hit.any():
            found.append(_progressions(p[:-1][hit], gap[hit], b))
        near = same & (gap <= widest[p[:-1]])              # joined to the next occurrence
        before, after = np.append(False, near), np.append(near, False)
        thrice = np.zeros(len(p), bool)
        mid = np.flatnonzero(before & after)
        thrice[mid] = thrice[mid - 1] = thrice[mid + 1] = True
        # names of twice the length: pairs of kept names b apart
        rank = np.cumsum(np.append(True, ~same))
        of = np.zeros(len(codes) + b, np.int64)
        of[p[thrice]] = rank[thrice]
        pos = np.sort(p[thrice])
        pos = pos[of[pos + b] > 0]
        name = of[pos] * (rank[-1] + 1) + of[pos + b]
        b *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.unique(np.concatenate(found), axis=0)        # by start, length, period; no run twice
    runs = runs[runs[:, 1] >= np.maximum(MIN_LENGTH, MIN_PERIODS * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words left when every run keeps its first period only."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(step)[:-1] == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def runs_of(docs: list[list[bytes]]) -> list[np.ndarray]:
    """Each document's runs (start, length, period), word numbers from 0."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(docs):
        codes, ends, size, first = [], [], 0, at
        while at < len(docs) and (at == first or size + len(docs[at]) <= BLOCK_WORDS):
            base, names = len(codes), {}
            codes.extend([names.setdefault(w, base + k) for k, w in enumerate(docs[at])])
            size += len(docs[at])
            ends.append(size)
            at += 1
        ends = np.array(ends)
        runs = find_runs(np.array(codes, np.int64), ends)
        cut = np.searchsorted(runs[:, 0], ends)
        for lo, hi, start in zip(np.append(0, cut[:-1]), cut, np.append(0, ends[:-1])):
            out.append(runs[lo:hi] - [start, 0, 0])
    return out


RUN_COLUMNS = ("n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
               "runs array<struct<start:bigint,length:bigint,period:bigint>>, runs_sha256 string")


def scan(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), plant: bool = False, texts: bool = False) -> DataFrame:
    """``columns`` and, per document: n_runs; start, length, period and
    exponent_milli of the longest run (ties: smallest start, then period);
    all ``runs`` and their digest; with ``texts`` ``collapsed``, the text with
    every run cut to its first period, else its digest ``collapsed_sha256``.

    ``plant`` puts in the repetition that :func:`planted` describes first."""
    fields = [f for f in docs.schema.fields if f.name in columns]
    names = [f.name for f in fields]
    last = "collapsed" if texts else "collapsed_sha256"
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, raw = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
        words = [(t or "").encode("utf-8").split() for t in raw]      # bytes: splits at \x20 and \x09-\x0D
        if plant:
            words = [planted(i, w) for i, w in zip(ids, words)]
        found = runs_of(words)
        best, sha, texts_out = [], [], []
        for w, r in zip(words, found):
            top = r[np.lexsort((r[:, 2], r[:, 0], -r[:, 1]))[0]].tolist() if len(r) else [None] * 3
            best.append(top + [1000 * top[1] // top[2] if len(r) else None])
            sha.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in r.tolist()).encode()).hexdigest())
            left = collapsed(w, r)
            texts_out.append(left.decode("utf-8") if texts else hashlib.sha256(left).hexdigest())
        flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run)))
        cols = [pa.array([len(r) for r in found], pa.int64()), *[pa.array([x[k] for x in best], pa.int64()) for k in range(4)],
                lists, pa.array(sha), pa.array(texts_out, pa.string())]
        return pa.RecordBatch.from_arrays([*map(b.column, names), *cols],
                                          [*names, "n_runs", "start", "length", "period", "exponent_milli", "runs", "runs_sha256", last])
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return map_batches(docs.select(*dict.fromkeys([*names, "doc_id", "text"])), batch,
                       f"{ddl}{RUN_COLUMNS}, {last} string", rows=256)
