import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from pixelflow.llm import prefix_trie as T

ROWS = "conv_id bigint, turn bigint, role string, text string"


def tie(role, text):
    d = hashlib.md5(f"{len(role or '')} {role or ''}{text or ''}".encode()).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def model(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, tie(*r[2:]))):
        own[c].append((role or "", text or ""))
    seq = {}
    for c in own:
        h = crc32(str(c).encode()) % 6
        seq[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    nodes = defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids = defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p], sha([c for c in m if len(seq[c]) == len(p)]))
                  for p, m in nodes.items())


def rows_of(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def make(seed, n):
    r = random.Random(seed)
    starts = [[(r.choice(["user", None]), r.choice(["a", "bb", "cé𝄞", "", None])) for _ in range(r.choice([0, 1, 3, 7]))] for _ in range(5)]
    rows = []
    for c in r.sample(range(0, 4 * n), n):
        turns = r.choice(starts)[:r.randrange(9)] + [(r.choice(["user", "bot"]), r.choice("xyz") * r.randrange(4)) for _ in range(r.choice([0, 0, 1, 2]))]
        k = r.choice([0, 5])
        rows += [(c, i + k if r.random() < 0.95 else None, *t) for i, t in enumerate(turns)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,segment,chunk", [(1, 400, 512, 1 << 16), (2, 300, 2, 64), (3, 12, 1, 1)])
def test_nodes_by_definition(spark, monkeypatch, seed, n, segment, chunk):
    monkeypatch.setattr(T, "SEGMENT", segment)
    monkeypatch.setattr(T, "CHUNK", chunk)
    rows = make(seed, n)
    got = T.trie(spark.createDataFrame(rows, ROWS).repartition(3))
    assert rows_of(got) == model(rows)


def test_hot_conversations(spark, monkeypatch):
    # one conversation with a third of all turns, one sequence with a third of all conversations
    monkeypatch.setattr(T, "SEGMENT", 16)
    rows = [(7, i, "user", f"t{i % 50}") for i in range(900)]
    rows += [(1000 + c, i, "user", f"q{i}") for c in range(150) for i in range(6)]
    rows += [(5000 + c, i, "bot", f"q{i}" if i < 3 else f"z{c}") for c in range(150) for i in range(6)]
    assert rows_of(T.trie(spark.createDataFrame(rows, ROWS))) == model(rows)


def test_ranks_over_cuts(spark):
    rows = [(c, i) for c, n in ((1, 500), (2, 1), (3, 77), (4, 500)) for i in range(n)]
    random.Random(1).shuffle(rows)
    got = T.ranked(spark.createDataFrame(rows, "c bigint, turn bigint"), ["c"], ["turn"]).collect()
    assert len(got) == len(rows) and all(r["rank"] == r.turn for r in got)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, None, None, None), (1, 2, "user", "x" * 50000), (101, 1, "user", "b"), (101, 1, "user", "a"),
            (-5, 3, "bot", "neg"), (7, 1, "", ""), (8, 9, None, ""), (100, 0, "u", "é𝄞")]
    df = spark.createDataFrame(rows, ROWS)
    want = model([r for r in rows if r[0] is None or r[0] >= 0])
    assert rows_of(T.trie(df.where("conv_id IS NULL OR conv_id >= 0"))) == want
    clash = df.selectExpr("*", "1 AS c", "2 AS rank", "3 AS depth", "4 AS len", "5 AS h1", "6 AS leaf", "7 AS k1")
    assert rows_of(T.trie(clash)) == rows_of(T.trie(df))
    assert T.trie(spark.createDataFrame([], ROWS)).count() == 0
    assert T.trie(df.where("conv_id IS NULL")).count() == 0
