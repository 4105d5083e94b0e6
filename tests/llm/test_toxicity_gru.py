import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from pixelflow.llm import toxicity_gru as T

SMALL = T.GruConfig(window=6, stride=3, dim=5, hidden=4, buckets=64, steps=120, train_docs=60)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = T.Network(SMALL)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) + rng.normal(0, 0.1, net.p[k].shape)
    words = ["one", "two", "three", "four", "five"]
    inp, keep = T.Inputs(words, SMALL.buckets), np.array([1, 1, 0, 1, 1.0])
    ids = rng.integers(0, 5, (6, 3))
    mask = np.ones((6, 3))
    mask[4:, 1] = 0
    dl = rng.normal(size=3)

    def loss():
        return float((net.forward(net.embed(inp, keep), ids, mask) * dl).sum())
    x, trace = net.embed(inp, keep), {}
    net.forward(x, ids, mask, trace)
    grad = net.backward(x, ids, mask, trace, dl, inp, keep)
    for k, v in net.p.items():
        at = [(int(i),) for i in inp.word[:1]] if k == "ew" else [(int(inp.gram[0]),)] if k == "ec" else [()]
        for one in at:
            spot = one + tuple(rng.integers(0, s) for s in v.shape[len(one):])
            old = v[spot]
            v[spot] = old + 1e-3
            up = loss()
            v[spot] = old - 1e-3
            down = loss()
            v[spot] = old
            assert abs((up - down) / 2e-3 - grad[k][spot]) < 2e-3 * max(1, abs(grad[k][spot])), k


def test_windows_cover_every_word():
    for n in range(0, 60):
        st = T.windows(n, SMALL)
        assert {i for s in st for i in range(s, min(s + SMALL.window, n))} == set(range(n))


def corpus(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        bad = i % 3 == 0
        ws = [r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(r.randint(3, 60))]
        if bad:
            ws.insert(r.randrange(len(ws) + 1), r.choice(["grubbish", "Grubber", "snorkle!"]))
        out.append((i, " ".join(ws), int(bad)))
    return out


def test_learns_and_scores_held_out(spark):
    rows = corpus(400, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(5000, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    cfg = T.GruConfig(steps=150, train_docs=100)
    sample, share = T.training_rows(docs, labels, cfg)
    assert abs(share - 1 / 3) < 0.05 and len(sample) <= 200
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i, t, _ in rows if (t in {x for x, _ in sample}) and [u for _, u, _ in rows].count(t) == 1)
    net = T.train(sample, share, cfg)
    got = {r.doc_id: r.score for r in T.predict(docs, net).where(T.held_out(F.col("doc_id"))).collect()}
    right = sum((got[i] >= 0.3) == bool(y) for i, _, y in rows if i in got)
    assert right >= 0.95 * len(got)
    # deep inside a long text, alone among clean words
    clean = "alpha beta gamma " * 3000
    a, b = T.score(net, [clean + "grubbish " + clean, clean])
    assert a >= 0.3 > b


def test_odd_rows(odd, none, clashing):
    net = T.train([(t, y) for _, t, y in corpus(40, 2)], 0.3, SMALL)
    rows = T.predict(odd, net, ("doc_id", "text")).collect()
    assert len(rows) == odd.count()
    assert all(r.score == 0.0 for r in rows if not (r.text or "").strip()) and all(0 <= r.score <= 1 for r in rows)
    assert T.predict(none, net).count() == 0 and T.predict(clashing, net).count() == odd.count()
    assert T.train([("a", 1)], 1.0) is None and T.train([], 0.0) is None
    assert {r.score for r in T.predict(odd, None).collect()} == {0.0}
