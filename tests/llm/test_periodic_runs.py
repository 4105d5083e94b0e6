import hashlib
import random
from zlib import crc32

from pixelflow.llm import periodic_runs as P


def model(words):
    """Runs by definition: every stretch of every period, smallest period kept."""
    n, spans = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                spans.setdefault((i, j - i + q), q)           # periods ascend: the smallest stays
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in spans.items())


def rows_model(doc_id, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = model(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


COLS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def texts(seed, n):
    r = random.Random(seed)
    for _ in range(n):
        out = []
        for _ in range(r.choice([0, 1, 3, 6])):
            part = [r.choice("abc") for _ in range(r.choice([1, 2, 3, 4, 5, 7, 8, 9, 16, 17]))]
            out += part * r.choice([1, 1, 3, 4, 5, 9]) + part[:r.randrange(len(part) + 1)]
            if r.random() < 0.3:
                out.append(r.choice("xyz"))
        yield out


def test_runs_by_definition():
    docs = list(texts(1, 1500)) + [list("a" * n) for n in range(12)] + [list("ab" * n) for n in range(9)] + [[]]
    got = P.runs_of([[w.encode() for w in d] for d in docs])
    for d, r in zip(docs, got):
        assert sorted(map(tuple, r.tolist())) == model(d), d


def test_a_document_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(P, "BLOCK_WORDS", 20)
    docs = list(texts(2, 300))
    for d, r in zip(docs, P.runs_of([[w.encode() for w in d] for d in docs])):
        assert sorted(map(tuple, r.tolist())) == model(d)


def test_query_rows_by_definition(spark):
    r = random.Random(3)
    rows = [(i, " ".join(w).replace(" ", r.choice([" ", "\n", "\t ", "\x0b"]))) for i, w in enumerate(texts(4, 400))]
    rows += [(1000 + i, " ".join(r.choice(["a", "b", "ñ\xa0c", "d\x1fe"]) + str(r.randrange(9)) for _ in range(r.randrange(80)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, P.scan(df, plant=True).select(*COLS).collect()))
    assert got == sorted(rows_model(*x) for x in rows)
    assert sum(x[1] > 0 for x in got if x[0] >= 1000) > 10                # planted ones among them


def test_odd_rows_and_texts(spark, odd, none, clashing):
    key = lambda t: tuple((x is None, x) for x in t)
    got = sorted((tuple(x) for x in P.scan(clashing, plant=True).select(*COLS).collect()), key=key)
    assert got == sorted((rows_model(x.doc_id, x.text) if x.doc_id != 5 else tuple(x5) for x in odd.collect()
                          for x5 in [P.scan(odd.where("doc_id = 5"), plant=True).select(*COLS).first()]), key=key)
    five = P.scan(odd.where("doc_id = 5"), texts=True).first()
    assert (five.n_runs, five.start, five.length, five.period, five.collapsed) == (1, 0, 30000, 1, "word")
    assert [tuple(x) for x in five.runs] == [(0, 30000, 1)]
    assert P.scan(none).count() == 0
    assert P.scan(clashing, columns=("doc_id", "lang", "n")).columns[:3] == ["doc_id", "lang", "n"]
