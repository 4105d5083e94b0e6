import random
import re

from pyspark.sql import functions as F

from pixelflow.llm import common, jaccard_join as J


def sets(text, words=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()


def model(rows, cfg=J.JoinConfig()):
    """Every pair, by definition."""
    s = [sets(t, cfg.words) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= cfg.percent * (len(s[i]) + len(s[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(s[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)]


def texts(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    common = [" ".join(r.choice(vocab) for _ in range(30)) for _ in range(3)]
    out = []
    while len(out) < n:
        base = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 5, 12, 40, 90, 200]))]
        if r.random() < 0.4:
            base += r.choice(common).split()
        for _ in range(r.choice([1, 1, 1, 2, 3, 8, 20])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                w[r.randrange(len(w))] = r.choice(vocab)
            out.append(" ".join(w).upper() if r.random() < 0.2 else "  ".join(w))
    return out[:n]


def test_against_every_pair(spark):
    for seed, cfg in ((1, J.JoinConfig()), (2, J.JoinConfig(words=2, percent=70)), (3, J.JoinConfig(percent=80, lead=2))):
        rows = list(enumerate(texts(seed, 260)))
        rows += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "ONE"), (5, rows[5][1])]
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        got = sorted(tuple(r) for r in J.cluster(df, cfg).collect())
        assert got == sorted(model(rows, cfg))


def test_chains_and_a_hot_group(spark):
    # a chain of neighbours that link though its ends do not, and many near copies
    r = random.Random(4)
    base = [f"c{i}" for i in range(120)]
    rows, w = [], list(base)
    for i in range(40):
        rows.append((i, " ".join(w)))
        w = w[3:] + [f"d{i}x{k}" for k in range(3)]
    hot = [f"h{i}" for i in range(100)]
    for i in range(100, 300):
        v = list(hot)
        v[r.randrange(100)] = f"new{i}"
        rows.append((i, " ".join(v)))
    got = {x.doc_id: x.component_id for x in J.cluster(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = {d: c for d, _, c in model(rows)}
    assert got == want and len(set(want.values())) < 60


def test_candidates_grow_in_proportion(spark, monkeypatch):
    # copies of one text, each with edits of its own: most pairs just below or just above the threshold
    keep, met = J.stored, []
    for module in (J, common):
        monkeypatch.setattr(module, "stored", lambda df, name: (out := keep(df, name), name == "join-pairs" and met.append(out.count()))[0])
    base = [f"c{i}" for i in range(300)]
    for edits in (4, 7):
        counts = {}
        for m in (200, 800):
            r = random.Random(m)
            rows = []
            for i in range(m):
                w = list(base)
                for k in r.sample(range(300), edits if i else 0):
                    w[k] = f"e{i}x{k}"
                rows.append((i, " ".join(w)))
            met.clear()
            got = {x.doc_id: x.component_id for x in J.cluster(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
            counts[m] = sum(met)
            if m == 200:
                assert got == {d: c for d, _, c in model(rows)}
        assert counts[800] <= 6 * counts[200] + 200 and (edits - 4 or counts[200] >= 199), counts


def test_kept_row_is_defined(spark):
    rows = [(1, "A b c d", "en", "s2", 7), (1, "a b c d", "en", "s1", 7), (1, "a b c d", "de", "s3", 7)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        assert [tuple(x) for x in J.deduplicate(df).collect()] == [rows[0]]


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(64)]
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    got = {x.node: x.label for x in J.components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()}
    assert got == {n: m for n, m in label.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_deduplicate_and_odd_rows(spark, odd, none, clashing):
    got = J.cluster(odd)
    assert got.count() == odd.count()
    assert J.cluster(none).count() == 0 and J.deduplicate(none).count() == 0
    assert J.cluster(clashing).count() == odd.count()
    kept = J.deduplicate(clashing)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1                                     # repeated row: one of them
    assert sorted(x for x in ids if x is not None) == [1, 2, 3, 4, 5, 6, 7] and ids.count(None) == 2
    rows = list(enumerate(texts(6, 150)))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = {c for _, _, c in model(rows)}
    assert {r.doc_id for r in J.deduplicate(df).collect()} == want


def test_word_hashes_tell_words_apart():
    words = [f"{a}{b}" for a in "abcdefgh" for b in range(200)] + ["x" * n for n in range(1, 50)]
    _, h = J.word_hashes(__import__("numpy").frombuffer((" ".join(words)).encode() + b" ", "u1"))
    assert len(h) == len(set(words)) == len(set(h.tolist()))
