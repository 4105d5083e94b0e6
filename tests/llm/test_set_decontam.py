import random
import re

import pytest

from pixelflow.llm import set_decontam as D


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def model(docs, items, size=10):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, it in items:
            v = words(it)
            wins = {tuple(v[k:k + size]) for k in range(len(v) - size + 1)} if len(v) >= size else {tuple(v)} if v else set()
            for win in wins:
                for s in range(len(w) - len(win) + 1):
                    if tuple(w[s:s + len(win)]) == win:
                        hit |= set(range(s, s + len(win)))
                        ids |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), len(ids), sorted(ids), bool(hit)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def make(seed, vocab, n_docs=150, n_items=30):
    r = random.Random(seed)
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 2, 3, 4, 5, 6, 9, 10, 11, 14, 30]))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        parts = [text(r.choice([0, 1, 5, 20, 60]))]
        for _ in range(r.choice([0, 0, 1, 2])):
            v = words(r.choice(items)[1])
            a = r.randrange(len(v) + 1)
            parts += [r.choice([" ", ", ", "\n"]).join(v[a:a + r.choice([9, 10, 12, 40])] if r.random() < 0.5 else v).upper(), text(r.choice([0, 0, 7]))]
        docs.append((i, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed,vocab", [(1, [f"w{i}" for i in range(400)]), (2, ["a", "b"]), (3, [f"é{i}" for i in range(12)] + ["x_y", "z-z"])])
def test_against_every_window(spark, seed, vocab):
    docs, items = make(seed, vocab)
    items += [(None, "w1 w2 w3 a b"), (7, items[9][1]), (7, "q r s"), (500, None), (501, " ,;")]
    docs += [(1000, "w1 w2 w3 a b"), (1001, "q R s"), (None, "q-r_s q"), (None, None), (1002, ""), docs[3], docs[3]]
    got = D.scan(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4),
                 spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(got) == model(docs, items)


def test_long_items_only_and_other_sizes(spark):
    docs, items = make(4, [f"w{i}" for i in range(9)])
    items = [x for x in items if len(words(x[1])) >= 10]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert rows(D.scan(d, b)) == model(docs, items)
    assert rows(D.scan(d, b, D.DecontamConfig(window=6, shingle=4))) == model(docs, items, 6)
    with pytest.raises(ValueError):
        D.DecontamConfig(window=11, shingle=5)


def test_one_hash_for_all_is_still_exact(spark, monkeypatch):
    # equal hashes of different shingles: the words decide
    monkeypatch.setattr(D, "_hash", lambda k: D.F.lit(1).cast("long"))
    docs, items = make(5, [f"w{i}" for i in range(5)], 30, 6)
    got = D.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(got) == model(docs, items)


def test_candidates_grow_with_the_copies(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    items = spark.createDataFrame([(i, passage + f" e{i}") for i in range(20)], "item_id bigint, text string")
    wins = D.windows(items, D.DecontamConfig())[0]
    n = {}
    for m in (100, 200, 400):
        docs = spark.createDataFrame([(i, f"x{i} {passage} y{i}") for i in range(m)], "doc_id bigint, text string")
        n[m] = D.occurrences(D.matches(docs, wins, D.DecontamConfig()), wins).count()
    assert n == {m: 31 * m for m in n}


def test_odd_rows(spark, odd, none, clashing):
    items = [(1, "b c d"), (2, "word " * 12), (3, "x" * 60000), (4, "ñandú z")]
    b = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(x.doc_id, x.text) for x in odd.collect() if x.doc_id != 5]
    got = rows(D.scan(clashing, b.selectExpr("*", "1 AS win", "2 AS h", "3 AS n")))
    assert [r for r in got if r[0] != 5] == model(docs, items)
    assert [r for r in got if r[0] == 5] == [(5, 30000, 30000, 1, ["2"], True)]
    assert D.scan(none, b).count() == 0
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r[2:] == (0, 0, [], False) for r in rows(D.scan(odd, empty))) and D.scan(none, empty).count() == 0
