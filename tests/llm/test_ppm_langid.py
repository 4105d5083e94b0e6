import math
import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pixelflow.llm import ppm_langid as P


def bits(train, raw):
    """The code length by definition."""
    tree = defaultdict(Counter)
    for t in train:
        b = t.encode()
        for k in range(4):
            for i in range(len(b) - k):
                tree[b[i:i + k]][b[i + k]] += 1
    total = 0.0
    for i, c in enumerate(raw):
        for k in range(min(3, i), -1, -1):
            q = tree.get(raw[i - k:i])
            if not q:
                continue
            n, d = sum(q.values()), len(q)
            if c in q:
                total -= math.log2(q[c] / (n + d))
                break
            total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_by_definition():
    r = random.Random(1)
    train = {"aa": ["the cat and the dog, then the hen", "a b c"], "bb": ["öä über die küche", "und dann"], "cc": ["x"]}
    for block in (8, 64, 1 << 16):
        m = P.PpmModel(train, P.PpmConfig(block_bytes=block))
        texts = ["".join(r.choice("the catöäübdn zq\x01") for _ in range(r.randint(1, 80))) for _ in range(40)] + ["e", "th", "the", "über"]
        for t, (lang, score, per) in zip(texts, m.predict(texts)):
            if not any(map(str.isalpha, t)):
                assert lang == "und"
                continue
            want = {k: bits(v, t.encode()) for k, v in train.items()}
            assert abs(per * len(t.encode()) - min(want.values())) < 1e-3 * max(1, min(want.values()))
            assert want[lang] <= min(want.values()) + 1e-3 and 0 < score <= 1


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = P.predict(d, P.train(d), ("doc_id", "lang")).where(P.held_out(F.col("doc_id"))).collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_training_reads_only_the_fold_and_the_bound(spark):
    rows = [(i, f"text number {i} " * 20, "en" if i % 3 else "de", "s", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = P.training_texts(df, P.PpmConfig(train_bytes=2000))
    assert set(got) == {"en", "de"}
    for lang, texts in got.items():
        sizes = [len(t.encode()) for t in texts]
        assert sum(sizes[:-1]) < 2000
        for t in texts:
            assert zlib.crc32(t.split()[2].encode()) % 4 != 2


def test_a_language_of_one_long_document_is_learned(spark):
    long = "gwl yr ñandú 𝄞 " * 300000                   # about 5 MB
    for i in (1, 5, 6, 10, 12):
        if zlib.crc32(str(i).encode()) % 4 == 2:
            continue
        rows = [(i, long, "cy")] + [(100 + k, f"the text number {k} " * 50, "en") for k in range(200)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        got = P.training_texts(df, P.PpmConfig(train_bytes=10007))
        assert set(got) == {"cy", "en"}
        for texts in got.values():
            assert 10000 <= sum(len(t.encode()) for t in texts) <= 10007
        assert long.startswith(got["cy"][0])


def test_training_takes_the_smallest_hashes(spark):
    rows = [(i, "a" * (1 + i * 37 % 400), "en") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    hashed = df.where(~P.held_out(F.col("doc_id"))).select("text", F.xxhash64("doc_id", "text").alias("h")).collect()
    order = [r.text for r in sorted(hashed, key=lambda r: (r.h % 2 ** 64, r.text))]
    for bound in (1, 500, 3000, 20000, 10 ** 6):
        want, left = [], bound
        for t in order:
            if left > 0:
                want.append(t[:left])
                left -= len(t)
        assert P.training_texts(df, P.PpmConfig(train_bytes=bound)).get("en") == want


def test_odd_rows(odd, none, clashing):
    m = P.train(odd)
    rows = P.predict(odd, m, ("doc_id", "text")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1
    assert P.predict(none, P.train(none)).count() == 0
    assert {r.lang_pred for r in P.predict(odd, P.train(none)).collect()} == {"und"}
    assert P.predict(clashing, P.train(clashing)).count() == odd.count()
