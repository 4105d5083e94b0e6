import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from pixelflow.llm import apportion, pii_anchor
from pixelflow.llm.common import stored, table
from test_jaccard_join import sets

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    first = stored(C.language_id(spark, docs, SF), "t")
    assert first.count() == docs.count() and first.columns == docs.columns      # clean documents stay
    rows = {r.doc_id: r.text for r in first.collect()}

    second = stored(C.near_duplicates(spark, first, SF), "t")
    s = {i: sets(t, 5) for i, t in rows.items()}
    root = {i: i for i in s}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in s:
        for b in s:
            both = len(s[a] & s[b]) if b < a else 0
            if both and 100 * both >= 80 * (len(s[a]) + len(s[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id for r in second.collect()} == {find(a) for a in s} and second.columns == docs.columns

    third = stored(C.personal_data(spark, second, SF), "t")
    for r in third.collect():
        spans, text = pii_anchor.spans(rows[r.doc_id]), rows[r.doc_id]
        assert bool(spans) == (r.text != text) and r.n_chars == len(r.text)
        assert not any(k < pii_anchor.N_BASE for k, _, _ in pii_anchor.spans(r.text))

    fourth = stored(C.mix_sources(spark, third, SF), "t")
    plan = {r.doc_id: r.taken for r in apportion.mix(third).collect()}
    got = {r.doc_id: r.w for r in fourth.groupBy("doc_id").agg(F.sum(apportion.n_words(F.col("text"))).alias("w")).collect()}
    assert got == {i: n for i, n in plan.items() if n} and fourth.columns == docs.columns

    last = C.encode(spark, fourth, SF).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = sorted(np.array(t.encode(r.text, add_special_tokens=False).ids, "<u4").tobytes() for r in fourth.collect())
    assert sorted(bytes(r.ids) for r in last) == texts and all(r.n_tokens == len(r.ids) // 4 for r in last)


def test_odd_rows_through_every_stage(spark, odd, none, clashing):
    for df in (odd, none, clashing):
        for _, stage in C.STAGES[:-1]:
            df = stored(stage(spark, df, SF), "t")
            assert df.columns == list(C.COLUMNS)
        C.encode(spark, df, SF).count()


def test_run(spark):
    out = C.run(spark, SF)
    assert out.count() > 0 and "n_tokens" in out.columns
