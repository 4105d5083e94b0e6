import random
from collections import Counter

from pyspark.sql import functions as F

from pixelflow.llm import quality_ledger as Q


def repeat_words(ws):
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    return len({i + k for i, g in enumerate(grams) if g in twice for k in range(3)})


def test_measurements():
    r = random.Random(3)
    for _ in range(400):
        ws = [r.choice("abcd") for _ in range(r.randint(0, 30))]
        assert Q.repeat_words(ws) == repeat_words(ws)
    assert Q.measure("a #b\n\na #b\n \nx y 12") == (6, 11, 2, 3, 1, 0, 2)   # U+00A0 is part of a word
    assert Q.measure(None) == Q.measure("") == (0,) * 7
    assert Q.measure("a\x1cb c")[0] == 1          # only the six white-space characters separate words


def test_ledger_and_policies(spark, odd, none, clashing):
    clean = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(80))
    df = spark.createDataFrame([(1, clean), (2, "a b " * 60), (3, "w# " * 60), (4, "short text")], "doc_id bigint, text string")
    led = Q.ledger(df).withColumn("kept", Q.passes(Q.STRICT)).withColumn("base", Q.passes(Q.BASE))
    got = {r.doc_id: r for r in led.collect()}
    assert got[1].kept and got[1].base
    assert not got[2].base and not got[3].kept and not got[4].base
    assert got[4].fail_bits == Q.BIT["few_words"]
    assert Q.ledger(odd).count() == odd.count() and Q.ledger(none).count() == 0 and Q.ledger(clashing).count() == odd.count()
    assert {r.fail_bits & 1 for r in Q.ledger(odd).where("n_words < 50").collect()} == {1}


def test_ablations_match_a_direct_count(spark):
    r = random.Random(4)
    bits = [r.randrange(64) for _ in range(500)]
    led = spark.createDataFrame([(b, 10) for b in bits], "fail_bits bigint, n_words bigint")
    for row in Q.ablations(led, Q.STRICT).collect():
        bit = Q.BIT[row.rule]
        rest = Q.STRICT.mask & ~bit
        assert row.n_fail == sum(b & bit > 0 for b in bits)
        assert row.n_only == sum(b & Q.STRICT.mask == bit for b in bits)
        assert row.n_kept_without == sum(b & rest == 0 for b in bits)
    assert Q.ablations(led.where(F.lit(False)), Q.BASE).count() == 2
