"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements
and one failure bit per rule.  Policies are versioned masks over the bits, so
a new policy or an ablation never reads the texts again: a document passes a
policy when ``bits & mask = 0``, and ablations are bitwise aggregations over
the distinct bit patterns.

Nulls and edges: a null or empty text has no words (all counts 0) and fails
the ``few_words`` rule; ids are carried unread (null and repeated ids are
fine); an empty table gives an empty ledger; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pixelflow.llm.common import map_batches

#: The white space between words, and the symbols that are counted.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_digits")


def repeat_words(words: list) -> int:
    """Words inside 3-word windows found twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered, end = 0, 0            # words before ``end`` are counted
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of :data:`MEASURES`."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()     # ASCII white space
    seen, n_lines, dup = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            n_lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)),
            n_lines, dup, repeat_words(words), sum(map(text.count, "0123456789")))


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: str          # SQL condition over the measurements


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", 2, "100 * n_symbols > 60 * n_words"),
    Rule("duplicate_lines", 3, "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", 4, "word_chars > 15 * n_words or 2 * n_words > word_chars"),
    Rule("many_digits", 5, "100 * n_digits > 30 * word_chars"),
)
BIT = {r.name: 1 << r.bit for r in RULES}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
STRICT = Policy("strict-1", tuple(r.name for r in RULES))


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the measurements and ``fail_bits`` per document."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{m} bigint" for m in MEASURES])
    names = [f.name for f in fields]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t.as_py()) for t in b.column("text")]
        cols = list(zip(*rows)) if rows else [()] * len(MEASURES)
        return pa.RecordBatch.from_arrays(
            [b.column(n) for n in names] + [pa.array(c, pa.int64()) for c in cols], names + list(MEASURES))
    out = map_batches(docs.select(*names, "text"), batch, schema)
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES), F.lit(0))
    return out.withColumn("fail_bits", bits.cast("long"))


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0


def patterns(led: DataFrame) -> DataFrame:
    """(fail_bits, n_docs, n_words): at most 2 ** rules rows, whatever the corpus."""
    return led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_words").alias("n_words"))


def ablations(led: DataFrame, policy: Policy) -> DataFrame:
    """One row per rule of ``policy``: documents failing it, failing only it
    (what dropping the rule would bring back) and kept by the policy without
    it; and ``any_bits``, the bits that ever occur together with it."""
    pat = patterns(led)
    parts = None
    for r in RULES:
        if not policy.mask >> r.bit & 1:
            continue
        bit, rest = 1 << r.bit, policy.mask & ~(1 << r.bit)
        has = F.col("fail_bits").bitwiseAND(F.lit(bit)) != 0
        others = F.col("fail_bits").bitwiseAND(F.lit(rest)) != 0
        count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n_docs"))), F.lit(0)).alias
        one = pat.agg(count(has)("n_fail"), count(has & ~others)("n_only"), count(~others)("n_kept_without"),
                      F.coalesce(F.bit_or(F.when(has, F.col("fail_bits"))), F.lit(0)).alias("any_bits"))
        one = one.select(F.lit(policy.version).alias("policy"), F.lit(r.name).alias("rule"), "*")
        parts = one if parts is None else parts.unionByName(one)
    return parts
