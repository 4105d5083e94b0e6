"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared folder and rereads it for the
next.  All but the last return the columns of documents.  In every stage a null
id is a document like others, repeated rows are rows of their own but for near
duplicates, very long texts count whole, extra columns are dropped, and an
empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelflow.llm import apportion, jaccard_join, pair_bpe, pii_anchor, ppm_langid
from pixelflow.llm.common import scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A text that costs its best language this many bits a byte gains nothing from any model.
REJECT_BITS = 8.0

#: Near duplicates share 0.8 of their five-word shingles.
NEAR = jaccard_join.JoinConfig(words=5, percent=80, lead=3)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; without a letter (or a text), or
    no cheaper to code under any language than as plain bytes, they go.  With
    no labelled text nothing is learned and nothing stays."""
    out = ppm_langid.predict(docs, ppm_langid.train(docs), COLUMNS)
    return out.where((F.col("lang_pred") != ppm_langid.UNKNOWN) & (F.col("bits_per_byte") < REJECT_BITS)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the smallest id
    (null last; rows alike in id and words: the smallest row); documents without
    a word all stay."""
    return jaccard_join.deduplicate(docs, NEAR, COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the mark of its kind; a null text stays
    null (its n_chars, too); no row goes."""
    found = pii_anchor.find(docs, COLUMNS)
    out = found.withColumn("text", pii_anchor.redact(F.col("text"), F.col("spans")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, cut or left out so that sources meet their
    targets; a null source is a source; documents without a word go."""
    return apportion.materialise(docs, columns=COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of each document, and the
    digest of the text they decode to; a null or empty text has no token."""
    path = public_tokenizers.path("word_bpe_49k.json")
    keep = ("doc_id", "lang", "source")
    out = pair_bpe.round_trip(docs, path, keep)
    return out.select(*keep, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mix_sources", mix_sources), ("encode", encode)]

#: Training, components and merges are not SQL; the tests hold each stage against a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:                  # a stage's own tables go when its result is written
            docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
