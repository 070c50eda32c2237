"""The corpus pipeline: STAGES are applied to ``documents`` one after another,
each one's rows written to the shared folder as Parquet and read again.

1. quality: documents that the line field rejects (score under 0.3) go.
2. near duplicates: of each class of near copies one document stays.
3. decontamination: passages of ``benchmark`` are cut out of the texts.
4. secrets: secret strings are replaced by a mark.
5. tokens: SentencePiece ids of each text, and what they decode to.

All but the last return the columns of ``documents``; where a stage changes a
text, n_chars follows it. Each stage sees all rows that the one before kept.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sponsorlens.llm import decontaminate, minhash_dedup, quality_crf, secret_scan, sentencepiece_codec
from sponsorlens.llm.common import fresh_name, table, written

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality field, trained on the labels, doesn't reject."""
    score = fresh_name(docs, "quality_score")
    scored = quality_crf.score(docs, quality_crf.fitted(spark, docs, sf_dir), score=score)
    return scored.filter(F.col(score) >= quality_crf.THRESHOLD).select(*docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest id."""
    return minhash_dedup.one_of_each(docs).select(*docs.columns)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that are part of a benchmark passage."""
    cleaned = fresh_name(docs, "cleaned")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), cleaned=cleaned)
    return counted_again(found.drop("text").withColumnRenamed(cleaned, "text"), docs, F.size("word_spans") > 0)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of every secret."""
    spans = fresh_name(docs, "spans")
    return counted_again(secret_scan.redact(secret_scan.scan(docs, spans=spans), spans=spans), docs, F.size(spans) > 0)


def counted_again(changed: DataFrame, docs: DataFrame, where) -> DataFrame:
    """The columns of ``docs``, with n_chars of the texts that changed."""
    n = F.when(where, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return changed.select(*(n.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the ids and the text that they decode to."""
    coded = sentencepiece_codec.encode(docs, MODEL, decoded="decoded")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one_copy),
    ("benchmark decontamination", cut_benchmark),
    ("secret scans", hide_secrets),
    ("SentencePiece encoding and decoding", encode),
]

#: Classifier, signatures and tokenizer have no SQL form; tests/llm tests each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
