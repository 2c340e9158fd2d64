"""A corpus pipeline of five operators: judge, remove lines, remove near copies, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's docs. All but the last keep the columns of
documents; n_chars follows the text where a stage rewrites it. What a stage does
with nulls, repeats and empty tables, its operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import bagminhash, lines, mixing, quality, sentencepiece_codec
from gristmill.llm.common import cut


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share, except in the last that holds each."""
    out = lines.drop_lines(docs).select(*docs.columns, "__n_dropped")
    if "n_chars" in docs.columns:
        changed = F.when(F.col("__n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return bagminhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, the last of a source in part."""
    return mixing.materialise(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text, of each row."""
    import public_tokenizers

    return sentencepiece_codec.digests(docs, sentencepiece_codec.load(public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", tokenise),
]

#: The classifier, the signatures and the tokenizer can't be expressed in SQL: tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, name.replace(" ", "_"))
    return docs
