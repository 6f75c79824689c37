"""A cleaning pipeline over ``documents``: each stage is written and read again before the next.

Null and empty texts are texts like any other; rows are told apart by their place in the files, so
repeated rows, ids and nulls are handled; all columns are kept until the last stage; an empty
table passes through. The last stage returns each document's token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontaminate, exact_dedup, quality, simhash
from ledgerloom.llm.common import prepare, table, unused, with_row_key
from ledgerloom.llm.queries import (
    BYTE_VOCABULARY, QUALITY_FOLDS, QUALITY_HELD_OUT, THRESHOLD, learning_rows,
)
from ledgerloom.session import spool


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    prepare(spark)
    labels = learning_rows(spark, sf_dir, "quality", QUALITY_FOLDS, QUALITY_HELD_OUT)
    model = quality.learn(docs.select("doc_id", "text"), labels)
    score = unused(docs, "_quality")
    return model.score(docs, score).where(F.col(score) >= THRESHOLD).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    keyed, row = with_row_key(docs)
    marked = exact_dedup.duplicates(keyed.select("doc_id", "text", row), row=row)
    dropped = marked.where(~F.col("kept")).select(F.col("row").alias(row))
    return keyed.join(dropped, row, "left_anti").drop(row)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints, the document with the smallest id stays."""
    prepare(spark)
    keyed, row = with_row_key(docs)
    return keyed.join(simhash.surplus(keyed.select("doc_id", "text", row), row), row, "left_anti").drop(row)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of a benchmark item."""
    prepare(spark)
    name = unused(docs, "_contaminated")
    marked = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), name=name)
    return marked.where(~F.col(name)).drop(name)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether decoding them gives the text again (null: the empty text)."""
    prepare(spark)
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(BYTE_VOCABULARY))
    text = F.coalesce("text", F.lit(""))
    ids = docs.select("doc_id", text.alias("text"), vocabulary.encode(text).alias("ids"))
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (vocabulary.decode(F.col("ids")) == F.col("text")).alias("round_trip"),
    )


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_text),
    ("encode", encode),
]

# Two stages use a fitted model and a vocabulary, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spool(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
