"""The operators on the test tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe, chat_format, decontaminate, exact_dedup, filter_audit, hard_negatives, quality, sharding, simhash,
    suffix_dedup, token_store, toxicity, url_filter,
)
from ledgerloom.llm.common import documents, fold, table, prepare
from ledgerloom.session import spool

Query = Callable[[SparkSession, str], DataFrame]

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
END_OF_DOCUMENT = 1
SHARD_BYTES = 1 << 20
THRESHOLD = 0.3
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2
QUALITY_FOLDS, QUALITY_HELD_OUT = 5, 0
URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    store = token_store.write(docs, public_tokenizers.path(WORD_VOCABULARY), END_OF_DOCUMENT)
    # Every stored key is asked for: each id, as often as it occurs.
    times = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    keys = times.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("occurrence"))
    places = token_store.look_up(spark, store, keys)
    stored = token_store.read(spark, store, places, with_ids=False)
    return stored.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset")


def op2_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), SHARD_BYTES).drop("row")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The formatted text is written, read back, and digested turn by turn."""
    said = "</s>[INST] ok [/INST]"
    added = spark.sql(
        "SELECT -1L AS conv_id, turn, role, text FROM VALUES (0L, 'user', :said), (1L, 'assistant', :said) "
        "AS t(turn, role, text)", args={"said": said},
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    formatted = spool(chat_format.format_conversations(rows), "chat")
    turns = F.col("turns")
    whole = F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    learnt = F.array_join(F.transform(F.filter(turns, lambda t: t.learnt), lambda t: t.text), "")
    size = F.length("formatted").cast("long")
    starts = size - F.length(F.replace(F.col("formatted"), F.lit(chat_format.START), F.lit("")))
    return chat_format.parse(formatted).select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        size.alias("formatted_chars"),
        (starts / len(chat_format.START)).cast("long").alias("n_blocks"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(BYTE_VOCABULARY))
    encoded = documents(spark, sf_dir).select("doc_id", vocabulary.encode(F.col("text")).alias("ids"))
    return encoded.select("doc_id", "ids", vocabulary.decode(F.col("ids")).alias("decoded")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _scored(docs: DataFrame, score: str, folds: int, held_out: int, **more: str) -> DataFrame:
    return docs.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= THRESHOLD).cast("int").alias("predicted"),
        *(F.col(column).alias(name) for name, column in more.items()),
    )


def learning_rows(spark: SparkSession, sf_dir: str, label: str, folds: int, held_out: int) -> DataFrame:
    """``doc_id`` and ``label`` of the labelled rows outside the held-out fold."""
    return table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label")).where(
        fold(F.col("doc_id"), folds) != held_out
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    labels = learning_rows(spark, sf_dir, "toxic", TOXIC_FOLDS, TOXIC_HELD_OUT)
    model = toxicity.learn(docs, labels)
    judged = model.score(docs, evidence=True)
    return _scored(judged, "toxicity", TOXIC_FOLDS, TOXIC_HELD_OUT, nearest="nearest.doc_id", evidence="evidence.doc_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(documents(spark, sf_dir)).drop("row")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    labels = learning_rows(spark, sf_dir, "quality", QUALITY_FOLDS, QUALITY_HELD_OUT)
    model = quality.learn(docs, labels)
    return _scored(model.score(docs), "quality", QUALITY_FOLDS, QUALITY_HELD_OUT)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash.components(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.drop("url")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    clean = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return clean.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some labels are changed first, so that near vectors may have different ones."""
    prepare(spark)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_store, op2_extendible_shards, op3_decontaminate, op4_chat_format, op5_bpe, op6_toxicity,
        op7_exact_dedup, op8_quality, op9_simhash, op10_url_filter, op11_suffix_dedup, op12_filter_audit,
        op13_hard_negatives, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op2_extendible_shards": sharding.oracle(SHARD_BYTES),
    "op3_decontaminate": decontaminate.ORACLE,
    "op4_chat_format": chat_format.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op10_url_filter": url_filter.oracle(URL_RULES),
    "op11_suffix_dedup": suffix_dedup.oracle(),
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
