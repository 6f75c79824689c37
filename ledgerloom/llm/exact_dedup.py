"""Exact duplicates by content-defined chunk recipes, in DataFrame operations only.

White space is normalised and every text is cut where its own characters say so, so equal passages
give equal chunks wherever they stand. A chunk is known by its 64-bit hash; the distinct chunk
texts are compared once, and where two texts share a hash, each gets an ordinal, so identifiers are
verified, not assumed. Two texts are equal exactly if their ordered lists of identifiers are. From
there on only the lists move, not the texts.

Defined results: a null text is empty; empty texts are equal to each other; of equal texts the
row with the smallest id stays, one with an id before one without, and of rows with the same id
the first in the table's order; ``keep_id`` is null only if all ids of the group are. Extra
columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import spool

# Chunks end behind five characters whose code points are multiples of three; beyond ASCII and
# Latin-1 the upper bound cuts.
MIN_CHARS, MAX_CHARS, RUN = 512, 8192, 5
_ENDS = "".join(chr(c) for c in [*range(0x61, 0x7B), *range(0xE0, 0x100)] if c % 3 == 0)
CHUNK = (
    rf"(?s).{{{MIN_CHARS},{MAX_CHARS}}}?(?:(?<=[{_ENDS}]{{{RUN}}})|\z)|.{{1,{MAX_CHARS}}}"
)
# Runs of white space that are not already one plain space.
_WHITE = r"[\x09-\x0D][\x09-\x0D ]*| [\x09-\x0D ]+"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _WHITE, " ")


def chunks(text: Column) -> Column:
    """The consecutive chunks of a text; none for an empty one."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def recipes(docs: DataFrame, hashed=chunk_hash, row: str | None = None) -> DataFrame:
    """``doc_id``, ``row``, ``text_sha256`` and ``recipe``, the ordered chunk identifiers."""
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    text = docs.select("doc_id", number.alias("row"), normalised(F.col("text")).alias("text"))
    written = spool(
        text.select(
            "doc_id", "row",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform(chunks(F.col("text")), hashed).alias("recipe"),
        ),
        "recipes",
    )
    # Every distinct chunk text moves once; copies are removed before the shuffle.
    distinct = (
        text.select(F.explode(chunks(F.col("text"))).alias("chunk"))
        .groupBy(hashed(F.col("chunk")).alias("hash"), "chunk").agg(F.lit(1).alias("one"))
    )
    shared = spool(distinct.groupBy("hash").agg(F.sum("one").alias("n")).where("n > 1"), "shared-hashes")
    if shared.isEmpty():
        return written
    # Texts that share a hash: number them, and put (hash, number) in place of the hash.
    same_hash = Window.partitionBy("hash").orderBy("chunk")
    numbers = (
        distinct.join(shared, "hash", "left_semi")
        .select("hash", "chunk", F.row_number().over(same_hash).alias("number"))
    )
    numbered = spool(text, "numbered-texts")
    placed = (
        numbered.select("row", F.posexplode(chunks(F.col("text"))).alias("at", "chunk"))
        .withColumn("hash", hashed(F.col("chunk")))
        .join(numbers, ["hash", "chunk"], "left")
        .withColumn("number", F.coalesce("number", F.lit(0)))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "hash", "number"))).alias("all"))
        .select("row", F.transform("all", lambda c: F.struct(c.hash, c.number)).alias("ids"))
    )
    none = F.array().cast("array<struct<hash:bigint,number:int>>")
    return numbered.join(placed, "row", "left").select(
        "doc_id", "row", F.sha2("text", 256).alias("text_sha256"),
        F.coalesce(F.col("ids").cast("array<struct<hash:bigint,number:int>>"), none).alias("recipe"),
    )


def duplicates(docs: DataFrame, hashed=chunk_hash, row: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text, with ``row``, the
    column of that name or else the row's number in the table's order."""
    listed = recipes(docs, hashed, row)
    groups = listed.groupBy("recipe").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"),
        F.count("*").alias("group_size"),
    )
    # Written, so that both sides of the join are dealt for it and a large group can be split.
    groups = spool(groups, "copy-groups")
    return listed.join(groups, "recipe").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256", "row",
    )


ORACLE = r"""
WITH normal AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), sized AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM normal JOIN sized USING (text_sha256)
"""
