"""Shards of bounded size by extendible hashing, in DataFrame operations only.

The bits of a key's hash lead through a directory: a bucket holds all rows whose hash begins with
its bits, and only a bucket over the byte limit is split on one more bit. As a split never makes a
bucket larger, a row's shard is the shortest prefix of its bits whose bucket fits.

The rows are summed once per cell, a prefix some bits longer than an even spread would need, and
all shorter prefixes are summed from the cells; only rows of cells that are still too large are
looked at again, with more bits. Behind the 60 bits of the key's hash come 60 bits of a row number,
so that rows which repeat a key (or have none) can be spread as well.

Defined results: a null text has no bytes; rows without a key share the hash of the empty text; a
row larger than the limit gets a shard of its own; an empty table gives no rows; extra columns are
kept by ``write_shards`` and left out by ``assign``. Only ids, hashes and sizes are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import unused
from ledgerloom.session import spool

HASH_BITS = 60
_EXTRA_BITS = 6
_ALL_BITS = 2 * HASH_BITS


def key_bits(key: Column) -> Column:
    """The first 60 bits of the key's MD5 as a text of zeros and ones."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), HASH_BITS, "0")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """``cell`` (a bit prefix) and ``depth`` (how many of its bits name the shard).

    ``rows`` has ``bits`` and ``n_bytes``. Cells are disjoint and cover all rows.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    reach = min(_ALL_BITS, math.ceil(math.log2(max(1, total / limit))) + _EXTRA_BITS)
    done, base, open_rows = None, 0, rows
    while True:
        cells = spool(
            open_rows.groupBy(F.substring("bits", 1, reach).alias("cell"))
            .agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n")),
            "cells",
        )
        depths = F.sequence(F.lit(base), F.lit(reach))
        levels = cells.select("*", F.explode(depths).alias("depth")).withColumn(
            "prefix", F.expr("left(cell, depth)")
        )
        fits = (F.sum("n_bytes") <= limit) | (F.sum("n") == 1) | (F.col("depth") == _ALL_BITS)
        # One bucket per prefix; those that fit name the cells below them.
        buckets = levels.groupBy("depth", "prefix").agg(fits.alias("fits")).where("fits")
        named = (
            levels.join(buckets, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))
        )
        named = spool(named, "directory")
        done = named if done is None else done.union(named)
        left = spool(cells.join(named, "cell", "left_anti").select("cell"), "oversized")
        if left.isEmpty():
            return done
        at = reach
        open_rows = open_rows.join(left, F.substring("bits", 1, at) == F.col("cell"), "left_semi")
        base, reach = reach + 1, min(_ALL_BITS, reach + 2 * _EXTRA_BITS)


def assign(
    docs: DataFrame, limit: int, key: str = "doc_id", size: Column | None = None,
    row: Column | None = None,
) -> DataFrame:
    """``key``, ``row``, ``n_bytes``, ``shard`` (its bits; empty if there is one shard only),
    ``shard_bytes`` and ``shard_rows``. ``row`` numbers the rows of ``docs`` in their order."""
    if limit <= 0:
        raise ValueError("the byte limit must be positive")
    size = F.octet_length("text") if size is None else size
    rows = spool(
        docs.select(
            F.col(key), (F.monotonically_increasing_id() if row is None else row).alias("row"),
            F.coalesce(size.cast("long"), F.lit(0)).alias("n_bytes"),
        ),
        "sizes",
    ).withColumn("bits", F.concat(key_bits(F.col(key)), key_bits(F.col("row"))))
    found = directory(rows, limit)
    lengths = [r[0] for r in found.select(F.length("cell")).distinct().collect()]  # one per round
    # Cells of one length are disjoint, so each row meets one cell in all.
    placed = None
    for length in lengths:
        cells = found.where(F.length("cell") == length)
        part = rows.join(cells, F.substring("bits", 1, length) == F.col("cell")).select(
            key, "row", "n_bytes", F.expr("left(cell, depth)").alias("shard")
        )
        placed = part if placed is None else placed.union(part)
    if placed is None:
        placed = rows.select(key, "row", "n_bytes", F.lit("").alias("shard"))
    placed = spool(placed, "placed")
    sums = placed.groupBy("shard").agg(
        F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows")
    )
    return placed.join(sums, "shard").select(key, "row", "n_bytes", "shard", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, limit: int, key: str = "doc_id") -> None:
    """Write ``docs`` as Parquet with one folder per shard, ``shard=0101…``."""
    number, folder = unused(docs, "_row"), unused(docs, "shard")
    numbered = spool(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    shards = assign(numbered, limit, key, row=F.col(number)).select(
        F.col("row").alias(number), F.concat(F.lit("s"), "shard").alias(folder)
    )
    (
        numbered.join(shards, number).drop(number).repartition(folder)
        .write.partitionBy(folder).parquet(path)
    )


def oracle(limit: int) -> str:
    return f"""
WITH rows AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
           lpad(bin(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT), 60, '0') AS bits
    FROM documents
), buckets AS (
    SELECT depth, left(bits, depth) AS prefix, sum(n_bytes) AS shard_bytes, count(*) AS shard_rows
    FROM rows CROSS JOIN range(0, 61) AS depths(depth) GROUP BY 1, 2
), fitting AS (
    SELECT * FROM buckets WHERE shard_bytes <= {limit} OR shard_rows = 1
), chosen AS (
    SELECT doc_id, n_bytes, min_by(prefix, depth) AS shard
    FROM rows JOIN fitting ON prefix = left(bits, depth) GROUP BY doc_id, n_bytes
)
SELECT doc_id, n_bytes, shard, shard_bytes::BIGINT AS shard_bytes, shard_rows
FROM chosen JOIN fitting ON prefix = shard AND depth = length(shard)
"""
