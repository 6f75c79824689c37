"""Near duplicates by SimHash fingerprints, pigeonhole blocks and connected components.

A fingerprint has 64 bits: a bit is set if it is set in over half of the hashes of a text's word
shingles. Two fingerprints that differ in at most ``max_bits`` bits must agree on all but
``max_bits`` of the ``blocks`` blocks they are cut into, so every close pair meets in the bucket of
some choice of blocks; pairs that meet are verified by their Hamming distance.

Equal fingerprints are one node, whatever the number of their documents. A bucket of up to
``PAIRS_UP_TO`` nodes is compared pair by pair. In a larger bucket that would be quadratic, so
there each node names all fingerprints within half the distance of its own, and nodes that name
the same one are linked to the smallest of them: they are that close by construction, and any two
close nodes name a common one. No link is lost and no bucket is expanded into all its pairs. For an
odd distance, half is rounded up and the links are verified one by one.

Defined results: a null text is empty; texts without words have fingerprint zero and are linked
like any other; a text with fewer words than a shingle is one shingle; repeated shingles count
each time; a null id never becomes a component id unless all ids of the component are null;
repeated rows each get their row. Extra columns are left out (``components``) or kept
(``fingerprint``).
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spool

BLOCKS = 5
PAIRS_UP_TO = 24
_HASHED_AT_ONCE = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def text_fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """64-bit SimHash of a text as a signed number."""
    # bytes.split() cuts at exactly the space and \t \n \v \f \r.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-1]]
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], seed) for a, b in zip(starts, ends[shingle - 1:])]
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _HASHED_AT_ONCE):
        some = np.array(hashes[i:i + _HASHED_AT_ONCE], dtype="<u8").view(np.uint8)
        bits = np.unpackbits(some, bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    value = sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """SimHash of a text column as ``long``."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([text_fingerprint(t, shingle, seed) for t in texts.to_pylist()], pa.int64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "long")(text)


def hex16(value: Column) -> Column:
    """The 16 lowercase hex digits of a ``long``."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _block_masks(blocks: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [sum(1 << bit for bit in range(a, b)) for a, b in zip(cuts, cuts[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def close_links(nodes: DataFrame, max_bits: int = 2, blocks: int = BLOCKS, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Links ``a`` < ``b`` whose components are those of all pairs within ``max_bits``.

    ``nodes`` has distinct fingerprints in ``fp``.
    """
    if max_bits == 0:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    if not 0 < max_bits < blocks <= 64:
        raise ValueError("there must be more blocks than differing bits")
    masks = _block_masks(blocks)
    keys = [
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(sum(c)))).alias("part"))
        for i, c in enumerate(combinations(masks, blocks - max_bits))
    ]
    met = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = met.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    crowds = spool(met.join(sizes, "key").select("fp", "key", "n"), "simhash-buckets")

    few = (
        crowds.where(F.col("n") <= pairs_up_to)
        .groupBy("key").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
        .select("fps", F.explode("fps").alias("a"))
        .select("a", F.explode(F.filter("fps", lambda b: _close(F.col("a"), b, max_bits))).alias("b"))
    )
    flips = [0]
    for n in range(1, (max_bits + 1) // 2 + 1):
        flips += [_signed(sum(1 << i for i in c)) for c in combinations(range(64), n)]
    named = (
        crowds.where(F.col("n") > pairs_up_to).select("fp").distinct()
        .select("fp", F.explode(F.transform(F.lit(flips), lambda m: F.col("fp").bitwiseXOR(m))).alias("hub"))
    )
    if max_bits % 2 == 0:
        # At most one node per flip names a hub, so these groups are small.
        many = (
            named.groupBy("hub").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps"))
            .select("a", F.explode("fps").alias("b")).where("a < b")
        )
    else:
        many = (
            named.groupBy("hub").agg(F.collect_list("fp").alias("fps"))
            .select("fps", F.explode("fps").alias("a"))
            .select("a", F.explode(F.filter("fps", lambda b: _close(F.col("a"), b, max_bits))).alias("b"))
        )
    return few.union(many).distinct()


def _close(a: Column, b: Column, max_bits: int) -> Column:
    return (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= max_bits)


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for all nodes of ``links``.

    Alternates two steps until nothing changes: every node links its larger neighbours to the
    smallest it knows, then every node links its smaller neighbours to the smallest of them.
    Both keep components and never add links, and the number of rounds grows with the logarithm
    of the longest chain. Each round is written to the shared folder.
    """
    edges = spool(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u < v"), "links")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()
        )
        # Now every node has its smaller neighbours only; link them to the smallest.
        smallest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(smallest, "v").select(F.explode(F.array(
                F.struct(F.col("m").alias("u"), F.col("u").alias("v")),
                F.struct(F.col("m").alias("u"), F.col("v").alias("v")),
            )).alias("e")).select("e.*").where("u < v").distinct()
        )
        new = spool(small, "links")
        # Finished when every node hangs directly on a root: no node is both child and parent,
        # and no child has two parents.
        state = new.agg(F.count("*").alias("n"), F.count_distinct("v").alias("children")).first()
        flat = new.join(new.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()
        edges = new
        if state.n == state.children and flat:
            break
    roots = edges.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)


def _rooted(
    docs: DataFrame, shingle: int, max_bits: int, blocks: int, pairs_up_to: int, row: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows with ``fp``; and for every ``fp`` its ``least`` id and its component's ``root``."""
    marked = spool(
        docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp"), *row), "simhash"
    )
    nodes = spool(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    links = close_links(nodes.select("fp"), max_bits, blocks, pairs_up_to)
    roots = spool(connected(links).withColumnRenamed("node", "fp"), "simhash-roots")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return marked, placed


def components(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, blocks: int = BLOCKS,
    pairs_up_to: int = PAIRS_UP_TO,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id that links reach."""
    marked, placed = _rooted(docs, shingle, max_bits, blocks, pairs_up_to, [])
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    names = placed.join(named, "root").select("fp", "component_id")
    return marked.join(names, "fp").select("doc_id", "fp", "component_id")


def surplus(
    docs: DataFrame, row: str, shingle: int = 3, max_bits: int = 2, blocks: int = BLOCKS,
    pairs_up_to: int = PAIRS_UP_TO,
) -> DataFrame:
    """Values of ``row``, which tells the rows of ``docs`` apart, of all rows but one of each
    component: the one with the smallest id stays, rows without an id come last."""
    marked, placed = _rooted(docs, shingle, max_bits, blocks, pairs_up_to, [row])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(row).alias("row"))).alias("first")
    per_fp = marked.groupBy("fp").agg(first)
    stays = (
        per_fp.join(placed.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias(row))
    )
    return marked.select(row).join(stays, row, "left_anti")
