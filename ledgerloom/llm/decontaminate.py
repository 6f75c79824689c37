"""Benchmark passages in documents, by a prefix-filtered set join.

Every benchmark item gives windows of ``window`` words (one shorter window if it has fewer). A
window is contained in a document only if all its shingles are, so one necessary shingle, its
prefix, is enough to find it: the rarest one, by counts over the whole corpus. The join of document
shingles with these prefixes gives candidates; the length of the document and the position of the
shingle in window and document bound where the window can start, and the words there are compared
one by one.

Distinct (window, item) pairs are dealt into blocks of bounded size by their hash. A block is sent
to all tasks, and the documents are passed over once to count its shingles and once to match, so a
benchmark of any size is compared with all documents and nothing else is shuffled.

Defined results: a null text has no words; an item without words has no windows; rows that repeat
an item id are one item; windows of items without an id are hits but no items; repeated document
rows each get their row; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spool

WINDOW = 10
SHINGLE = 3
LINKS_PER_BLOCK = 500_000
_CANDIDATES_AT_ONCE = 1 << 18

# Bytes of words after lower-casing; everything else separates. Bytes over 127 belong to
# characters beyond ASCII, which are all word characters.
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct ``window`` (its words joined by spaces) and ``item_id`` (text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    found.append(b" ".join(words[i:i + window]).decode())
                    ids.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(ids, pa.string())], names=["window", "item_id"]
            )

    ids = items.select(F.col("item_id").cast("string"), "text")
    return ids.mapInArrow(cut, "window string, item_id string").distinct()


class Block:
    """Windows of one block as numbers, with their shingles; small enough for every task."""

    def __init__(self, links: list[tuple[str, str | None]], window: int, shingle: int):
        texts = sorted({w for w, _ in links})
        number = {w: i for i, w in enumerate(texts)}
        split = [w.encode().split() for w in texts]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({x for s in split for x in s}))}
        self.lengths = np.array([len(s) for s in split], dtype=np.int64)
        self.words = np.zeros((len(split), window), dtype=np.int64)
        for i, s in enumerate(split):
            self.words[i, :len(s)] = [self.vocabulary[x] for x in s]
        pairs = sorted({(number[w], item) for w, item in links if item is not None})
        self.items = [item for _, item in pairs]
        self.item_starts = np.searchsorted([w for w, _ in pairs], np.arange(len(texts) + 1))
        # Shingles are short numbers: of windows shorter than a shingle, the whole window.
        self.base = len(self.vocabulary) + 1
        self.sizes = sorted({min(shingle, int(n)) for n in self.lengths})
        self.shingle = shingle
        owners, places, codes, sizes = [], [], [], []
        for size in self.sizes:
            of_size = np.flatnonzero(np.minimum(self.lengths, shingle) == size)
            for place in range(window - size + 1):
                mine = of_size[self.lengths[of_size] >= place + size]
                owners.append(mine)
                places.append(np.full(len(mine), place))
                sizes.append(np.full(len(mine), size))
                codes.append(self._code(self.words[mine, place:place + size].T))
        self.owner, self.place, self.size, self.code = (
            np.concatenate([np.zeros(0, np.int64), *x]) for x in (owners, places, sizes, codes)
        )
        self.known = {s: np.unique(self.code[self.size == s]) for s in self.sizes}

    def _code(self, columns) -> np.ndarray:
        code = np.zeros(len(columns[0]), dtype=np.int64)
        with np.errstate(over="ignore"):  # equal words give equal codes; matches are verified
            for column in columns:
                code = code * self.base + column
        return code

    def codes(self, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and codes of all runs of ``size`` known words."""
        n = len(ids) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids[:n] > 0
        for k in range(1, size):
            known = known & (ids[k:n + k] > 0)
        at = np.flatnonzero(known)
        return at, self._code([ids[at + k] for k in range(size)])

    def with_prefixes(self, counts: dict[tuple[int, int], int]) -> Block:
        """Choose each window's rarest shingle, the first of equally rare ones."""
        count = np.array([counts.get((int(s), int(c)), 0) for s, c in zip(self.size, self.code)], dtype=np.int64)
        order = np.lexsort((self.place, count, self.owner))
        first = order[np.unique(self.owner[order], return_index=True)[1]]
        self.prefixes = {}
        for size in self.sizes:
            mine = first[self.size[first] == size]
            mine = mine[np.argsort(self.code[mine], kind="stable")]
            self.prefixes[size] = (self.code[mine], self.owner[mine], self.place[mine])
        return self

    def matches(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and numbers of all windows in ``ids``; ``ends``: for each position, where its
        document ends."""
        starts, windows = [], []
        for size in self.sizes:
            codes, owners, places = self.prefixes[size]
            at, found = self.codes(ids, size)
            low, high = np.searchsorted(codes, found), np.searchsorted(codes, found, side="right")
            hit = np.flatnonzero(high > low)
            cuts = np.cumsum(high[hit] - low[hit]) // _CANDIDATES_AT_ONCE
            for some in np.split(hit, np.flatnonzero(np.diff(cuts)) + 1):
                n = high[some] - low[some]
                row = np.repeat(low[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                position = np.repeat(at[some], n)
                start, window = position - places[row], owners[row]
                length = self.lengths[window]
                # The window must lie between the shingle's document's ends.
                fits = (start >= 0) & (start + length <= ends[position])
                start, window, length = start[fits], window[fits], length[fits]
                for k in range(self.words.shape[1]):
                    inside = k < length
                    word = ids[np.where(inside, start + k, 0)] if len(ids) else start
                    same = ~inside | (word == self.words[window, k])
                    start, window, length = start[same], window[same], length[same]
                starts.append(start)
                windows.append(window)
        return np.concatenate([np.zeros(0, np.int64), *starts]), np.concatenate([np.zeros(0, np.int64), *windows])


def _numbers(block: Block, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts (0: not in the block), a 0 behind each; and their word counts."""
    get = block.vocabulary.get
    ids: list[int] = []
    counts = []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        ids.extend([get(w, 0) for w in words])
        ids.append(0)
    return np.array(ids, dtype=np.int64), np.array(counts, dtype=np.int64)


def _count_shingles(docs: DataFrame, block) -> dict[tuple[int, int], int]:
    """How often each shingle of the block occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        sums = {s: np.zeros(len(own.known[s]), np.int64) for s in own.sizes}
        for batch in batches:
            ids, _ = _numbers(own, batch.column(0).to_pylist())
            for size, known in own.known.items():
                _, codes = own.codes(ids, size)
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                sums[size] += np.bincount(at[known[at] == codes], minlength=len(known))
        for size, known in own.known.items():
            seen = sums[size] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(seen.sum(), size)), pa.array(known[seen]), pa.array(sums[size][seen])],
                names=["size", "code", "n"],
            )

    counted = docs.select("text").mapInArrow(count, "size long, code long, n long")
    # At most the shingles of one block.
    rows = counted.groupBy("size", "code").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r["code"]): r["n"] for r in rows}


_MATCHED = (
    "doc_id long, text_key binary, n_words long, hits array<struct<start:int,end:int>>, items array<string>"
)


def _match(docs: DataFrame, block) -> DataFrame:
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        for batch in batches:
            ids, counts = _numbers(own, batch.column(2).to_pylist())
            first = np.concatenate([[0], np.cumsum(counts + 1)])
            ends = np.repeat(first[1:] - 1, counts + 1)
            starts, windows = own.matches(ids, ends)
            # Words under any window, as runs.
            change = np.zeros(len(ids) + 1, np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + own.lengths[windows], -1)
            under = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
            opens = np.flatnonzero(~under[:-1] & under[1:])
            closes = np.flatnonzero(under[:-1] & ~under[1:])
            doc = np.searchsorted(first, opens, side="right") - 1
            runs = pa.StructArray.from_arrays(
                [pa.array((opens - first[doc]).astype(np.int32)), pa.array((closes - first[doc]).astype(np.int32))],
                names=["start", "end"],
            )
            hits = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc, np.arange(len(counts) + 1)).astype(np.int32)), runs
            )
            found = np.unique(np.stack([np.searchsorted(first, starts, side="right") - 1, windows]), axis=1)
            items: list[list[str]] = [[] for _ in counts]
            for d, w in found.T.tolist():
                items[d].extend(own.items[own.item_starts[w]:own.item_starts[w + 1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts), hits,
                 pa.array([sorted(set(i)) for i in items], pa.list_(pa.string()))],
                names=["doc_id", "text_key", "n_words", "hits", "items"],
            )

    return docs.mapInArrow(match, _MATCHED)


def merged(hits: Column) -> Column:
    """Sum of the lengths of the union of word ranges."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("upto"))
    return F.aggregate(
        F.array_sort(hits), start,
        lambda acc, h: F.struct(
            (acc["sum"] + F.greatest(F.lit(0), h["end"] - F.greatest(h["start"], acc["upto"]))).alias("sum"),
            F.greatest(acc["upto"], h["end"]).alias("upto"),
        ),
        lambda acc: acc["sum"].cast("long"),
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, links_per_block: int = LINKS_PER_BLOCK,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``, ``hits`` (word ranges under
    windows, ends excluded; several blocks may give ranges that overlap) and ``items`` (sorted ids
    of the benchmark items with windows in the document, as text)."""
    spark = docs.sparkSession
    links = spool(item_windows(items, window), "item-windows")
    blocks = max(1, -(-links.count() // links_per_block))
    # Rows are told apart by id and text; rows equal in both have equal results.
    several = blocks > 1
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)) if several else F.lit(None).cast("binary")
    keyed = docs.select(F.col("doc_id").cast("long"), key.alias("text_key"), "text")
    result = None
    for number in range(blocks):
        own = links.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == number)
        block = Block([(r.window, r.item_id) for r in own.collect()], window, shingle)  # bounded
        counts = _count_shingles(docs, spark.sparkContext.broadcast(block))
        matched = _match(keyed, spark.sparkContext.broadcast(block.with_prefixes(counts)))
        if result is None:
            result = matched
            continue
        more = spool(
            matched.where(F.size("hits") > 0).dropDuplicates(["doc_id", "text_key"]), "block-hits"
        ).select(
            F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"),
            F.col("hits").alias("_hits"), F.col("items").alias("_items"),
        )
        same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
        result = spool(
            result.join(more, same, "left").select(
                "doc_id", "text_key", "n_words",
                F.concat("hits", F.coalesce("_hits", F.array().cast("array<struct<start:int,end:int>>"))).alias("hits"),
                F.array_sort(F.array_union("items", F.coalesce("_items", F.array().cast("array<string>")))).alias("items"),
            ),
            "hits-so-far",
        )
    return result.select("doc_id", "n_words", merged(F.col("hits")).alias("n_hit"), "hits", "items")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                 links_per_block: int = LINKS_PER_BLOCK, name: str = "contaminated") -> DataFrame:
    """``docs`` with all its columns and the boolean ``name``: a window of an item is in the text."""
    spark = docs.sparkSession
    links = spool(item_windows(items, window), "item-windows")
    blocks = max(1, -(-links.count() // links_per_block))
    marked = docs.withColumn(name, F.lit(False))
    for number in range(blocks):
        own = links.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == number)
        block = Block([(r.window, r.item_id) for r in own.collect()], window, shingle)
        counts = _count_shingles(docs, spark.sparkContext.broadcast(block))
        shared = spark.sparkContext.broadcast(block.with_prefixes(counts))
        marked = marked.withColumn(name, F.col(name) | _has_window(shared)(F.col("text")))
    return marked


def _has_window(block):
    def run(texts: pa.Array) -> pa.Array:
        own = block.value
        ids, counts = _numbers(own, texts.to_pylist())
        first = np.concatenate([[0], np.cumsum(counts + 1)])
        starts, _ = own.matches(ids, np.repeat(first[1:] - 1, counts + 1))
        found = np.zeros(len(counts), dtype=bool)
        found[np.searchsorted(first, starts, side="right") - 1] = True
        return pa.array(found)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "boolean")


ORACLE = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS size,
           array_to_string(list_slice(words, pos, pos + least(10, len(words)) - 1), ' ') AS said
    FROM item_words, range(1, greatest(1, len(words) - 9) + 1) AS r(pos) WHERE len(words) > 0
), sizes AS (
    SELECT DISTINCT size FROM windows
), spans AS (
    SELECT doc_id, pos, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS said
    FROM doc_words, sizes, range(1, len(words) + 1) AS r(pos) WHERE pos + size - 1 <= len(words)
), found AS (
    SELECT doc_id, pos, size, item_id FROM spans JOIN windows USING (said, size)
), hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT DISTINCT doc_id, pos, size FROM found), range(pos, pos + size) AS r(word) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
