"""Removal of repeated passages by per-shard suffix arrays.

A byte goes if some string of ``length`` bytes that covers it also starts anywhere else, in the same
or another text. Strings are judged on the input, and none crosses the end of a text.

1. *Which strings can meet.* Every ``length``-byte window names its least ``GRAM``-byte string by
   hash, the leftmost of equal ones. Equal windows name equal strings, so they meet under its hash.
   Neighbouring windows that name the same place form one passage. Passages whose name occurs
   once in the corpus have no counterpart. Equal passages are counted, and one of them goes on.
2. *Shards.* The passages of a name share a shard of about ``SHARD_BYTES``. A name with too many
   bytes of different passages is spread over several shards.
3. *Suffix arrays.* Each shard sorts the suffixes of its passages by Larsson-Sadakane refinement:
   only groups that are still tied are sorted again, by the rank twice as far on. Kasai's common
   prefixes of neighbours then say which windows occur twice.
4. *Merging across shards.* Windows of a name that is spread over shards go, one for each shard and
   text, to tasks by digest; each shard's sorted run is looked up by binary search in the others'.

Names and equal passages are told by 64-bit hashes, passages by both together, and windows across
shards by 128 bits; windows inside a shard are compared as bytes.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; rows with the
same id, or that are the same in all columns, are separate texts, so repeated rows of at least
``length`` bytes lose all of them; very long texts are read in overlapping pieces, which gives the
same windows; an empty table gives none; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import with_row_key
from ledgerloom.session import release, spool

LENGTH = 200
GRAM = 32
# Bytes of passages in a shard; a name with more than a quarter of it is spread.
SHARD_BYTES = 1 << 20
# Window starts that are looked at together.
PIECE = 1 << 21
# Windows in a task of the merge across shards.
MERGED = 1 << 17
_MULTIPLIERS = ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB),
                (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
_ROW = ["file", "place"]


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position but the last seven, as little-endian numbers."""
    views = np.lib.stride_tricks.as_strided(data, (max(0, len(data) - 7), 8), (1, 1))
    return np.ascontiguousarray(views).view("<u8").ravel()


def string_hashes(data: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``length`` (at least 8) bytes from every position on."""
    a, b, c = (np.uint64(m) for m in _MULTIPLIERS[family])
    values = words_at(data) * a
    values ^= values >> np.uint64(29)
    size = 8
    while size < length:
        step = min(size, length - size)
        values = (values[:-step] * b) ^ (values[step:] * c)
        values ^= values >> np.uint64(31)
        values *= a
        values ^= values >> np.uint64(32)
        size += step
    return values


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:])
        size += step
    return values


def passages(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the passages of one text, and the hash each is named by."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, none
    hashes = string_hashes(data, gram)
    low = np.uint64(32)
    packed = (hashes >> low << low) | np.arange(len(hashes), dtype=np.uint64)
    named = (sliding_min(packed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]]))
    ends = np.concatenate([starts[1:], [len(named)]]) - 1 + length
    return starts, ends, hashes[named[starts]].view(np.int64)


def _occurrences(length: int, gram: int):
    schema = pa.schema([("file", pa.int64()), ("place", pa.int64()), ("start", pa.int64()),
                        ("size", pa.int32()), ("name", pa.int64()), ("content", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in _ROW), batch.column("bytes"))
            parts, held = [], 0
            for file, place, value in rows:
                buffer = value.as_buffer()
                # Pieces overlap by all but one byte of a window: each window is in one piece.
                for offset in range(0, max(1, len(buffer) - length + 1), PIECE):
                    piece = memoryview(buffer)[offset:offset + PIECE + length - 1]
                    starts, ends, names = passages(np.frombuffer(piece, np.uint8), length, gram)
                    if not len(starts):
                        continue
                    contents = [xxhash.xxh3_64_intdigest(piece[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                    n = len(starts)
                    parts.append((np.full(n, file), np.full(n, place), starts + offset,
                                  (ends - starts).astype(np.int32), names,
                                  np.array(contents, np.uint64).view(np.int64)))
                    held += n
                    if held >= PIECE // 16:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)
                        parts, held = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)

    return run


def suffix_array(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes of several strings in order; ``left`` has the bytes from each position to the end
    of its string. Of equal suffixes the one at the smaller position comes first.

    The first order is by seven symbols. Then each group of suffixes that agree in ``depth``
    symbols is ordered by the rank of what follows them, which doubles the depth.
    """
    n = len(data)
    left = left.astype(np.int32)
    one = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
    two = (one[:-1] << np.uint64(9)) | one[1:]
    four = (two[:-2] << np.uint64(18)) | two[2:]
    first = (four[:n] << np.uint64(27)) | (two[4:n + 4] << np.uint64(9)) | one[6:n + 6]
    # Nothing comes behind the end of a string.
    behind = (9 * (7 - np.minimum(left, 7))).astype(np.uint64)
    first = (first >> behind) << behind
    order = np.argsort(first).astype(np.int32)
    slots, at, keys, depth = np.arange(n, dtype=np.int32), order, first[order], 7
    rank = np.empty(n, np.int32)
    while len(keys):
        opens = np.ones(len(keys), bool)
        opens[1:] = keys[1:] != keys[:-1]
        # The rank of a group is its first slot.
        rank[at] = np.maximum.accumulate(np.where(opens, slots, 0))
        # Suffixes that have ended cannot be told apart any more.
        tied = (~(opens & np.append(opens[1:], True))) & (left[at] >= depth)
        slots, at = slots[tied], at[tied]
        behind = np.where(left[at] > depth, rank[np.minimum(at + depth, n - 1)] + 1, 0)
        keys = rank[at].astype(np.int64) * (n + 1) + behind
        by = np.argsort(keys)
        at, keys = at[by], keys[by]
        order[slots] = at
        depth *= 2
    by_rank = rank[order]
    same = np.append(by_rank[1:] == by_rank[:-1], False) if n else np.zeros(0, bool)
    same[1:] |= same[:-1].copy()
    ends = order[same]
    order[same] = ends[np.argsort(rank[ends].astype(np.int64) * (n + 1) + ends)]
    return order


def common_prefixes(data: np.ndarray, left: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kasai's algorithm over many strings at once: for the first ``counts`` positions of the
    strings that begin at ``starts``, the suffix before each in the order (-1: none) and how many
    bytes both share. From one position to the next that number falls by one at most."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    words = words_at(np.concatenate([data, np.zeros(16, np.uint8)]))
    carried = np.zeros(len(starts), np.int64)
    lanes = np.arange(len(starts))
    for t in range(int(counts.max(initial=0))):
        lanes = lanes[counts[lanes] > t]
        at = starts[lanes] + t
        other = before[at]
        have = np.where(other < 0, 0, np.maximum(carried[lanes] - 1, 0))
        most = np.where(other < 0, 0, np.minimum(left[at], left[other]))
        going = np.flatnonzero(have < most)
        while len(going):
            differ = words[at[going] + have[going]] ^ words[other[going] + have[going]]
            lowest = (differ & (~differ + np.uint64(1))).astype(np.float64)
            equal = np.where(differ == 0, 8, (np.frexp(lowest)[1] - 1) // 8)
            have[going] = np.minimum(have[going] + equal, most[going])
            going = going[(equal == 8) & (have[going] < most[going])]
        carried[lanes] = have
        shared[at] = have
    return before, shared


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


_FOUND = ("name long, content long, first int, last int, digest1 long, digest2 long, shard long, known boolean")


def _search(length: int):
    """Repeated windows of a shard's passages, as the bytes ``first`` to ``last`` of a passage; and
    of a name that is spread over shards each different window once, with its digest."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("name", "ascending"), ("content", "ascending")])
        values = table.column("bytes").to_pylist()
        sizes = np.array([len(v) for v in values], np.int64)
        data = np.frombuffer(b"".join(values), np.uint8)
        names, contents, times = (table.column(c).to_numpy() for c in ("name", "content", "times"))
        spread = table.column("spread").to_numpy(zero_copy_only=False).astype(bool)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        passage = np.repeat(np.arange(len(sizes)), sizes)
        left = ends[passage] - np.arange(len(data))
        order = suffix_array(data, left)
        before, shared = common_prefixes(data, left, order, starts, sizes - length + 1)
        repeated = np.repeat(times > 1, sizes) & (left >= length)
        again = np.flatnonzero((shared >= length) & (left >= length))
        repeated[again] = True
        repeated[before[again]] = True
        # Passages end with bytes that start no window, so no run goes from one into the next.
        opens, closes = _runs(repeated)
        p = passage[opens]
        none = np.zeros(len(p), np.int64)
        columns = [names[p], contents[p], opens - starts[p], closes - 1 + length - starts[p], none, none, none,
                   np.ones(len(p), bool)]
        rest = np.flatnonzero(spread[passage] & (left >= length))
        if len(rest):
            # The first of equal windows stands for all of its shard.
            same = shared[order] >= length
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            rest = rest[np.isin(rest, order[np.unique(head)], assume_unique=True)]
            padded = np.concatenate([data, np.zeros(length, np.uint8)])
            digests = [string_hashes(padded, length, f)[rest].view(np.int64) for f in (0, 1)]
            q = passage[rest]
            number = np.full(len(q), xxhash.xxh3_64_intdigest(b"".join(v.tobytes() for v in (names, contents))) >> 1)
            more = [names[q], contents[q], rest - starts[q], rest - starts[q] + length, *digests, number, repeated[rest]]
            # Others of an equal window are in ``columns`` already; what is found elsewhere of a
            # window that is known adds nothing here.
            columns = [np.concatenate([a, b]) for a, b in zip(columns, more)]
            kind = np.concatenate([np.zeros(len(p), bool), np.ones(len(q), bool)])
        else:
            kind = np.zeros(len(p), bool)
        arrays = []
        for i, c in enumerate(columns):
            mask = ~kind if i in (4, 5, 6) else None
            arrays.append(pa.array(c.astype(np.int32) if i in (2, 3) else c, mask=mask))
        return pa.table(arrays, names=["name", "content", "first", "last", "digest1", "digest2", "shard", "known"])

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Windows, not known to be repeated, that another shard has too."""
    shards = table.column("shard").to_numpy()
    digests = np.empty(len(shards), dtype=[("a", np.int64), ("b", np.int64)])
    digests["a"], digests["b"] = (table.column(f"digest{i}").to_numpy() for i in (1, 2))
    order = np.lexsort((digests["b"], digests["a"], shards))
    runs = np.split(order, np.flatnonzero(np.diff(shards[order])) + 1)
    # A shard names a window once, so that a second one in all runs comes from another shard.
    # Digests are numbered in order: one number takes the place of both halves.
    ordered = np.unique(digests, return_inverse=True)[1].ravel()
    everything = np.sort(ordered)
    found = np.zeros(len(shards), bool)
    for run in runs:
        mine = ordered[run]
        found[run] = np.searchsorted(everything, mine, "right") - np.searchsorted(everything, mine, "left") > 1
    known = table.column("known").to_numpy(zero_copy_only=False).astype(bool)
    return table.filter(pa.array(found & ~known)).select(["name", "content", "first", "last"])


def repeated_spans(keyed: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``file``, ``place`` and ``spans``: for each row of ``keyed`` (``file``, ``place``,
    ``bytes``) that has any, the repeated passages as pairs (first byte, byte behind the last),
    not yet united."""
    if length < 16:
        raise ValueError("strings must have 16 bytes at least")
    gram = min(GRAM, length // 2)
    found = spool(
        keyed.mapInArrow(
            _occurrences(length, gram),
            "file long, place long, start long, size int, name long, content long",
        ),
        "passages",
    )
    names = found.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    shared = spool(found.join(names, "name"), "shared-passages")
    release(found)
    # One of equal passages goes on. Written, because sizes and shards must agree.
    first = F.min(F.struct(*_ROW, "start", "size")).alias("first")
    distinct = spool(
        shared.groupBy("name", "content").agg(first, F.count("*").alias("times")).select(
            "name", "content", "first.*", "times"
        ),
        "distinct-passages",
    )
    crowded = spool(
        distinct.groupBy("name").agg(F.sum("size").alias("all")).where(F.col("all") > shard_bytes // 4), "spread-names"
    )
    total = distinct.agg(F.sum("size")).first()[0] or 0
    spread = F.col("all").isNotNull()
    parts = F.when(spread, F.ceil(F.col("all") / shard_bytes)).otherwise(-(-total // shard_bytes) or 1)
    asked = distinct.join(crowded, "name", "left").select(
        *_ROW, "start", "size", "name", "content", "times", spread.alias("spread"),
        # Hashes of the name or the content again, to be free of the least-hash bias of names.
        F.when(spread, F.col("name")).alias("own"),
        F.pmod(F.when(spread, F.xxhash64("content")).otherwise(F.xxhash64("name")), parts).alias("part"),
    )
    per_text = asked.groupBy(*_ROW).agg(
        F.collect_list(F.struct("start", "size", "name", "content", "times", "spread", "own", "part")).alias("asked")
    )
    cut = keyed.join(per_text, _ROW).select(
        F.explode(F.transform("asked", lambda a: F.struct(
            a["name"].alias("name"), a["content"].alias("content"), a["times"].alias("times"),
            a["spread"].alias("spread"), a["own"].alias("own"), a["part"].alias("part"),
            F.substring(F.col("bytes"), a["start"].cast("int") + 1, a["size"]).alias("bytes"),
        ))).alias("a")
    ).select("a.*")
    searched = spool(cut.groupBy("own", "part").applyInArrow(_search(length), _FOUND), "repeated-windows")
    release(distinct, crowded)
    windows = searched.where("digest1 is not null")
    tasks = windows.count() // MERGED + 1
    merged = windows.groupBy(F.pmod("digest1", F.lit(tasks))).applyInArrow(
        _merge, "name long, content long, first int, last int"
    )
    hits = searched.where("digest1 is null").select("name", "content", "first", "last").union(merged)
    per_passage = spool(
        hits.groupBy("name", "content").agg(F.collect_list(F.struct("first", "last")).alias("hits")), "repeated-passages"
    )
    spans = shared.join(per_passage, ["name", "content"]).select(
        *_ROW, F.explode(F.transform("hits", lambda h: F.struct(
            (F.col("start") + h["first"]).alias("first"), (F.col("start") + h["last"]).alias("last")
        ))).alias("span"),
    )
    result = spool(spans.groupBy(*_ROW).agg(F.collect_list("span").alias("spans")), "repeated-spans")
    release(shared, searched, per_passage)
    return result


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, united = [], [], []
        for value, spans in zip(batch.column("bytes"), batch.column("spans").to_pylist()):
            data, at, parts, runs = value.as_py(), 0, [], []
            for span in sorted((s["first"], s["last"]) for s in spans or ()):
                if runs and span[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], span[1])
                else:
                    runs.append([*span])
            for first, last in runs:
                parts.append(data[at:first])
                at = last
            kept.append(b"".join([*parts, data[at:]]))
            removed.append(sum(b - a for a, b in runs))
            united.append([{"first": a, "last": b} for a, b in runs])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(map(len, batch.column("bytes").to_pylist()), pa.int64()),
             pa.array(removed, pa.int64()), pa.array(united, kind), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def without_repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_bytes``, ``n_removed``,
    ``spans`` (the removed runs: first byte, byte behind the last) and ``kept``, the other bytes."""
    keyed, row = with_row_key(docs)
    # The path of a file by its hash: as short as a number, whatever the path.
    keyed = keyed.select(
        "doc_id", F.xxhash64(f"{row}.file_path").alias("file"), F.col(f"{row}.row_index").alias("place"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"),
    )
    spans = repeated_spans(keyed.select("file", "place", "bytes"), length, shard_bytes)
    kind = dict(docs.dtypes)["doc_id"]
    return keyed.join(spans, _ROW, "left").select("doc_id", "bytes", "spans").mapInArrow(
        _cut_out,
        f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<first: bigint, last: bigint>>, kept binary",
    )


def oracle(length: int = LENGTH) -> str:
    digits = 2 * length
    return f"""
WITH hexed AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
    SELECT doc_id, unnest(range(0, length(h) // 2 - {length - 1})) AS s FROM hexed WHERE length(h) >= {digits}
), windows AS (
    SELECT doc_id, s, md5(substr(h, 2 * s + 1, {digits})) AS d FROM starts JOIN hexed USING (doc_id)
), again AS (
    SELECT doc_id, s FROM windows JOIN (SELECT d FROM windows GROUP BY d HAVING count(*) > 1) USING (d)
), breaks AS (
    SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM again
), numbered AS (
    SELECT doc_id, s, sum(CASE WHEN gap <= {length} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM breaks
), spans AS (
    SELECT doc_id, run, min(s) AS a, max(s) + {length} AS b FROM numbered GROUP BY doc_id, run
), pieces AS (
    SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS gone FROM spans
), cut AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
           string_agg(substr(h, 2 * gone + 1, 2 * (a - gone)), '' ORDER BY a) AS head
    FROM pieces JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * tail + 1), h))) AS kept_sha256
FROM hexed LEFT JOIN cut USING (doc_id)
"""
