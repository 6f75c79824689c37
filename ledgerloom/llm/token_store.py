"""Token ids as raw binary shards with a minimal perfect hash index.

``write`` encodes a table and leaves, in a shared folder,

* shards ``shard-*.bin``: a 32-byte header and then the ids of all documents of one id range, in
  ascending id order, each document ended by ``end_id``, as little-endian unsigned integers of 2
  bytes (4 if the vocabulary needs them);
* index parts ``index-*.idx``: a minimal perfect hash over the keys of one part, and for each
  slot a stored fingerprint, the shard, the offset and the number of ids;
* two Parquet tables that name the shards and the index parts that count. A task that is run
  again writes a file under a new name, and only the file its committed row names is read.

A look-up hashes the key to its part and slot, compares the fingerprint (a key that was never
stored passes with probability 2^-32) and reads one range of one shard.

Defined results: a null text is empty and stored as ``end_id`` alone; null ids come first;
rows that repeat an id are stored one after another, ordered by a hash of their text, and are
told apart by ``occurrence`` (0, 1, …); an empty table gives a store without shards. Only the id
and text columns are read, whatever other columns there are.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.perfect_hash import Keys, PerfectHash, part_of
from ledgerloom.llm.pieces import SplittingEncoder
from ledgerloom.session import scratch_root

KEYS_PER_PART = 250_000
MAGIC = b"TOKSHARD"
HEADER = "<8sIIQQ"  # magic, bytes per id, end id, ids in the vocabulary, reserved
HEADER_BYTES = struct.calcsize(HEADER)
RECORD = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u4")])

_CATALOG = "shard int, row long, doc_id long, occurrence long, offset long, n_tokens long, file string"


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pyarrow.fs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class TokenStore:
    """Where a store lies, and how many index parts it has (0: no documents)."""

    root: str
    parts: int

    def catalog(self, spark: SparkSession) -> DataFrame:
        """One row per stored document, in shard order by ``row``."""
        return spark.read.parquet(f"{self.root}/catalog")

    def shards(self, spark: SparkSession) -> DataFrame:
        """``shard``, ``file``, ``ids`` and ``first_id`` (ids in all shards before it)."""
        shards = self.catalog(spark).groupBy("shard").agg(
            F.max("file").alias("file"), F.sum("n_tokens").alias("ids")
        )
        # One row per shard, not per document.
        earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        return shards.withColumn("first_id", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))

    def index(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/index")


# ---- writing ------------------------------------------------------------------------------------

def write(docs: DataFrame, tokenizer: str, end_id: int, root: str | None = None) -> TokenStore:
    """Encode ``text`` of ``docs`` with the tokenizers-library file ``tokenizer`` and store it."""
    spark = docs.sparkSession
    root = root or f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    ids = max(end_id, *_all_ids(definition)) + 1
    width = 2 if ids <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast(definition)
    files, path = _open(root)
    files.create_dir(path, recursive=True)

    def write_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.bin"
        files, path = _open(root)
        encoder, kind = _encoder(shared), np.dtype(f"<u{width}")
        end = np.array([end_id], kind).tobytes()
        out, rows, offset = None, 0, 0
        last, seen = object(), 0
        for batch in batches:
            if out is None:
                out = files.open_output_stream(f"{path}/{name}")
                out.write(struct.pack(HEADER, MAGIC, width, end_id, ids, 0))
            keys, counts, occurrences = batch.column(0).to_pylist(), [], []
            for key, text in zip(keys, batch.column(1).to_pylist()):
                payload = encoder.encode(text, kind)
                out.write(payload)
                out.write(end)
                counts.append(len(payload) // width + 1)
                seen = seen + 1 if key == last else 0
                last = key
                occurrences.append(seen)
            offsets = offset + np.cumsum([0, *counts])
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, shard, np.int32)),
                    pa.array(np.arange(rows, rows + n)),
                    pa.array(keys, pa.int64()),
                    pa.array(occurrences, pa.int64()),
                    pa.array(offsets[:-1].astype(np.int64)),
                    pa.array(counts, pa.int64()),
                    pa.array([name] * n),
                ],
                names=["shard", "row", "doc_id", "occurrence", "offset", "n_tokens", "file"],
            )
            rows, offset = rows + n, int(offsets[-1])
        if out is not None:
            out.close()

    # By range of ids; the hash of the text spreads an id (or null) that very many rows share.
    ordered = (
        docs.select(
            F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
            F.xxhash64("text").alias("_text"),
        )
        .repartitionByRange("doc_id", "_text")
        .sortWithinPartitions("doc_id", "_text")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(write_shard, _CATALOG).write.parquet(f"{root}/written")
    _number_repeats(spark, root)
    catalog = spark.read.parquet(f"{root}/catalog")
    rows = catalog.count()
    parts = -(-rows // KEYS_PER_PART)
    if parts:
        _index(catalog, root, parts)
    return TokenStore(root, parts)


def _all_ids(definition: str) -> list[int]:
    spec = json.loads(definition)
    return [0, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]


_encoders: dict = {}


def _encoder(shared) -> SplittingEncoder:
    """One encoder per Python worker and vocabulary."""
    key = hash(shared.value)
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders.clear()
        _encoders[key] = SplittingEncoder(shared.value)
    return _encoders[key]


def _number_repeats(spark: SparkSession, root: str) -> None:
    """``occurrence`` counts within a shard so far; add those of earlier shards to an id that
    goes on from one shard to the next."""
    written = spark.read.parquet(f"{root}/written")
    edges = written.groupBy("shard").agg(
        F.min_by("doc_id", "row").alias("first"), F.max_by("doc_id", "row").alias("last")
    )
    before = F.lag(F.struct("last")).over(Window.orderBy("shard"))  # one row per shard
    carried = (
        edges.withColumn("_before", before)
        .where(F.col("_before").isNotNull() & F.col("first").eqNullSafe(F.col("_before.last")))
        .select(F.col("first").alias("_id")).distinct()
    )
    if not carried.isEmpty():
        same = written.doc_id.eqNullSafe(F.col("_id"))
        per_shard = (
            written.join(carried, same, "left_semi").groupBy("doc_id", "shard").agg(F.count("*").alias("n"))
        )
        earlier = Window.partitionBy("doc_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        base = per_shard.select(
            F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"),
            F.sum("n").over(earlier).alias("_base"),
        )
        columns = written.columns
        written = (
            written.join(base, same & (written.shard == F.col("_shard")), "left")
            .withColumn("occurrence", F.col("occurrence") + F.coalesce("_base", F.lit(0)))
            .select(columns)
        )
    written.write.parquet(f"{root}/catalog")


def _part(parts: int):
    return F.pmod(F.xxhash64("doc_id", "occurrence"), F.lit(parts)).cast("int")


def _keys(frame: pd.DataFrame) -> Keys:
    is_null = frame["doc_id"].isna().to_numpy()
    return Keys(frame["doc_id"].fillna(0).to_numpy(), is_null, frame["occurrence"].to_numpy())


def _index(catalog: DataFrame, root: str, parts: int) -> None:
    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = _keys(rows)
        table = PerfectHash.build(keys)
        records = np.zeros(len(rows), dtype=RECORD)
        slots = table.slots(keys)
        for field, values in (
            ("fingerprint", keys.fingerprints()), ("shard", rows["shard"]),
            ("offset", rows["offset"]), ("n", rows["n_tokens"]),
        ):
            records[field][slots] = values
        name = f"index-{key[0]:06d}-{uuid.uuid4().hex}.idx"
        files, path = _open(root)
        with files.open_output_stream(f"{path}/{name}") as out:
            out.write(struct.pack("<QQQ", len(table.sizes), len(table.words), len(records)))
            for block in (table.sizes, table.words, records):
                out.write(block.tobytes())
        return pd.DataFrame({"part": [key[0]], "index_file": [name], "keys": [len(rows)]})

    # Ids may be null; a float column would round large ones, so nulls travel as text.
    columns = catalog.select("doc_id", "occurrence", "shard", "offset", "n_tokens", _part(parts).alias("part"))
    (
        columns.withColumns({"is_null": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})
        .groupBy("part")
        .applyInPandas(
            lambda key, rows: build(key, _with_nulls(rows)), "part int, index_file string, keys long"
        )
        .write.parquet(f"{root}/index")
    )


def _with_nulls(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.assign(doc_id=rows["doc_id"].astype("Int64").mask(rows["is_null"]))


# ---- reading ------------------------------------------------------------------------------------

class IndexPart:
    """One index part in memory."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str):
        with files.open_input_file(path) as file:
            levels, words, records = struct.unpack("<QQQ", file.read(24))
            sizes = np.frombuffer(file.read(8 * levels), "<u8")
            bits = np.frombuffer(file.read(8 * words), "<u8")
            self.records = np.frombuffer(file.read(RECORD.itemsize * records), RECORD)
        self.table = PerfectHash(sizes, bits)

    def find(self, keys: Keys) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are stored, and the records of those."""
        slots = self.table.slots(keys)
        found = slots >= 0
        found[found] = self.records["fingerprint"][slots[found]] == keys.fingerprints()[found]
        return found, self.records[slots[found]]


def look_up(spark: SparkSession, store: TokenStore, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``occurrence``, ``shard``, ``offset`` and ``n_tokens`` of the stored keys.

    ``keys`` has ``doc_id`` and ``occurrence``; keys that are not stored give no row.
    """
    schema = "doc_id long, occurrence long, shard int, offset long, n_tokens long"
    if not store.parts:
        return spark.createDataFrame([], schema)
    root = store.root

    def find(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = _with_nulls(rows)
        files, path = _open(root)
        found, records = IndexPart(files, f"{path}/{key[0]}").find(_keys(rows))
        return rows.loc[found, ["doc_id", "occurrence"]].assign(
            shard=records["shard"].astype(np.int32), offset=records["offset"].astype(np.int64),
            n_tokens=records["n"].astype(np.int64),
        )

    index = store.index(spark).select("part", "index_file")
    placed = keys.select(
        F.col("doc_id").cast("long"), F.col("occurrence").cast("long"),
        F.col("doc_id").isNull().alias("is_null"),
    ).withColumn("part", _part(store.parts)).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    return (
        placed.join(index, "part").drop("part").groupBy("index_file").applyInPandas(find, schema)
    )


def read(spark: SparkSession, store: TokenStore, places: DataFrame, with_ids: bool = True) -> DataFrame:
    """Read the documents that ``look_up`` found from their shards.

    Adds ``start`` (ids before the document in the whole store), ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers) and, if asked for, ``ids`` (``array<long>``).
    """
    root = store.root
    schema = "doc_id long, occurrence long, start long, n_tokens long, ids_crc32 long"
    schema += ", shard int, offset long" + ", ids array<long>" * with_ids

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path = _open(root)
        name, file, width = None, None, 0
        for rows in batches:
            sums, ids = [], []
            for at, n, wanted in zip(rows["offset"], rows["n_tokens"], rows["file"]):
                if wanted != name:
                    if file is not None:
                        file.close()
                    name, file = wanted, files.open_input_file(f"{path}/{wanted}")
                    magic, width, *_ = struct.unpack(HEADER, file.read_at(HEADER_BYTES, 0))
                    if magic != MAGIC:
                        raise ValueError(f"{wanted} is not a token shard")
                raw = file.read_at(int(n) * width, HEADER_BYTES + int(at) * width)
                tokens = np.frombuffer(raw, f"<u{width}")
                sums.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                if with_ids:
                    ids.append(tokens.astype(np.int64))
            rows = rows.assign(ids_crc32=sums, doc_id=rows["doc_id"].astype("Int64").mask(rows["is_null"]))
            yield (rows.assign(ids=ids) if with_ids else rows)[
                [c.split()[0] for c in schema.split(", ")]
            ]
        if file is not None:
            file.close()

    shards = store.shards(spark).select("shard", "file", "first_id")
    return (
        places.join(shards, "shard")
        .withColumn("start", F.col("first_id") + F.col("offset"))
        .withColumns({"is_null": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})
        .repartitionByRange("start")  # neighbours in a shard are read by one task
        .sortWithinPartitions("start")
        .mapInPandas(fetch, schema)
    )


class TokenReader:
    """Keyed access to one document at a time, from one process and without Spark jobs."""

    def __init__(self, spark: SparkSession, store: TokenStore):
        self._store = store
        self._files, self._path = _open(store.root)
        # One short row per index part and per shard.
        self._parts = {r.part: r.index_file for r in store.index(spark).collect()} if store.parts else {}
        self._shards = {r.shard: r.file for r in store.shards(spark).collect()} if store.parts else {}
        self._loaded: dict[int, IndexPart] = {}

    def get(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """Ids of a stored document with its end id, or None."""
        if not self._store.parts:
            return None
        part = part_of(doc_id, occurrence, self._store.parts)
        if part not in self._parts:
            return None
        if part not in self._loaded:
            self._loaded[part] = IndexPart(self._files, f"{self._path}/{self._parts[part]}")
        key = Keys(np.array([doc_id or 0]), np.array([doc_id is None]), np.array([occurrence]))
        found, records = self._loaded[part].find(key)
        if not found[0]:
            return None
        record = records[0]
        with self._files.open_input_file(f"{self._path}/{self._shards[int(record['shard'])]}") as file:
            _, width, *_ = struct.unpack(HEADER, file.read_at(HEADER_BYTES, 0))
            raw = file.read_at(int(record["n"]) * width, HEADER_BYTES + int(record["offset"]) * width)
        return np.frombuffer(raw, f"<u{width}")
