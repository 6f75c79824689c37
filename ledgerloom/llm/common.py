"""What several operators of this subpackage share."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import spool

# Rows sent to a Python worker at once. The engine's default of 10,000 is meant for narrow rows;
# with texts of up to a megabyte it would not fit a worker's memory.
TEXTS_PER_BATCH = "512"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches for this session, unless the user has chosen a size, and this library
    on the import path of Python workers that run where it is installed."""
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, TEXTS_PER_BATCH)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; all other characters stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart and stays the same when they are read
    again: path of the file and position in it. What is not read from files is written first."""
    name = unused(docs, "_row")
    key = F.struct("_metadata.file_path", "_metadata.row_index").alias(name)
    try:
        return docs.select("*", key), name
    except AnalysisException:
        return spool(docs, "rows").select("*", key), name
