"""Raw CSV tables: scan a folder, apply types, land copies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.session import hadoop_path


def table_name(path: str) -> str:
    stem = PurePosixPath(path).stem
    return stem.replace(schemas.RAW_FILE_PREFIX, "").replace(schemas.RAW_FILE_SUFFIX, "")


def list_csv(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The CSV tables of a folder: single files, and folders of part files, by table name."""
    files, place = hadoop_path(spark, folder)
    found: dict[str, list[str]] = {}
    for entry in files.listStatus(place):
        path = entry.getPath().toString()
        if entry.isDirectory() or path.endswith(".csv"):
            found.setdefault(table_name(path), []).append(path)
    return {name: sorted(paths) for name, paths in sorted(found.items())}


def _text_of(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All columns as text. A folder's part files must share one header; Spark compares it."""
    options = {
        "header": True, "quote": '"', "escape": '"', "enforceSchema": False,
        "multiLine": table in schemas.MULTI_LINE_TABLES, "pathGlobFilter": "*.csv",
    }
    columns = spark.read.csv(path, **options).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, **options)


def read_text(spark: SparkSession, paths: str | Sequence[str], table: str) -> DataFrame:
    """One raw table as text, its files put together by column name; a column that only some of
    them have is null in the others."""
    paths = [paths] if isinstance(paths, str) else paths
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [_text_of(spark, path, table) for path in paths],
    )


def typed(text: DataFrame, table: str) -> DataFrame:
    """A value that does not fit its column's type becomes null."""
    types = schemas.RAW_TYPES.get(table, {})
    return text.select(
        [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in text.columns]
    )


def read_csv(spark: SparkSession, paths: str | Sequence[str], table: str) -> DataFrame:
    """One raw table with its types."""
    return typed(read_text(spark, paths, table), table)


def scan_text(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every CSV table in the folder as text, keyed by table name."""
    return {name: read_text(spark, paths, name) for name, paths in list_csv(spark, folder).items()}


def load_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every CSV table in the folder with its types."""
    return {name: typed(text, name) for name, text in scan_text(spark, folder).items()}


def load_known(
    spark: SparkSession, folder: str, tables: Iterable[str] = tuple(schemas.RAW_TYPES)
) -> dict[str, DataFrame]:
    """The known tables by their fixed file names; a missing file is an error."""
    pattern = f"{folder}/{schemas.RAW_FILE_PREFIX}{{}}{schemas.RAW_FILE_SUFFIX}.csv"
    return {name: read_csv(spark, pattern.format(name), name) for name in tables}


def land_raw(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """Write each raw table, as ``scan_text`` gives it, unchanged under ``folder``, replacing an
    earlier landing. ``load_raw`` reads a CSV landing."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.save(f"{folder}/{name}")
