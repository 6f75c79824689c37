"""Processed tables: run the ETL, store, read back, register in SQL, export."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators import orders as op
from ledgerloom.plans import etl, rfm
from ledgerloom.sources import versions

# The master table is stored by month, so that a query for a period reads only that period.
PARTITION_COLUMNS = {"master": ["year", "month"]}


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace ``path`` with the table.

    A partitioned write is first rebalanced on its partition columns: AQE gathers each month
    into few files and splits a month that holds much of the data over several tasks.
    """
    writer = df
    if partition_by:
        writer = df.hint("rebalance", *[F.col(c) for c in partition_by])
    out = writer.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        out = out.option("header", True).option("escape", '"')
    out.save(path)


def read_table(
    spark: SparkSession, folder: str, name: str, fmt: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """A stored table, of the latest version if ``folder`` has versions. CSV files carry no types:
    give their ``schema``, or get text columns."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    latest = versions.current(spark, folder)
    return reader.load(latest.path(name) if latest and name in latest.names else f"{folder}/{name}")


def write_processed(
    tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet"
) -> None:
    for name, df in tables.items():
        partition_by = PARTITION_COLUMNS.get(name, []) if fmt == "parquet" else []
        write_table(df, f"{folder}/{name}", fmt, partition_by)


def _delivered(found: Observation, seconds: float = 60.0) -> dict:
    """The counts of a finished query, which arrive a little after it; no waiting for ever."""
    until = time.monotonic() + seconds
    while not found._jo.future().isCompleted():
        if time.monotonic() > until:
            raise RuntimeError("Spark has not delivered the counts of a finished query")
        time.sleep(0.02)
    return found.get


PROCESSED = ("orders", "items", "payments", "master", "rfm")


class EtlRun(dict):
    """The stored tables by name. ``version`` says where they lie, ``record`` what the passes that
    built them counted: rows and rows without a key of each raw table, rows stored, and
    ``duplicate_customers``, the orders that a repeated customer id has multiplied."""

    def __init__(self, stored: Mapping[str, DataFrame], version: versions.Version):
        super().__init__(stored)
        self.version, self.record = version, version.details["record"]


def run_etl(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, ties: str = "value"
) -> EtlRun:
    """Build and store the five processed tables and return them read back. ``ties``: how the
    customer scores treat equal order counts.

    The tables become a new version of ``folder`` together, when the last of them is written: until
    then, and after a failure, readers see the version before.

    Orders, items and payments are written first, at the same time, as separate Spark jobs that
    fill executors left idle by the tail of another job's stages. The master table is built from
    what they wrote, and the customer scores from the master table, so every raw table is read and
    every per-order sum computed once.
    """
    record: dict[str, int] = {}

    def write(place: str) -> dict:
        seen: dict[str, Observation] = {}

        def counted(name: str, df: DataFrame, key: str | None = None) -> DataFrame:
            seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")  # no other run's
            counts = [F.count(F.lit(1)).alias("rows")]
            if key:
                counts.append(F.count_if(F.col(key).isNull()).alias("without_key"))
            return df.observe(seen[name], *counts)

        first = {
            "orders": op.delivered_orders(counted("raw_orders", tables["orders"], "order_id")),
            "items": op.item_totals(counted("raw_items", tables["order_items"], "order_id")),
            "payments": op.payments_per_order(counted("raw_payments", tables["order_payments"], "order_id")),
        }
        first = {name: counted(name, df) for name, df in first.items()}
        run = inheritable_thread_target(spark)
        with ThreadPoolExecutor(len(first)) as pool:
            jobs = [pool.submit(run(write_processed), {name: df}, place) for name, df in first.items()]
            for job in jobs:
                job.result()
        stored = {name: read_table(spark, place, name) for name in first}
        master = etl.assemble(
            stored["orders"], op.items_per_order(stored["items"]), stored["payments"],
            op.reviews_per_order(counted("raw_reviews", tables["order_reviews"], "order_id")),
            counted("raw_customers", tables["customers"], "customer_id"),
        )
        write_processed({"master": counted("master", master)}, place)
        scores = rfm.score_by_quartiles(rfm.rfm_base(read_table(spark, place, "master")), ties)
        write_processed({"rfm": counted("rfm", scores)}, place)
        for name, found in seen.items():
            record.update({f"{name}_{what}": n for what, n in _delivered(found).items()})
        record["duplicate_customers"] = record["master_rows"] - record["orders_rows"]
        return {"record": record}

    version = versions.publish(spark, folder, list(PROCESSED), write)
    return EtlRun({name: read_table(spark, folder, name) for name in PROCESSED}, version)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def register_external(
    spark: SparkSession, folder: str, names: Sequence[str], database: str = "processed"
) -> None:
    """The stored tables of ``folder`` as SQL tables, where they lie: no data is written, and months
    are found as partitions. Called again it follows a new version and finds new months; what
    is dropped before is the entry of the catalog only."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    latest = versions.current(spark, folder)
    for name in names:
        path = latest.path(name) if latest and name in latest.names else f"{folder}/{name}"
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{quoted}'")
        if PARTITION_COLUMNS.get(name):
            spark.catalog.recoverPartitions(f"{database}.{name}")


def save_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    database: str = "processed",
    buckets: int | None = None,
) -> None:
    """Store the tables in a SQL database, so that ``SELECT … FROM processed.master`` works.

    With ``buckets``, tables with an ``order_id`` are bucketed and sorted by it; later joins
    between them then need no shuffle.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format("parquet")
        if buckets and "order_id" in df.columns:
            # A bucketed table is read by order; its files are not also split by month.
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        elif set(PARTITION_COLUMNS.get(name, [])) & set(df.columns):
            months = PARTITION_COLUMNS[name]
            rebalanced = df.hint("rebalance", *[F.col(c) for c in months])
            writer = rebalanced.write.mode("overwrite").format("parquet").partitionBy(*months)
        writer.saveAsTable(f"{database}.{name}")


def write_report(df: DataFrame, path: str) -> None:
    """A small result as one CSV file with a header. Not for tables of unknown size."""
    write_table(df.coalesce(1), path, "csv")


def write_export(df: DataFrame, path: str) -> None:
    """A result of any size as CSV files with headers."""
    write_table(df, path, "csv")
