"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the library is designed for. AQE merges small shuffle partitions, splits
# skewed join partitions and turns a join into a broadcast only after it has seen the real size.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # No stack capture per Python expression; halves the time to build a large plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Paths of spooled tables by application.
_spooled: dict[str, list[str]] = {}


def build_session(
    app_name: str = "ledgerloom", master: str | None = None, **extra: str
) -> SparkSession:
    """Create (or reuse) a session with the library's settings; ``extra`` keys win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for spooled tables: the cluster's checkpoint folder.

    Only a local session without that setting gets a folder of its own. On a cluster a
    machine-local folder would vanish with its machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="ledgerloom-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir()


def spool(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several later steps need the same aggregated table, or where row placement must
    not change if a task is re-run. Unlike a cached frame it survives the loss of executors, and
    unlike an RDD checkpoint it keeps column pruning, filter push-down and file sizes, so that
    Spark knows how large the table is when it picks a join. Removed when the driver exits, or
    earlier by ``clear_spools``.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(spark, path)
    _spooled.setdefault(spark.sparkContext.applicationId, []).append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._spooled_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete spooled tables that nothing reads any more, and let Spark drop the shuffle files of
    frames that are gone, so that a long job holds on disk only what its next steps read."""
    for table in tables:
        spark, path = table.sparkSession, table._spooled_at
        mine = _spooled.get(spark.sparkContext.applicationId, [])
        if path in mine:
            mine.remove(path)
        files, place = hadoop_path(spark, path)
        files.delete(place, True)
    gc.collect()
    for spark in {t.sparkSession for t in tables}:
        spark._jvm.System.gc()


def clear_spools(spark: SparkSession, after: int = 0) -> int:
    """Delete this application's spooled tables but the first ``after`` and return their number.
    DataFrames built on those tables can no longer be read."""
    mine = _spooled.get(spark.sparkContext.applicationId, [])
    paths = mine[after:]
    del mine[after:]
    for path in paths:
        files, place = hadoop_path(spark, path)
        files.delete(place, True)
    return len(paths)


@contextlib.contextmanager
def spools(spark: SparkSession):
    """Delete on leaving what was spooled inside; results must have been written by then."""
    before = len(_spooled.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        clear_spools(spark, before)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    files, place = hadoop_path(spark, path)
    files.deleteOnExit(place)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    return place.getFileSystem(configuration), place
