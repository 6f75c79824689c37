"""Streaming scoring of requests.

Scoring is stateless, so the stream needs no watermark and no shuffle. Delivery to a file sink
is exactly once through the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans import scoring
from ledgerloom.plans.clusters import MEASURES

DEMAND_FIELDS = (*scoring.DEMAND_REQUIRED, *scoring.DEMAND_DEFAULTS)
SEGMENT_FIELDS = MEASURES


def json_requests(
    spark: SparkSession, folder: str, fields: Sequence[str], files_per_batch: int = 1000
) -> DataFrame:
    """Stream of JSON-lines request files arriving in a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return scoring.parse_requests(lines, "value", fields)


def table_requests(
    spark: SparkSession, folder: str, schema, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of Parquet request files arriving in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start_scoring(
    requests: DataFrame,
    score: Callable[[DataFrame, PipelineModel, Sequence[str]], DataFrame],
    model: PipelineModel,
    output: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    fmt: str = "parquet",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write scores of a request stream to ``output``.

    ``score`` is ``score_demand`` or ``score_segment``. The default trigger works off everything
    that has arrived and stops; pass for example ``{"processingTime": "10 seconds"}`` to keep on.
    """
    return (
        score(requests, model, keep)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


OUTCOME = "outcome"


def start_split_scoring(
    requests: DataFrame,
    score: Callable[[DataFrame, PipelineModel, Sequence[str]], DataFrame],
    model: PipelineModel,
    output: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the scores and the refused requests of a stream apart, in one pass over it: to the
    folders ``outcome=scored`` and ``outcome=refused`` of ``output``.

    Both are one sink to Spark, which lists the files of a batch under the batch's number when all
    of them are written; a batch that failed is written again and counts once. Read both through
    ``outcomes``, which goes by those lists.
    """
    refused = F.col("error").isNotNull()
    return (
        score(requests, model, keep)
        .withColumn(OUTCOME, F.when(refused, "refused").otherwise("scored"))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(OUTCOME)
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def outcomes(spark: SparkSession, output: str) -> tuple[DataFrame, DataFrame]:
    """The scores and the refused requests that a stream has written to ``output``."""
    rows = spark.read.parquet(output)
    return tuple(rows.where(F.col(OUTCOME) == kind).drop(OUTCOME) for kind in ("scored", "refused"))
