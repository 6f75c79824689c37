"""Trained models on any file system Spark can write to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ledgerloom.sources import versions


def save_model(model: PipelineModel, path: str) -> None:
    """Replace ``path`` with the model: encoders, scalers, input list and names included."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def publish_model(
    spark: SparkSession, root: str, model: PipelineModel, metrics: dict, inputs: Sequence[str]
) -> versions.Version:
    """The model, encoders included, as a new version of ``root``, together with its ``metrics``
    (plain numbers and texts) and the names of its ``inputs``. It takes the place of the version
    before only when all of it is written."""

    def write(folder: str) -> dict:
        save_model(model, f"{folder}/model")
        return {"metrics": metrics, "inputs": list(inputs)}

    return versions.publish(spark, root, ["model"], write)


def current_model(spark: SparkSession, root: str) -> tuple[PipelineModel, versions.Version]:
    """The latest version's model, read back, and what was stored with it."""
    latest = versions.current(spark, root)
    if latest is None:
        raise FileNotFoundError(f"no model has been published in {root}")
    return load_model(latest.path("model")), latest
