"""Quality by positive-unlabelled learning with the non-negative risk.

Texts become a few dozen numbers that do not depend on language: shares of character classes,
word lengths, repetition. A logistic model is fitted to trusted positives and to all documents as
the unlabelled mixture. With the class prior ``pi``, the risk of calling documents negative is
estimated without any negative example, as the risk on the mixture less ``pi`` times that on the
positives, and that difference is kept from falling below zero. With the logistic loss the risk
is convex until that bound is met, so a few Newton steps suffice, each a sum over all documents;
only sums reach the driver. The step size is the one of least non-negative risk.

The class prior is the share of positives in the labelled rows that may be learnt from. Rows
labelled negative serve for nothing else.

Defined results: a null text is empty; texts without words get the features zero and a score like
any other; without positives, or with positives only, every score is the prior (one half if there
are no labels); labels that are null are no labels, an id labelled twice is positive if one of
its labels is. Extra columns of the documents are kept by ``score``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import unused
from ledgerloom.session import spool

STEPS = 12
STEP_SIZES = (1.0, 0.5, 0.25, 0.1, 0.02)
RIDGE = 1e-3
FEATURES = 20
_TOLERANCE = 1e-5


def _classes() -> np.ndarray:
    """One row per character class, over the 256 byte values."""
    rows = np.zeros((9, 256))
    rows[0, 65:91] = 1  # capitals
    rows[1, 97:123] = 1  # small letters
    rows[1, 128:192] = 1  # roughly one per character beyond ASCII
    rows[2, 48:58] = 1  # digits
    rows[3, [ord(c) for c in "|"]] = 1
    rows[4, [ord(c) for c in "!?"]] = 1
    rows[5, [ord(c) for c in ".,;:"]] = 1
    rows[6, [ord(c) for c in "#$%&*+-/<=>@\\^_`~()[]{}\"'"]] = 1
    rows[7, [9, 10, 11, 12, 13]] = 1  # line ends and tabs
    rows[8, 32] = 1
    return rows


_CLASS = _classes()


def text_features(text: str | None) -> list[float]:
    """Numbers that describe how a text is written, not what it is about."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * FEATURES
    counts = _CLASS @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / len(raw)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:])) / n
    lines = raw.split(b"\n")
    letters = counts[0] + counts[1] + 1
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n
    return [
        *share.tolist(),
        counts[0] / letters,
        math.log1p(n),
        float(lengths.mean()) / 10,
        float(lengths.std()) / 10,
        float((lengths > 20).mean()),
        float((lengths < 2).mean()),
        distinct / n,
        math.log(distinct + 1) / math.log(n + 1),
        same,
        marked,
        len(set(lines)) / len(lines),
    ]


def features(text: Column) -> Column:
    """``array<float>`` of ``FEATURES`` numbers."""

    def run(texts: pa.Array) -> pa.Array:
        values = [text_features(t) for t in texts.to_pylist()]
        flat = pa.array(np.array(values, dtype=np.float32).ravel() if values else np.zeros(0, np.float32))
        offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * FEATURES)
        return pa.ListArray.from_arrays(offsets, flat)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<float>")(text)


@dataclass(frozen=True)
class QualityModel:
    prior: float
    mean: list[float]
    scale: list[float]
    weights: list[float]  # the last one is the constant

    def probability(self, values: Column) -> Column:
        """Probability of good quality from a column of features."""
        factors = [w / s for w, s in zip(self.weights, self.scale)]
        shift = self.weights[-1] - sum(f * m for f, m in zip(factors, self.mean))
        margin = F.aggregate(
            F.zip_with(values, F.lit(factors), lambda v, f: v.cast("double") * f),
            F.lit(float(shift)), lambda total, v: total + v,
        )
        return 1 / (1 + F.exp(-margin))

    def score(self, docs: DataFrame, name: str = "quality", text: str = "text") -> DataFrame:
        """``docs`` with the column ``name``, from 0 to 1."""
        values = unused(docs, "_features")
        return docs.withColumn(values, features(F.col(text))).withColumn(
            name, self.probability(F.col(values))
        ).drop(values)


def _sums(frame: DataFrame, compute, size: int) -> np.ndarray:
    """Sum over all rows of the ``size`` numbers that ``compute(x, positive)`` gives for a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for rows in batches:
            if len(rows):
                total += compute(np.stack(rows["x"].to_numpy()).astype(np.float64), rows["positive"].to_numpy())
        yield pd.DataFrame({"at": np.arange(size), "v": total})

    summed = frame.mapInPandas(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for row in summed:  # ``size`` rows
        out[row["at"]] = row["v"]
    return out


def _log_loss(margin: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -margin)


def learn(docs: DataFrame, labels: DataFrame, steps: int = STEPS) -> QualityModel:
    """Fit to ``docs`` (``doc_id``, ``text``; all of them unlabelled) and to those whose row in
    ``labels`` (``doc_id``, ``label``) is 1."""
    once = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.max("label").alias("label")
    )
    n, good = once.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = (good + 1) / (n + 2)
    table = spool(
        docs.select("doc_id", features(F.col("text")).alias("x")), "quality-features"
    )
    positives = once.where("label = 1").select("doc_id", F.lit(True).alias("positive"))
    table = spool(
        table.join(positives, "doc_id", "left")
        .select("x", F.coalesce("positive", F.lit(False)).alias("positive")),
        "quality-rows",
    )
    size = FEATURES + 1

    def moments(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), positive.sum()], x.sum(0), (x * x).sum(0)])

    m = _sums(table, moments, 2 + 2 * FEATURES)
    rows, trusted = m[:2]
    flat = QualityModel(prior, [0.0] * FEATURES, [1.0] * FEATURES,
                        [0.0] * FEATURES + [math.log(prior / (1 - prior))])
    if not trusted or good == n:
        return flat
    mean = m[2:2 + FEATURES] / rows
    scale = np.sqrt(np.maximum(m[2 + FEATURES:] / rows - mean**2, 0))
    scale[scale < 1e-9] = 1.0

    def prepared(x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - mean) / scale, np.ones((len(x), 1))])

    weights = np.zeros(size)
    weights[-1] = math.log(prior / (1 - prior))
    best = None
    for _ in range(steps):

        def derivatives(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            z = prepared(x)
            p = 1 / (1 + np.exp(-(z @ weights)))
            slope = z.T @ p / rows - prior * z[positive].sum(0) / trusted
            curve = (z * (p * (1 - p))[:, None]).T @ z / rows
            return np.concatenate([slope, curve.ravel()])

        d = _sums(table, derivatives, size + size * size)
        ridge = np.full(size, RIDGE)
        ridge[-1] = 0
        slope = d[:size] + ridge * weights
        curve = d[size:].reshape(size, size) + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, slope)
        tried = np.stack([weights - t * step for t in (0.0, *STEP_SIZES)])

        def risks(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            margin = prepared(x) @ tried.T
            trusted_margin = margin[positive]
            return np.concatenate([
                _log_loss(trusted_margin).sum(0), _log_loss(-trusted_margin).sum(0), _log_loss(-margin).sum(0)
            ])

        r = _sums(table, risks, 3 * len(tried)).reshape(3, -1)
        as_negative = r[2] / rows - prior * r[1] / trusted
        risk = prior * r[0] / trusted + np.maximum(0, as_negative) + (tried**2 @ ridge) / 2
        chosen = int(np.argmin(risk))
        weights = tried[chosen]
        if chosen == 0 or (best is not None and best - risk[chosen] < _TOLERANCE):
            break
        best = risk[chosen]
    return QualityModel(prior, mean.tolist(), scale.tolist(), weights.tolist())
