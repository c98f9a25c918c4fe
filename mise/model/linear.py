"""Linear scoring and the fitted scorers.

A fitted model is a small weight matrix held by the driver (one row per
class, as MLlib models hold their coefficients).  Scoring adds a logits
column ``array<double>`` whose index is the class id, by one path for every
size: the matrix is broadcast once per executor (its size is checked) and one
matrix product scores an Arrow batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mise.functions.columns import known
from mise.session import ship_library

ABSENT_LOGIT = -1.0e9  # shared low logit of classes the model never saw


#: Weights of all groups that are broadcast at most (512 MB of doubles).
MOST_WEIGHTS = 64 << 20


def _score_batches(features: str, out: str, by: str | None, bc):
    def logits(x, weights, bias):
        if x.shape[1] != weights.shape[1]:
            raise ValueError(f"{features} has width {x.shape[1]}, the model {weights.shape[1]}")
        z = x @ np.nan_to_num(weights, nan=0.0, neginf=0.0, posinf=0.0).T + (0.0 if bias is None else bias)
        z[:, ~np.all(np.isfinite(weights), axis=1)] = ABSENT_LOGIT
        return z

    def run(batches):
        models = bc.value
        for pdf in batches:
            result = np.full(len(pdf), None, dtype=object)
            there = pdf[features].notna().to_numpy()
            group = pdf[by].to_numpy() if by else np.full(len(pdf), None)
            for g, (weights, bias) in models.items():
                rows = np.nonzero(there & (group == g if by else True))[0]
                if len(rows):
                    x = np.stack(pdf[features].to_numpy()[rows]).astype(np.float64)
                    for i, z in zip(rows, logits(x, weights, bias), strict=True):
                        result[i] = z
            pdf[out] = result
            yield pdf
    return run


def _score(df: DataFrame, features: str, models: dict, by: str | None, out: str) -> DataFrame:
    size = sum(w.size for w, _ in models.values())
    if size > MOST_WEIGHTS:
        raise ValueError(f"{size} weights are too many to broadcast")
    ship_library(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast(models)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.DoubleType()))])
    return df.mapInPandas(_score_batches(features, out, by, bc), schema)


def score(df: DataFrame, features: str, weights: np.ndarray, bias: np.ndarray | None = None,
          out: str = "z") -> DataFrame:
    """Add logits ``out`` = ``W x + b`` for every row of ``df``.  NULL features
    give NULL logits; a vector of another width is an error."""
    return _score(df, features, {None: (weights, bias)}, None, out)


@dataclass
class CentroidModel:
    """Logit of class c = ``x · mean(x | c)`` (the stand-in scorer)."""
    centroids: np.ndarray
    classes: list[int] = field(default_factory=list)

    def transform(self, df: DataFrame, features: str, out: str = "z") -> DataFrame:
        return score(df, features, self.centroids, None, out)


def _check_size(weights: int) -> None:
    """Labels are dense ids (``fit_mapping``); a raw id would ask for a huge matrix."""
    if weights > MOST_WEIGHTS:
        raise ValueError(f"a model of {weights} weights; encode the labels first")


def fit_centroids(df: DataFrame, features: str, label: str, n_classes: int | None = None) -> CentroidModel:
    """Class means of the feature vectors over rows with a known label.

    The means are one ``Summarizer`` aggregate per class (map-side partial
    aggregation); only the k × d matrix reaches the driver.  Row ``c`` of the
    matrix is class ``c``; classes without rows get a non-finite row and
    score the shared low logit."""
    rows = (df.filter(known(label))
            .groupBy(F.col(label).cast("long").alias("c"))
            .agg(Summarizer.mean(array_to_vector(F.col(features))).alias("m"))
            .collect())
    if not rows:
        raise ValueError("no labelled rows to fit")
    top = max(r["c"] for r in rows) + 1
    k = n_classes if n_classes is not None else top
    if top > k:
        raise ValueError(f"label {top - 1} is outside a class space of {k}")
    d = len(rows[0]["m"])
    _check_size(k * d)
    mat = np.full((k, d), np.nan)
    for r in rows:
        mat[r["c"]] = r["m"].toArray()
    return CentroidModel(mat, sorted(r["c"] for r in rows))


def fit_centroids_grouped(df: DataFrame, features: str, label: str, by: str) -> dict:
    """One centroid model per value of ``by`` (e.g. per ablation mode) from a
    single aggregate: ``groupBy(by, label)`` class means, one collect of the
    (groups x classes) rows -- not one job per model."""
    rows = (df.filter(known(label))
            .groupBy(F.col(by).alias("g"), F.col(label).cast("long").alias("c"))
            .agg(Summarizer.mean(array_to_vector(F.col(features))).alias("m"))
            .collect())
    models = {}
    for g in sorted({r["g"] for r in rows}):
        mine = [r for r in rows if r["g"] == g]
        k = max(r["c"] for r in mine) + 1
        _check_size(k * len(mine[0]["m"]))
        mat = np.full((k, len(mine[0]["m"])), np.nan)
        for r in mine:
            mat[r["c"]] = r["m"].toArray()
        models[g] = CentroidModel(mat, sorted(r["c"] for r in mine))
    return models


def score_grouped(df: DataFrame, features: str, models: dict, by: str, out: str = "z") -> DataFrame:
    """Logits from the model of each row's group (NULL for a group without a
    model): all matrices travel in one broadcast of checked size."""
    return _score(df, features, {g: (m.centroids, None) for g, m in models.items()}, by, out)
