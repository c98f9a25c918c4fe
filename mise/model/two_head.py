"""Class-weighted two-head classifier (verb head and noun head).

Each head is a multinomial logistic regression (an MLlib model, fitted by
``mise.model.softmax``) trained with a
per-row weight taken from the inverse-frequency class weights.  This is a
linear substitute for the reference's small neural trunk: same inputs, same
weighting, same two heads, same class spaces; not the same numbers.
"""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mise.model.linear import ABSENT_LOGIT, _check_size
from mise.model.softmax import counted, fit_softmax, packed
from mise.operators.labels import weights_of_counts


#: Steps at most; training ends when the objective's change is within the tolerance.
MAX_ITER = 100


def as_vector(df: DataFrame, col: str) -> Column:
    """Feature column as an ML vector: vectors (dense or sparse) pass
    through, arrays are converted."""
    return F.col(col) if isinstance(df.schema[col].dataType, VectorUDT) else array_to_vector(F.col(col))


@dataclass
class TwoHeadModel:
    heads: dict[str, LogisticRegressionModel]
    n_classes: dict[str, int]
    features: str
    history: dict[str, list[float]] = field(default_factory=dict)  # per head the objective before and after each step

    def transform(self, df: DataFrame, out: dict[str, str] | None = None) -> DataFrame:
        """Add one logits column per head (``array<double>`` padded to the
        head's class space with a shared low logit)."""
        out = out or {h: f"z_{h}" for h in self.heads}
        df = df.withColumn("_x", as_vector(df, self.features))
        for head, model in self.heads.items():
            model = model.copy()
            model.setFeaturesCol("_x").setRawPredictionCol("_raw").setProbabilityCol("_prob").setPredictionCol("_pred")
            scored = model.transform(df)
            z = vector_to_array(F.col("_raw"), "float64")
            width = self.n_classes[head]
            if model.numClasses > width:
                raise ValueError(f"{head}: the model has {model.numClasses} classes, the class space {width}")
            pad = F.array_repeat(F.lit(ABSENT_LOGIT), width)
            df = scored.withColumn(out[head], F.slice(F.concat(z, pad), 1, width)).drop("_raw", "_prob", "_pred")
        return df.drop("_x")

    def save(self, path: str) -> None:
        """Write the heads with MLlib's own writers and the class spaces beside them, to any store."""
        for head, model in self.heads.items():
            model.write().overwrite().save(f"{path}/heads/{head}")
        spark = SparkSession.active()
        rows = [(h, int(self.n_classes[h]), self.features) for h in self.heads]
        spark.createDataFrame(rows, "head string, n_classes int, features string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> TwoHeadModel:
        """A saved model, in whatever session is active; it scores like the one that was saved (a
        training curve isn't part of a saved model)."""
        rows = SparkSession.active().read.schema("head string, n_classes int, features string").json(f"{path}/meta").collect()
        heads = {r["head"]: LogisticRegressionModel.load(f"{path}/heads/{r['head']}") for r in rows}
        return cls(heads, {r["head"]: r["n_classes"] for r in rows}, rows[0]["features"])

    def training_curve(self, spark) -> DataFrame:
        """``head, step, loss``: the objective after each step of the optimiser."""
        rows = [(h, i, float(v)) for h, values in self.history.items() for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "head string, step int, loss double")


def fit_two_head(train: DataFrame, features: str, labels: dict[str, str], n_classes: dict[str, int] | None = None,
                 require=None, max_iter: int = MAX_ITER, reg: float = 1e-4, present_only: bool = False,
                 parallelism: int = 2) -> TwoHeadModel:
    """Fit one weighted multinomial head per ``{head: label column}``.

    ``require`` is an optional boolean column: only those rows are trained
    on (e.g. rows with a real visual vector), their weights are recomputed on
    that subset, while the class space (``n_classes``) stays that of the full
    training set (``present_only`` scales the weights over the classes the
    subset has).  The training set is packed and kept for the passes; a fit
    that ends at ``max_iter`` is reported as a warning.  The heads are fitted concurrently
    (``parallelism`` threads submitting Spark jobs, as MLlib's tuning does).
    """
    if n_classes is None:
        row = train.agg(*[(F.max(c) + 1).alias(h) for h, c in labels.items()]).first()
        n_classes = {h: int(row[h]) for h in labels}
    data = train.filter(require) if require is not None else train
    data = data.select(features, *labels.values())
    # many passes follow: kept in the input's partitions, spread only if they are fewer than the cores
    cores = train.sparkSession.sparkContext.defaultParallelism
    data = data.repartition(cores) if data.rdd.getNumPartitions() < cores else data
    blocks = packed(data, features, list(labels.values()))

    def fit(place, head, counts, width):
        # a row per class of the model reaches the driver, as its coefficients do; the rows were counted as they were packed
        w, spark = np.zeros(n_classes[head]), train.sparkSession
        had = spark.createDataFrame([(i, int(n)) for i, n in enumerate(counts) if n], "class_id long, _n long")
        for r in weights_of_counts(had, n_classes[head], present_only=present_only).collect():
            w[r["class_id"]] = r["w"]
        coefficients, intercepts, values, settled = fit_softmax(blocks, place, counts, w[: len(counts)], width, reg, max_iter)
        if not settled:
            warnings.warn(f"{head}: {max_iter} steps taken, the objective had not settled", stacklevel=2)
        return head, _as_model(train.sparkSession, coefficients, intercepts), values

    try:
        width, counts = counted(blocks, len(labels))
        for (head, col), n in zip(labels.items(), counts):
            if not len(n):
                raise ValueError(f"{head}: no labelled rows to fit")
            if len(n) > n_classes[head]:
                raise ValueError(f"{col} outside the class space: {len(n) - 1}")
            _check_size(len(n) * (width + 1))
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = list(pool.map(lambda a: fit(*a), [(i, h, counts[i], width) for i, h in enumerate(labels)]))
    finally:
        blocks.unpersist()
    return TwoHeadModel({h: m for h, m, _ in fitted}, dict(n_classes), features, {h: v for h, _, v in fitted})


def _as_model(spark: SparkSession, coefficients: np.ndarray, intercepts: np.ndarray) -> LogisticRegressionModel:
    """The coefficients as MLlib's own model, which scores vectors and is saved like any other."""
    sc, (k, width) = spark.sparkContext, coefficients.shape
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"softmax_{id(coefficients):x}", _py2java(sc, DenseMatrix(k, width, coefficients.ravel(order="F"))),
        _py2java(sc, DenseVector(intercepts)), k, True)
    return LogisticRegressionModel._from_java(made)
