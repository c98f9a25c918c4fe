"""Metric tables: best-per-metric flags and gains over a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metrics_long(df: DataFrame, metrics, id_col: str = "mode") -> DataFrame:
    """Wide metric rows (one per model) to ``(mode, metric, value)``."""
    return df.select(id_col, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        id_col, list(metrics), "metric", "value")


def flag_best(df: DataFrame, metrics, id_col: str = "mode") -> DataFrame:
    """``is_best`` for every model holding the highest value of a metric;
    ties are all flagged.  The window partitions by metric, so it holds one
    row per model per metric."""
    long = metrics_long(df, metrics, id_col)
    best = F.max("value").over(Window.partitionBy("metric"))
    return long.withColumn("is_best", F.col("value") == best)


def metric_gain(df: DataFrame, metrics, base: str, id_col: str = "mode") -> DataFrame:
    """Gain of each model over the ``base`` model per metric: absolute
    difference and relative change (NULL when the base value is 0).  The base
    comes by a window over the metric, which holds one row per model, so the table is
    read once."""
    base_value = F.max(F.when(F.col(id_col) == base, F.col("value"))).over(Window.partitionBy("metric"))
    held = F.max(F.col(id_col) == base).over(Window.partitionBy("metric"))  # no base row: no gains
    long = metrics_long(df, metrics, id_col).withColumns({"base_value": base_value, "_held": held}).filter("_held").drop("_held")
    return (long.withColumn("abs_gain", F.round(F.col("value") - F.col("base_value"), 6))
            .withColumn("rel_gain", F.round(F.try_divide(F.col("value"), F.col("base_value")) - 1.0, 6)))


def round_metrics(df: DataFrame, metrics, digits: int = 3) -> DataFrame:
    """Metric columns rounded half-up for display (3 or 4 decimals in the
    published tables); compute on unrounded values."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in set(metrics) else F.col(c) for c in df.columns])
