"""Feature, mapping, metric and prediction tables.

Features are stored long: ``(clip_id, split, modality, vec)``, partitioned by
``split`` and ``modality``.  Rows are tied to clips by key, never by
position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mise.schema import MAPPING_SCHEMA


def to_long(df: DataFrame, key: str, split_col: str, modalities: dict[str, str], dtype: str = "float") -> DataFrame:
    """Wide feature columns ``{modality: column}`` to the long layout in one
    pass (``unpivot``), keeping rows whose modality is present."""
    wide = df.select(F.col(key).cast("string").alias("clip_id"), F.col(split_col).alias("split"),
                     *[F.col(c).cast(f"array<{dtype}>").alias(m) for m, c in modalities.items()])
    return (wide.unpivot(["clip_id", "split"], list(modalities), "modality", "vec")
            .filter(F.col("vec").isNotNull()))


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature sink, partitioned by split and modality."""
    df.write.mode(mode).partitionBy("split", "modality").parquet(path)


def read_features(spark: SparkSession, path: str, split: str, modalities, labels_path: str | None = None) -> DataFrame:
    """Wide table ``clip_id, <modality>...`` for one split.

    Partition filters on ``split`` and ``modality`` prune the files; the pivot
    uses the given modality list, so no distinct pass runs.  A missing
    modality of a clip stays NULL.  ``labels_path`` (optional) is left-joined
    on ``clip_id``; when absent no label columns are added.
    """
    mods = list(modalities)
    long = (spark.read.parquet(path)
            .filter((F.col("split") == split) & F.col("modality").isin(mods)))
    wide = long.groupBy("clip_id").pivot("modality", mods).agg(F.max("vec"))
    if labels_path:
        labels = spark.read.parquet(labels_path).filter(F.col("split") == split).drop("split")
        wide = wide.join(labels, "clip_id", "left")
    return wide


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "clip_id", buckets: int = 16) -> DataFrame:
    """Store a feature table in ``buckets`` files by its key, sorted, and return it read back.  Tables
    stored with the same key and number of buckets join on it without a shuffle."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").mode("overwrite")
     .saveAsTable(table))
    return spark.table(table)


def write_mapping(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Label mapping ``class_name, class_id`` (small: one row per class)."""
    out = df.select("class_name", "class_id").write.mode("overwrite")
    if fmt == "csv":
        out.option("header", True).csv(path)
    else:
        out.parquet(path)


def read_mapping(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Mapping read back with ``class_name`` kept as **string** ('10' stays
    '10', never the number 10)."""
    if fmt == "csv":
        return spark.read.option("header", True).schema(MAPPING_SCHEMA).csv(path)
    return spark.read.parquet(path).select(F.col("class_name").cast("string"), F.col("class_id").cast("long"))


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric rows as JSON lines (one object per model)."""
    df.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Metric files: JSON lines (as ``write_metrics`` writes them) or, with
    ``multi_line=True``, one pretty-printed JSON array per file (as published).
    A record that doesn't parse is an error."""
    return spark.read.option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
