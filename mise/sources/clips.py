"""Clip metadata: CSV scan, Parquet as the working format, prepared sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mise.schema import CLIP_SCHEMA


def read_clips(spark: SparkSession, path: str, schema: T.StructType | None = CLIP_SCHEMA,
               split: str | None = None, fmt: str = "csv") -> DataFrame:
    """Read clip metadata with an explicit schema (no inference pass).

    ``fmt='csv'`` reads header CSV; only the columns present in the file are
    kept, in schema order, so a test file without labels gives a narrower
    table.  ``fmt='parquet'`` reads the prepared layout, where ``split`` is a
    partition column and a ``split`` argument prunes partitions.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.filter(F.col("split") == split) if split is not None else df
    header = spark.read.option("header", True).csv(path).columns  # header line only
    fields = [f for f in (schema or CLIP_SCHEMA).fields if f.name in set(header)]
    extra = [T.StructField(c, T.StringType()) for c in header if c not in {f.name for f in fields}]
    by_name = {f.name: f for f in fields + extra}
    ordered = T.StructType([by_name[c] for c in header])
    # a file with another header fails instead of being read by position
    df = (spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
          .schema(ordered).csv(path))
    if split is not None:
        df = df.withColumn("split", F.lit(split))
    return df


def prepare_clips(df: DataFrame) -> DataFrame:
    """Data-preparation step: when the table has ``verb`` and ``noun``, add
    ``action_label`` and ``duration_frames`` (decided from the schema at plan
    time; unlabelled tables pass through unchanged)."""
    from mise.functions.columns import action_label, duration_frames
    if {"verb", "noun"} <= set(df.columns):
        df = df.withColumn("action_label", action_label("verb", "noun"))
        df = df.withColumn("duration_frames", duration_frames("start_frame", "stop_frame"))
    return df


def write_clips(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Prepared-metadata sink.  Parquet is partitioned by ``split`` so later
    reads of one split prune the others."""
    writer = df.write.mode(mode)
    if fmt == "parquet":
        (writer.partitionBy("split") if "split" in df.columns else writer).parquet(path)
    else:
        writer.option("header", True).csv(path)
