"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table of a data directory (``{data_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, data_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views so users can write SQL over them."""
    for name in names:
        read_table(spark, data_dir, name).createOrReplaceTempView(name)
