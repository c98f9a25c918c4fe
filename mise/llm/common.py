"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mise.session import scratch_path

#: White space as the corpus contracts define it (six ASCII characters).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read it back: cuts
    the lineage, survives lost executors, and later reads prune columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_suffix_free(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


#: A key with more than one SHARES-th of all rows (so there are fewer than SHARES of
#: them, whatever the input) is dealt over SALT parts in ``join_groups``.
SHARES, SALT, LEAST = 1_000, 32, 200


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], n: str, spread: list[str]) -> DataFrame:
    """``rows`` joined with ``groups``, which has a row per key and in ``n`` the rows
    of that key; ``n`` is left out.  ``groups`` should be materialised.

    The few keys that hold a large share of the rows are known by their counts (a
    bounded list of hashes): their rows are dealt by the ``spread`` columns over copies of
    the group's row, so no task gets a whole hot group."""
    total = groups.agg(F.sum(n)).first()[0] or 0
    code = F.xxhash64(*keys)
    hot = [r["h"] for r in groups.filter(F.col(n) > max(total // SHARES, LEAST)).select(code.alias("h")).collect()]
    slim = groups.drop(n)
    if not hot:
        return rows.join(slim, keys)
    part = with_suffix_free(rows, "part")
    dealt = F.pmod(F.xxhash64(*spread), F.lit(SALT)).cast("int")
    left = rows.withColumn(part, F.when(code.isin(hot), dealt).otherwise(F.lit(0)))
    copies = F.when(code.isin(hot), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0)))
    return left.join(slim.withColumn(part, F.explode(copies)), [*keys, part]).drop(part)
