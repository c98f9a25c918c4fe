"""Class and split profiling.  Every operator is one aggregate plan with a
map-side combine; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mise.functions.columns import has_modality


def class_counts(df: DataFrame, col: str, k: int | None = None, name: str = "n") -> DataFrame:
    """Rows per class, most frequent first, class name breaking ties; ``k``
    keeps the top k (a top-k report).  NULL classes are not counted."""
    out = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
           .orderBy(F.desc(name), F.asc(col)))
    return out.limit(k) if k else out


def class_cardinality(df: DataFrame, cols=("verb_class", "noun_class"), approx: bool = False,
                      rsd: float = 0.01) -> DataFrame:
    """Distinct classes per column and distinct class combinations; with
    ``approx=True`` HyperLogLog++ sketches (relative error ``rsd``) replace
    the exact distinct counts."""
    if approx:
        aggs = [F.approx_count_distinct(F.col(c), rsd).alias(f"{c}_distinct") for c in cols]
        aggs.append(F.approx_count_distinct(F.struct(*[F.col(c) for c in cols]), rsd).alias("pairs_distinct"))
        return df.agg(*aggs)
    aggs = [F.count_distinct(F.col(c)).alias(f"{c}_distinct") for c in cols]
    aggs.append(F.count_distinct(*[F.col(c) for c in cols]).alias("pairs_distinct"))
    return df.agg(*aggs)


def imbalance(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """Gini–Simpson index ``1 - sum(p^2)`` of the class distribution and the
    number of classes (at most ``1 - 1/k``; 0 for one class)."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return counts.agg(
        F.round(F.lit(1.0) - F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n")), digits).alias("g"),
        F.count(F.lit(1)).alias("k"))


def split_summary(df: DataFrame, split: str = "split", video: str = "video_id",
                  text: str = "narration", labels=("verb_class", "noun_class")) -> DataFrame:
    """Rows, videos, columns holding data, and whether narration and labels
    are present, per split (one table holds every split; a split whose files
    lack a column has it all NULL)."""
    data_cols = [c for c in df.columns if c != split]
    any_label = F.lit(False)
    for c in labels:
        any_label = any_label | F.col(c).isNotNull()
    has_labels = F.max(any_label)
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(video).alias("videos"),
        sum((F.max(F.col(c).isNotNull()).cast("int") for c in data_cols), F.lit(0)).alias("columns"),
        F.max(F.col(text).isNotNull()).alias("has_narration"),
        has_labels.alias("has_labels"))


def n_classes(df: DataFrame, cols) -> DataFrame:
    """Class-space size ``max(y) + 1`` per label column."""
    return df.agg(*[(F.max(c) + 1).cast("long").alias(f"{c}_n") for c in cols])


def rare_classes(df: DataFrame, col: str, threshold: int = 10) -> DataFrame:
    """Classes with fewer than ``threshold`` rows."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") < threshold))


def coverage(df: DataFrame, vec: str, by=()) -> DataFrame:
    """Share of rows whose modality vector is real (any non-zero element)."""
    return df.groupBy(*by).agg(
        F.count_if(has_modality(vec)).alias("n_real"),
        F.count(F.lit(1)).alias("n"),
        F.round(F.count_if(has_modality(vec)) / F.count(F.lit(1)), 6).alias("coverage"))


def distribution_compare(left: DataFrame, left_col: str, right: DataFrame, right_col: str,
                         name: str = "class_name") -> DataFrame:
    """Class counts of two tables side by side (classes of either side)."""
    a = left.filter(F.col(left_col).isNotNull()).groupBy(F.col(left_col).alias(name)).agg(
        F.count(F.lit(1)).alias("left_n"))
    b = right.filter(F.col(right_col).isNotNull()).groupBy(F.col(right_col).alias(name)).agg(
        F.count(F.lit(1)).alias("right_n"))
    return a.join(b, name, "full_outer").select(
        name, F.coalesce("left_n", F.lit(0)).alias("left_n"), F.coalesce("right_n", F.lit(0)).alias("right_n"))


def class_sketches(df: DataFrame, cols, by=("split",), lg_k: int = 12, items: int = 1_000) -> DataFrame:
    """Mergeable states of distinct and frequent classes per group: ``(*by, column, hll, top)``.

    A row holds a HyperLogLog sketch (at most ``2 ** lg_k`` registers) and a frequent-items sketch (at most
    ``items`` classes) of one column, so it can be stored per split or day and merged
    later without the rows.  NULL classes are not counted."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("class")) for c in cols]))
    long = df.select(*by, values.alias("_e")).select(*by, "_e.*").filter(F.col("class").isNotNull())
    return long.groupBy(*by, "column").agg(F.hll_sketch_agg("class", lg_k).alias("hll"),
                                           F.expr(f"approx_top_k_accumulate(class, {items})").alias("top"))


def merged_sketches(sketches: DataFrame, k: int, by=()) -> DataFrame:
    """``(*by, column, distinct, top)`` of merged states: the estimated number of classes and the ``k``
    most frequent ones as ``array<struct<item, count>>``.  The estimate's relative standard error is
    about ``0.83 / sqrt(2 ** lg_k)``; counts are exact while a state has room for all classes."""
    return sketches.groupBy(*by, "column").agg(
        F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("distinct"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(top), {k})").alias("top"))
