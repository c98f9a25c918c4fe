"""Group-aware split assignment and leakage audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mise.operators.labels import sized
from mise.session import cut_lineage


def split_bucket(group) -> Column:
    """Stable bucket 0..99 of a group key: the first 8 hex digits of its MD5
    as a number, modulo 100.  Row-local (no shuffle) and reproducible in any
    engine that has MD5."""
    g = F.col(group) if isinstance(group, str) else group
    return F.pmod(F.conv(F.substring(F.md5(g.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))


def assign_split(df: DataFrame, group: str = "video_id",
                 fractions=(("train", 80), ("val", 10), ("test", 10)), out: str = "split") -> DataFrame:
    """Every row of a group lands in the same split.  ``fractions`` are
    percentages of buckets, in order; they must add up to 100."""
    total = sum(p for _, p in fractions)
    if total != 100:
        raise ValueError(f"fractions add up to {total}, not 100")
    b = split_bucket(group)
    expr, upper = None, 0
    for name, pct in fractions:
        upper += pct
        expr = F.when(b < upper, F.lit(name)) if expr is None else expr.when(b < upper, F.lit(name))
    return df.withColumn(out, expr)


def assign_split_by_size(df: DataFrame, group: str = "video_id", fractions=(("train", 80), ("val", 10), ("test", 10)),
                         out: str = "split") -> DataFrame:
    """``assign_split`` that meets its fractions: groups are lined up in the order of their MD5, and
    a group goes to the split in whose share of all rows its first row falls.  So every split differs from
    its fraction by less than the rows of one group, however uneven groups are.

    The rows before each group are a running sum in two levels: over 4,096 ranges of the MD5 (one
    small table, whatever the data), and inside each range.  Rows without a group have none before
    them and go to the first split."""
    total = sum(p for _, p in fractions)
    if total != 100:
        raise ValueError(f"fractions add up to {total}, not 100")
    sizes = (df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col(group).isNotNull())
             .withColumn("_h", F.md5(F.col(group).cast("string"))).withColumn("_r", F.substring("_h", 1, 3)))
    sizes = cut_lineage(sizes)
    earlier = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (sizes.groupBy("_r").agg(F.sum("_n").alias("_m"))
              .select("_r", F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("_r").orderBy("_h", group).rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.withColumn("_up", F.sum("_n").over(inside)).join(F.broadcast(ranges), "_r")
    start = F.col("_before") + F.col("_up") - F.col("_n")
    rows = sizes.select(F.sum("_n")).scalar()
    expr, upper = None, 0
    for name, pct in fractions:
        upper += pct
        inside_share = start * 100 < rows * upper
        expr = F.when(inside_share, F.lit(name)) if expr is None else expr.when(inside_share, F.lit(name))
    names = sized(cut_lineage(placed.select(group, expr.alias(out))))
    first = fractions[0][0]
    return df.join(names, group, "left").withColumn(out, F.coalesce(F.col(out), F.lit(first)))


def split_leakage(df: DataFrame, group: str = "video_id", split: str = "split") -> DataFrame:
    """Groups found in more than one split.  The distinct count combines
    ``(group, split)`` pairs map-side first, so a hot group costs at most one
    row per split per task."""
    return (df.groupBy(group).agg(F.count_distinct(split).alias("n"),
                                  F.array_sort(F.collect_set(split)).alias("splits"))
            .filter(F.col("n") > 1))


def text_label_leak(df: DataFrame, text: str, labels: dict[str, Column], by=(), digits: int = 6) -> DataFrame:
    """Share of rows whose text contains the label word, per head.
    ``labels`` maps an output name to the label-word column."""
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    aggs = [F.round(F.avg(F.when(t.contains(F.lower(lab)), 1.0).otherwise(0.0)), digits).alias(name)
            for name, lab in labels.items()]
    return df.groupBy(*by).agg(*aggs)
