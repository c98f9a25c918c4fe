"""Label mappings, encoding, decoding and class weights.

Label ids are ranks of the class **strings** (``'10' < '2'``), fitted on the
training rows; classes never seen in training encode to ``-1``.  A NULL
class is never a class of its own: it encodes to ``-1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mise.schema import UNKNOWN_CLASS, UNSEEN_ID
from mise.session import cut_lineage

# Mappings up to this many rows (about 10-20 MB of class names and ids) are
# broadcast; larger ones are shuffle joined, with AQE splitting hot keys.
BROADCAST_MAPPING_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def dense_rank_values(df: DataFrame, col: str, out: str) -> DataFrame:
    """Exact 0-based rank of every distinct value of ``col`` in sort order,
    computed without moving the value table into one task.

    The distinct values are range-partitioned and written to the checkpoint
    folder (so partitions are fixed); each partition counts its rows -- one
    number per partition, a proven bound, the only thing the driver sees --
    and a local row number plus the partition's offset (a constant map) is
    the global rank.
    """
    values = df.select(F.col(col)).filter(F.col(col).isNotNull()).distinct()
    ordered = cut_lineage(values.repartitionByRange(col).sortWithinPartitions(col))
    tagged = ordered.withColumn("_p", F.spark_partition_id())
    counts = sorted((r["_p"], r["n"]) for r in tagged.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets += [F.lit(p), F.lit(total)]
        total += n
    local = tagged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(col)))
    offset = F.create_map(*offsets)[F.col("_p")] if offsets else F.lit(0)
    return local.select(F.col(col), (offset + F.col("_r") - 1).cast("long").alias(out))


def fit_mapping(df: DataFrame, col: str) -> DataFrame:
    """``class_name, class_id``: distinct classes as strings, id = rank.

    The mapping is written to the checkpoint folder: later joins read the
    small table instead of re-running the fit, and its size is known."""
    classes = df.select(F.col(col).cast("string").alias("class_name"))
    return cut_lineage(dense_rank_values(classes, "class_name", "class_id"))


def sized(mapping: DataFrame, limit: int = BROADCAST_MAPPING_ROWS) -> DataFrame:
    """Broadcast hint for a mapping whose row count is checked to be at most
    ``limit``; beyond it the join stays a shuffle join.  Call on a mapping
    that is already materialised (``fit_mapping`` output or a file)."""
    return F.broadcast(mapping) if _small(mapping, limit) else mapping


def _small(table: DataFrame, limit: int = BROADCAST_MAPPING_ROWS, bytes_limit: int = BROADCAST_BYTES) -> bool:
    """At most ``limit`` rows and ``bytes_limit`` bytes of text: two sums, made where the rows are."""
    texts = [F.sum(F.octet_length(F.col(f.name))) for f in table.schema.fields if f.dataType.simpleString() == "string"]
    size = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0))
    rows, held = table.agg(F.count(F.lit(1)), size).first()
    return rows <= limit and held + 16 * rows <= bytes_limit


def encode_labels(df: DataFrame, mapping: DataFrame, col: str, out: str = "y",
                  on_unseen: str = "keep") -> DataFrame:
    """Class → id via the mapping.  ``on_unseen='keep'`` gives ``-1``;
    ``'error'`` raises at run time for a non-NULL class missing from the
    mapping."""
    m = sized(mapping).select(F.col("class_name").alias("_cn"), F.col("class_id").alias("_cid"))
    j = df.withColumn("_key", F.col(col).cast("string")).join(m, F.col("_key") == F.col("_cn"), "left")
    cid: Column = F.col("_cid")
    if on_unseen == "error":
        cid = F.when(cid.isNull() & F.col("_key").isNotNull(),
                     F.raise_error(F.concat(F.lit("unseen label in column " + col + ": "), F.col("_key")))
                     ).otherwise(cid)
    return j.withColumn(out, F.coalesce(cid, F.lit(UNSEEN_ID)).cast("long")).drop("_key", "_cn", "_cid")


def decode(df: DataFrame, mapping: DataFrame, id_col: str, out: str, default: str = UNKNOWN_CLASS) -> DataFrame:
    """Id → class name; ids outside the mapping give ``default``."""
    m = sized(mapping).select(F.col("class_id").alias("_cid"), F.col("class_name").alias("_cn"))
    return (df.join(m, F.col(id_col) == F.col("_cid"), "left")
            .withColumn(out, F.coalesce(F.col("_cn"), F.lit(default))).drop("_cid", "_cn"))


def text_reference(df: DataFrame, class_col: str, text_col: str, order_col: str) -> DataFrame:
    """``class_name, text``: one text per class; when a class has several, the
    one of the last row by ``order_col`` wins (``max_by`` aggregates with a
    map-side combine, so a hot class is not one task)."""
    return (df.filter(F.col(class_col).isNotNull())
            .groupBy(F.col(class_col).cast("string").alias("class_name"))
            .agg(F.max_by(F.col(text_col), F.col(order_col)).alias("text")))


def decode_text(df: DataFrame, mapping: DataFrame, reference: DataFrame, id_col: str, out: str) -> DataFrame:
    """Id → source class → text.  No text → the class string; id outside the
    mapping → the id as text."""
    names = mapping.join(reference, "class_name", "left").select(
        F.col("class_id").alias("_cid"), F.coalesce(F.col("text"), F.col("class_name")).alias("_name"))
    # one text per class, also if the reference has several; the joined table's size is checked
    names = names.groupBy("_cid").agg(F.max("_name").alias("_name"))
    return (df.join(sized(names), F.col(id_col) == F.col("_cid"), "left")
            .withColumn(out, F.coalesce(F.col("_name"), F.col(id_col).cast("string"))).drop("_cid", "_name"))


def unseen_rows(df: DataFrame, cols) -> DataFrame:
    """Rows whose encoded label is ``-1``, per label column (one pass)."""
    return df.agg(*[F.count_if(F.col(c) == UNSEEN_ID).alias(f"{c}_unseen") for c in cols])


def class_space(df: DataFrame, col: str) -> Column:
    """``max(col) + 1`` of a table as a scalar-subquery column."""
    return df.select((F.max(col) + 1).cast("long")).scalar()


def class_weights(df: DataFrame, col: str, n_classes, present_only: bool = False) -> DataFrame:
    """Inverse-frequency weights over ids ``0 .. n_classes-1``:
    ``w = 1 / max(count, 1)`` (absent classes count as 1), scaled so the
    weights sum to ``n_classes``.  ``n_classes`` may be an int or a scalar
    column (e.g. ``class_space`` of the full training set).  The total is a
    scalar subquery; no cross join and no driver round trip.

    ``present_only=True``: absent classes get weight 0 and stay out of the
    scaling, so the present classes' weights sum to their number (otherwise a
    small masked subset leaves most of the sum to classes it never sees)."""
    counts = df.groupBy(F.col(col).cast("long").alias("class_id")).agg(F.count(F.lit(1)).alias("_n"))
    return weights_of_counts(counts, n_classes, present_only)


def weights_of_counts(counts: DataFrame, n_classes, present_only: bool = False) -> DataFrame:
    """``class_weights`` of rows that are counted already (``class_id, _n``)."""
    spark = counts.sparkSession
    n = F.lit(n_classes) if isinstance(n_classes, int) else n_classes
    ids = spark.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("class_id"))
    cnt = F.coalesce(F.col("_n"), F.lit(0))
    raw = ids.join(counts, "class_id", "left").select(
        "class_id", (F.lit(1.0) / F.greatest(cnt, F.lit(1))).alias("_w"), (cnt > 0).alias("_present"))
    if present_only:
        raw = raw.withColumn("_w", F.when(F.col("_present"), F.col("_w")).otherwise(F.lit(0.0)))
        scale = raw.select(F.count_if("_present").cast("double")).scalar()
    else:
        scale = n
    total = raw.select(F.sum("_w")).scalar()
    return raw.select("class_id", (F.col("_w") / total * scale).alias("w"))
