"""Mixing sources to target weights.

Tokens are counted per source; water-filling turns weights into per-source
targets (no source above ``most`` times its size); a document is then emitted
``floor(rate)`` times and once more when its seeded hash falls under the rate's
fraction.  The per-source table has one row per source and stays distributed:
the rounds of water-filling bring back three sums each.

Defined results: a null text has size 0; a null source is a source of its own
and comes last in the weight order; sources of size 0 get target 0 and rate 0;
the extra copy depends on the seed and ``doc_id`` (the text where that is null)
only, so reruns agree and rows repeated with the same id are treated alike; an empty table gives an
empty result; further columns are carried along untouched by ``mix``, whatever their names; ``mixed``
replaces those that have the name of one of its results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mise.llm.common import WORD, text_of, with_suffix_free
from mise.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 10
#: Largest per-source table that is broadcast; beyond it the join shuffles.
BROADCAST_SOURCES = 10_000


def draw_of(seed: int, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from the seed and the document (13 hex digits of MD5)."""
    named = F.coalesce(doc_id.cast("string"), F.md5(text))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), named))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ranked(keys: DataFrame, key: str, rank: str) -> DataFrame:
    """0-based position of each row in the order of ``key`` (binary, nulls last)
    without one task holding all rows: range partitions, then their offsets."""
    order = [F.col(key).isNull(), F.col(key)]
    parts = keys.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = cut_lineage(parts)
    sizes = {r["_part"]: r["n"] for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    offset, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, offset))
        offset += sizes[part]
    if not offsets:
        return keys.withColumn(rank, F.lit(0).cast("long"))
    table = F.create_map(*[F.lit(x) for pair in offsets for x in pair])
    from pyspark.sql import Window
    within = Window.partitionBy("_part").orderBy(*order)
    return (parts.withColumn(rank, (table[F.col("_part")] + F.row_number().over(within) - 1).cast("long"))
            .drop("_part"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size`` with ``target``: the share by weight, never above
    ``most`` times the source's size, the excess dealt again by weight."""
    placed = ranked(sizes, "source", "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    placed = cut_lineage(placed.select("source", "source_size", weight.alias("weight")))
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    goal = share * total
    full = F.lit(False)  # sources at their cap
    capped = F.lit(float(most)) * F.col("source_size")
    level, n_full = None, -1
    while True:
        now = placed.agg(F.count_if(full).alias("n"),
                         F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("in_caps"),
                         F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open_weight")).first()
        if now["n"] == n_full or now["open_weight"] == 0:
            break
        n_full = now["n"]
        level = (goal - most * now["in_caps"], now["open_weight"])
        dealt = F.col("weight") * F.lit(level[0]) / F.lit(level[1])
        full = full | (dealt > capped)
    if level is None:
        return placed.select("source", "source_size", F.lit(0.0).alias("target"))
    dealt = F.col("weight") * F.lit(float(level[0])) / F.lit(float(level[1]))
    return placed.select("source", "source_size", F.when(full, capped).otherwise(dealt).alias("target"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
          seed: int = SEED, extra: str = "copies") -> DataFrame:
    """``docs`` with ``size, source_size, target`` and the number of copies."""
    made = {"size", "source_size", "target", extra}
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in made])
    rows = docs.withColumn("size", size_of(text_of(docs)))
    sizes = cut_lineage(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    named = with_suffix_free(rows, "_source")
    table = targets(sizes, weights, share, most).withColumnRenamed("source", named)
    if sizes.count() <= BROADCAST_SOURCES:  # checked: a row per source, a name and two numbers
        table = F.broadcast(table)
    out = rows.join(table, rows["source"].eqNullSafe(table[named])).drop(named)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = draw_of(seed, F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    base = F.floor(rate)
    return out.withColumn(extra, (base + F.when(draw < rate - base, 1).otherwise(0)).cast("long"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture: every document as often as its copies say."""
    slim = {c: with_suffix_free(docs, f"mix_{i}") for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(slim[c]) for c in docs.columns],
                          *[F.col(c) for c in ("doc_id", "source", "text")])
    out = mixed(renamed, **options).filter("copies > 0")
    out = out.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)")))
    return out.select(*[F.col(slim[c]).alias(c) for c in docs.columns])
