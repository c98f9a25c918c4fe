"""Connected components of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mise.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(node, label)``: label is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, until no label changes; the driver sees one count a
    round.  Every round is checkpointed.  No links: no rows."""
    both = cut_lineage(links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                       .unionAll(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct())
    labels = cut_lineage(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("label").alias("seen"))
        near = both.join(seen, "other").groupBy("node").agg(F.min("seen").alias("near"))
        hooked = (labels.join(near, "node", "left")
                  .select("node", F.col("label").alias("before"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = cut_lineage(hooked.join(jump, "label", "left")
                          .select("node", "before", F.least("label", F.coalesce("beyond", "label")).alias("label")))
        if new.filter("label <> before").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
