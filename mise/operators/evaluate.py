"""Evaluation of scored rows.

A scored table has, per head, an integer label column (``-1`` = unseen in
training) and a logits column (``array<double>``, index = class id).  All
metrics are conditional aggregates, so the heads share one pass and each
head keeps its own known-label denominator.  ``by`` groups the metrics (for
example by model ``mode`` in an ablation) in the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mise.functions.columns import argmax, in_top_k, known, nll

DIGITS = 6


def with_predictions(df: DataFrame, heads: dict[str, str]) -> DataFrame:
    """Add ``<pred>`` = argmax of ``<logits>`` for each ``{pred: logits}``."""
    for pred, logits in heads.items():
        df = df.withColumn(pred, argmax(logits))
    return df


def with_correct_flags(df: DataFrame, verb=("yv", "pv"), noun=("yn", "pn")) -> DataFrame:
    """``verb_ok``, ``noun_ok`` and ``action_ok`` (both heads right)."""
    return (df.withColumn("verb_ok", F.col(verb[0]) == F.col(verb[1]))
              .withColumn("noun_ok", F.col(noun[0]) == F.col(noun[1]))
              .withColumn("action_ok", F.col("verb_ok") & F.col("noun_ok")))


def errors(df: DataFrame, verb=("yv", "pv"), noun=("yn", "pn")) -> DataFrame:
    """Rows with both labels known where the action is wrong."""
    flagged = with_correct_flags(df, verb, noun)
    return flagged.filter(known(verb[0]) & known(noun[0]) & ~F.col("action_ok"))


def topk_accuracy(df: DataFrame, label: str, logits: str, ks=(1, 5), by=(), prefix: str = "") -> DataFrame:
    """Top-k accuracy over rows with a known label; no sort per row (rank of
    the true logit by counting).  A row without logits, or whose label is
    outside them, is a miss.  No known label → NULL."""
    aggs = [F.count_if(known(label)).alias(f"{prefix}n")]
    aggs += [F.round(F.avg(in_top_k(logits, label, k).cast("double")), DIGITS).alias(f"{prefix}top{k}") for k in ks]
    return df.groupBy(*by).agg(*aggs)


def _f1_parts(df: DataFrame, label: str, pred: str, by=()) -> DataFrame:
    """Per class: support, predicted count, true positives (classes of the
    truth or the prediction).  Each row is read once and gives two entries."""
    def entry(cls, sup, pr, tp):
        return F.struct(F.col(cls).cast("long").alias("c"), F.lit(sup).alias("sup"), F.lit(pr).alias("pr"), tp.cast("int").alias("tp"))

    right = F.coalesce(F.col(label) == F.col(pred), F.lit(False))
    both = F.array_compact(F.array(entry(label, 1, 0, right),
                                   F.when(F.col(pred).isNotNull(), entry(pred, 0, 1, F.lit(0)))))
    return (df.filter(known(label)).select(*by, F.explode(both).alias("e")).select(*by, "e.*").groupBy(*by, "c").agg(
        F.sum("sup").alias("sup"), F.sum("pr").alias("pr"), F.sum("tp").alias("tp")))


def macro_f1(df: DataFrame, label: str, pred: str, by=(), prefix: str = "") -> DataFrame:
    """Unweighted mean of per-class F1 over classes present in the truth or
    the prediction; a class with no true positive scores 0."""
    parts = _f1_parts(df, label, pred, by)
    f1 = (F.lit(2.0) * F.col("tp")) / (F.col("sup") + F.col("pr"))
    return parts.groupBy(*by).agg(F.count(F.lit(1)).alias(f"{prefix}n_cls"),
                                  F.round(F.avg(f1), DIGITS).alias(f"{prefix}f1"))


def action_accuracy(df: DataFrame, verb=("yv", "pv"), noun=("yn", "pn"), by=()) -> DataFrame:
    """Both heads right, over rows where both labels are known."""
    both = known(verb[0]) & known(noun[0])
    ok = (F.col(verb[0]) == F.col(verb[1])) & (F.col(noun[0]) == F.col(noun[1]))
    return df.groupBy(*by).agg(F.count_if(both).alias("action_n"),
                               F.round(F.avg(F.when(both, F.coalesce(ok, F.lit(False)).cast("double"))), DIGITS).alias("action_top1"))


def error_breakdown(df: DataFrame, verb=("yv", "pv"), noun=("yn", "pn")) -> DataFrame:
    """Action errors split into verb wrong, noun wrong, both wrong; shares of
    the error total (NULL when there is no error)."""
    e = errors(df, verb, noun)
    vw, nw = ~F.col("verb_ok"), ~F.col("noun_ok")
    out = e.agg(F.count(F.lit(1)).alias("errors"), F.count_if(vw).alias("verb_wrong"),
                F.count_if(nw).alias("noun_wrong"), F.count_if(vw & nw).alias("both_wrong"))
    return out.select("*", *[F.round(F.try_divide(F.col(c).cast("double"), F.col("errors")), DIGITS).alias(f"{c}_share")
                             for c in ("verb_wrong", "noun_wrong", "both_wrong")])


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Long-form confusion counts ``(y, p, n)`` over known labels."""
    return (df.filter(known(label)).groupBy(F.col(label).alias("y"), F.col(pred).alias("p"))
            .agg(F.count(F.lit(1)).alias("n")))


def top_confusions(df: DataFrame, label: str, pred: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent wrong ``(true, predicted)`` pairs."""
    return (confusion(df, label, pred).filter(F.col("y") != F.col("p"))
            .orderBy(F.desc("n"), "y", "p").limit(k))


def weighted_log_loss(df: DataFrame, label: str, logits: str, weights: DataFrame, by=()) -> DataFrame:
    """Class-weighted cross entropy: ``sum(w[y] * nll) / sum(w[y])`` over known
    labels.  ``weights(class_id, w)`` is one row per class and must cover every
    label (``class_weights`` over the full class space does); a label without
    a weight, or outside the logits, is an error: leaving it out would change the
    numerator and not the denominator.  The weight side is broadcast after a
    size check, so a class holding a third of the rows is not one task's work."""
    from mise.operators.labels import sized
    w = sized(weights.select(F.col("class_id").alias("_c"), F.col("w").alias("_w")))
    o = df.filter(known(label)).join(w, F.col(label) == F.col("_c"), "left")

    def required(value, what):
        message = F.concat(F.lit(f"{what} for label "), F.col(label).cast("string"))
        return F.when(value.isNull(), F.raise_error(message).cast("double")).otherwise(value)

    weight, loss = required(F.col("_w"), "no weight"), required(nll(logits, label), "no logit")
    return o.groupBy(*by).agg(F.round(F.sum(weight * loss) / F.sum(weight), DIGITS).alias("loss"))


def evaluate_heads(df: DataFrame, verb=("yv", "zv"), noun=("yn", "zn"), by=("mode",), ks=(1, 5)) -> DataFrame:
    """The ablation row set: per group (e.g. model ``mode``), top-k and
    macro-F1 per head and action top-1.  Every scored row is read once: it
    becomes one accuracy entry and, per known head, a truth and a prediction
    entry; the entries are summed per (group, head, class), and the few sums
    give the accuracies and the F1 of every class."""
    if not by:
        raise ValueError("evaluate_heads needs a group column (tag the rows, e.g. with a mode)")
    by = list(by)
    s = with_predictions(df, {"pv": verb[1], "pn": noun[1]})
    heads = {"verb": (*verb, "pv"), "noun": (*noun, "pn")}
    both = known(verb[0]) & known(noun[0])
    ok = (F.col(verb[0]) == F.col("pv")) & (F.col(noun[0]) == F.col("pn"))
    zero = F.lit(0).cast("long")

    def entry(head, cls, sup, pr, tp, *hits):
        values = [sup, pr, tp, *hits, *[zero] * (len(ks) - len(hits))]
        names = ["sup", "pr", "tp", *[f"top{k}" for k in ks]]
        return F.struct(F.lit(head).alias("head"), cls.cast("long").alias("c"),
                        *[v.cast("long").alias(n) for v, n in zip(values, names, strict=True)])

    entries = []
    for head, (y, z, p) in heads.items():
        right = F.coalesce(F.col(y) == F.col(p), F.lit(False))
        entries.append(F.when(known(y), entry(head, F.col(y), F.lit(1), zero, right, *[in_top_k(z, y, k) for k in ks])))
        entries.append(F.when(known(y) & F.col(p).isNotNull(), entry(head, F.col(p), zero, F.lit(1), zero)))
    entries.append(F.when(both, entry("action", F.lit(0), F.lit(1), zero, F.coalesce(ok, F.lit(False)))))
    # a group without any known label keeps its row through an entry of its own
    entries.append(entry("rows", F.lit(0), zero, zero, zero))
    sums = (s.select(*by, F.explode(F.array_compact(F.array(*entries))).alias("e")).select(*by, "e.*")
            .groupBy(*by, "head", "c").agg(*[F.sum(c).alias(c) for c in ("sup", "pr", "tp", *[f"top{k}" for k in ks])]))
    out = []
    f1 = (F.lit(2.0) * F.col("tp")) / (F.col("sup") + F.col("pr"))
    for head in heads:
        mine = F.col("head") == head
        n = F.coalesce(F.sum(F.when(mine, F.col("sup"))), zero)
        out.append(n.alias(f"{head}_n"))
        out += [F.round(F.try_divide(F.sum(F.when(mine, F.col(f"top{k}"))).cast("double"), n.cast("double")), DIGITS).alias(f"{head}_top{k}")
                for k in ks]
        out.append(F.round(F.avg(F.when(mine, f1)), DIGITS).alias(f"{head}_f1"))
    action = F.col("head") == "action"
    n = F.coalesce(F.sum(F.when(action, F.col("sup"))), zero)
    out += [n.alias("action_n"), F.round(F.try_divide(F.sum(F.when(action, F.col("tp"))).cast("double"), n.cast("double")), DIGITS)
            .alias("action_top1")]
    return sums.groupBy(*by).agg(*out)
