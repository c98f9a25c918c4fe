"""Prediction tables: fitted baselines, decoding, the output table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mise.functions.columns import action_label, known
from mise.operators.labels import decode_text


def fit_majority(train: DataFrame, key: str, label: str, out: str = "pred") -> DataFrame:
    """Most frequent label per key value (ties: lowest label) over known
    labels: a ``(key, out)`` table with one row per key value.  Counts are
    combined map-side; a hot key is one partial row per task."""
    counts = train.filter(known(label)).groupBy(key, label).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(key).agg(F.max(F.struct(F.col("_n"), (-F.col(label)).alias("_neg"))).alias("_b"))
    return best.select(key, (-F.col("_b._neg")).cast("long").alias(out))


def to_predictions(df: DataFrame, ids, verb=("pred_verb_class", "pred_verb"), noun=("pred_noun_class", "pred_noun")) -> DataFrame:
    """The prediction table: id columns, predicted ids, names and action."""
    return df.select(*ids, verb[0], noun[0], verb[1], noun[1],
                     action_label(verb[1], noun[1]).alias("pred_action"))


def decode_predictions(df: DataFrame, verb_map: DataFrame, verb_ref: DataFrame,
                       noun_map: DataFrame, noun_ref: DataFrame) -> DataFrame:
    """Predicted ids to text through the mappings and text references."""
    df = decode_text(df, verb_map, verb_ref, "pred_verb_class", "pred_verb")
    return decode_text(df, noun_map, noun_ref, "pred_noun_class", "pred_noun")
