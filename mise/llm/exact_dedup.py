"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is normalised, then cut into chunks at places that its own content
chooses (after a word with a chosen ending, within a minimum and a maximum
length), so equal texts are cut alike.  Every distinct chunk text travels at
most once per map task: distinct ``(hash, chunk)`` pairs are grouped by hash,
and a hash that stands for two different chunk texts is found and told apart by
an ordinal, so the identifiers are verified, not trusted.  Documents are then
compared by their ordered identifier lists, a few bytes for each kilobyte.

Defined results: a null text counts as empty and equal to other empty texts;
the row with the smallest ``doc_id`` stays (nulls last: a group whose ids are
all null keeps a null id); repeated rows with the same id and text are one
document and ``copy_groups`` flags them alike, ``drop_copies`` leaves one of
them; an empty table gives an empty result; further columns are carried along
untouched by ``drop_copies``, also when they are named like the working columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mise.llm.common import SPACE, join_groups, text_of, with_suffix_free, written
from mise.session import cut_lineage

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: A chunk ends after a word with one of these endings, or at the maximum.
ENDING = "[aeiou][dnt] "


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def chunks(text: Column, smallest: int = MIN_CHUNK, largest: int = MAX_CHUNK, ending: str = ENDING) -> Column:
    """The text cut into content-defined chunks; joined they give the text."""
    rule = f"(?s).{{{smallest},{largest}}}?{ending}|.{{1,{largest}}}"
    return F.regexp_extract_all(text, F.lit(rule), F.lit(0))


def _identifiers(parts: Column, bits: int) -> Column:
    return F.transform(parts, lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - bits) if bits < 64 else F.xxhash64(c))


def _clashes(texts: DataFrame, bits: int) -> DataFrame:
    """Hashes that stand for more than one chunk text (h); empty as a rule."""
    chunk = F.explode("parts").alias("chunk")
    pairs = (texts.select(chunk)
             .select(_identifiers(F.array("chunk"), bits)[0].alias("h"), "chunk")
             .dropDuplicates(["h", "chunk"]))
    return pairs.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")


def recipes(df: DataFrame, name: str = "recipe", bits: int = 64, **cut) -> DataFrame:
    """``df`` with its ordered list of verified chunk identifiers.

    ``bits`` narrows the hash, which only tests need: where two chunk texts share
    a hash, the identifier is the hash with the chunk's ordinal among them."""
    norm = normalised(text_of(df))
    clashes = cut_lineage(_clashes(df.select(chunks(norm, **cut).alias("parts")), bits))
    if clashes.isEmpty():
        return df.withColumn(name, _identifiers(chunks(norm, **cut), bits))
    # told apart: only chunks whose hash clashes are gathered, each text once
    pairs = (df.select(F.explode(chunks(norm, **cut)).alias("chunk"))
             .select(_identifiers(F.array("chunk"), bits)[0].alias("h"), "chunk")
             .join(clashes, "h", "left_semi").dropDuplicates(["h", "chunk"]))
    ordinals = pairs.select("chunk", F.concat_ws(":", "h", F.sha2("chunk", 256)).alias("verified"))
    key, pos = with_suffix_free(df, "row_key"), with_suffix_free(df, "pos")
    keyed = cut_lineage(df.withColumn(key, F.monotonically_increasing_id()))
    one = (keyed.select(key, F.posexplode(chunks(normalised(text_of(keyed)), **cut)).alias(pos, "chunk"))
           .withColumn("h", _identifiers(F.array("chunk"), bits)[0].cast("string"))
           .join(ordinals, "chunk", "left")
           .groupBy(key).agg(F.sort_array(F.collect_list(F.struct(pos, F.coalesce("verified", "h").alias("id")))).alias(name)))
    return (keyed.join(one.select(key, F.transform(name, lambda s: s["id"]).alias(name)), key, "left")
            .withColumn(name, F.coalesce(name, F.array().cast("array<string>"))).drop(key))


def _groups(rows: DataFrame, recipe: str) -> DataFrame:
    """Per recipe: the id that stays, and the rows; summed per id first."""
    by_id = rows.groupBy(recipe, "doc_id").agg(F.count("*").alias("n"))
    return by_id.groupBy(recipe).agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))


def copy_groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    slim = docs.select(docs["doc_id"], docs["text"])
    rows = recipes(slim, bits=bits)
    rows = written(rows.select("doc_id", "recipe", F.sha2(normalised(text_of(rows)), 256).alias("text_sha256")), "recipes")
    groups = cut_lineage(_groups(rows, "recipe").withColumn("n", F.col("group_size")))
    return (join_groups(rows, groups, ["recipe"], "n", ["doc_id"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, one row of each group of equal texts."""
    recipe, doc_id = with_suffix_free(docs, "recipe"), with_suffix_free(docs, "kept_id")
    rows = recipes(docs, name=recipe)
    by_id = rows.groupBy(recipe, "doc_id").agg(F.count("*").alias("n"))
    groups = cut_lineage(by_id.groupBy(recipe).agg(F.min("doc_id").alias(doc_id), F.sum("n").alias("n"),
                                                   F.min_by("n", F.struct(F.col("doc_id").isNull(), "doc_id")).alias("same")))
    repeated = not groups.filter("same > 1").isEmpty()
    out = (join_groups(rows, groups.drop("same"), [recipe], "n", ["doc_id"])
           .filter(F.col("doc_id").eqNullSafe(F.col(doc_id))))
    if repeated:  # rows repeated with the same id and text
        out = out.dropDuplicates([recipe, "doc_id"])
    return out.select(docs.columns)
