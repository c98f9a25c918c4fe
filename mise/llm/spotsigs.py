"""SpotSigs fingerprints (DataFrame functions only).

Wherever an anchor (a common word from a fixed list, and the beginning of the text) stands, the anchor and
the next ``CHAIN`` content words behind it form a spot signature; common words in between are
skipped, and at the end of a text a chain has the words that are left.  A text's fingerprint is the
sorted set of its signatures' hashes (32 bits, hex).  The list holds all common words and not
articles and forms of "to be" alone, and the beginning counts, so short texts have spots too and
every text is read by the same rule.  Likeness is the Jaccard index of
two sets.  ``near_pairs`` finds all pairs at or above a threshold: sets are
partitioned by length (a set can only be like sets of similar length), each gives its
rarest signatures as keys, and candidates are verified.

Defined results: null and empty texts, and texts without a letter or digit, have the empty
fingerprint (no other text has); two empty fingerprints have likeness 1, an empty and another one 0;
documents follow one another by descending id, nulls last, equal ids by text;
the first document follows the last, so a single one follows itself; repeated
rows each get a row; an empty table gives an empty result; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mise.llm.common import text_of
from mise.session import cut_lineage

CHAIN = 2
THRESHOLD = 0.8
BLOCK_ROWS, MOST_BLOCKS = 2_000, 2_000

#: Common words, from which signatures start and which chains skip.
ANCHORS = ("the a an is was it that there this are of and to in for on with be as by at from or not but "
           "have has had he she they we you his her its "
           "der die das ist ein eine war es und in von mit zu den dem des sich auf für nicht als im auch an bei nach "
           "le la les un une est de du et en que qui pour dans sur par pas au aux avec ne se "
           "el los las una son lo y por con para su al del no como más").split()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once (a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash(*parts: Column) -> Column:
    return F.shiftright(F.xxhash64(*parts), 32).cast("int")


def signatures(text: Column) -> Column:
    """The sorted set of signature hashes of a text, ``array<int>``."""
    anchors = sorted(set(ANCHORS))

    def chains(words: Column) -> Column:
        content = F.filter(words, lambda w: ~w.isin(anchors))
        begin = F.when(F.size(words) > 0, F.struct(F.lit("").alias("w"), F.lit(0).alias("i")))
        marked = F.filter(F.transform(words, lambda w, i: F.when(w.isin(anchors), F.struct(w.alias("w"), i.alias("i")))),
                          lambda s: s.isNotNull())

        def made(both: Column) -> Column:
            def spot(word: Column, at: Column) -> Column:
                return _hash(word, *[F.get(both["content"], at + c) for c in range(CHAIN)])

            # the k-th common word, at i, has i - k content words before it
            spots = F.transform(both["marked"], lambda s, k: spot(s["w"], s["i"] - k))
            first = F.when(both["begin"].isNotNull(), spot(both["begin"]["w"], both["begin"]["i"]))
            return F.array_union(spots, F.array_compact(F.array(first)))

        return _let(F.struct(content.alias("content"), marked.alias("marked"), begin.alias("begin")), made)

    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.array_sort(_let(words, chains))


def shown(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sets."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - both
    return F.when(total == 0, F.lit(1.0)).otherwise(both / total)


def _blocks(ids: DataFrame) -> list[int | None]:
    """Largest id of each block of neighbouring ids, descending, then None if
    there are null ids.  The number of blocks is bounded."""
    known = ids.filter("doc_id is not null")
    n = known.count()
    out: list[int | None] = []
    if n:
        blocks = max(1, min(MOST_BLOCKS, n // BLOCK_ROWS))
        shares = [i / blocks for i in range(1, blocks)] + [1.0]
        out = sorted({int(x) for x in known.agg(F.percentile_approx("doc_id", shares, 10_000).alias("q")).first()["q"]}, reverse=True)
        top = known.agg(F.max("doc_id")).first()[0]
        out = [top, *[x for x in out if x < top]]
    if not ids.filter("doc_id is null").isEmpty():
        out.append(None)
    return out


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``doc_id`` and the columns (the first is the text) of each document and, as
    ``next_*``, of the document after it in descending order of ids.  Texts are
    shuffled once; the first row of each block is also sent to the block before."""
    rows = docs.select("doc_id", *columns)
    tops = _blocks(docs.select("doc_id"))
    if not tops:
        return rows.select("*", *[F.lit(None).cast(rows.schema[c].dataType).alias(f"next_{c}") for c in columns])
    known = [t for t in tops if t is not None]
    bounds = F.array(*[F.lit(t).cast("long") for t in known])
    block = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.size(F.filter(bounds, lambda t: t >= F.col("doc_id"))))
    own = rows.withColumn("block", block).withColumn("extra", F.lit(0))
    numbers = [i + 1 for i in range(len(known))] + [-1] * (len(tops) > len(known))
    before = {top: numbers[i - 1] for i, top in enumerate(tops)}  # the first goes behind the last
    heads = []
    if known:
        target = F.create_map(*[F.lit(x) for t in known for x in (t, before[t])])
        heads.append(rows.filter(F.col("doc_id").isin(known)).withColumn("block", target[F.col("doc_id").cast("long")]))
    if len(tops) > len(known):
        heads.append(rows.filter("doc_id is null").orderBy(columns[0]).limit(1).withColumn("block", F.lit(before[None])))
    for h in heads:
        own = own.unionByName(h.withColumn("extra", F.lit(1)))
    order = Window.partitionBy("block").orderBy("extra", F.desc_nulls_last("doc_id"), columns[0])
    return (own.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
            .filter("extra = 0").drop("extra", "block"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every document."""
    base = docs.select(docs["doc_id"], text_of(docs).alias("text")).withColumn("sigs", signatures(F.col("text")))
    pairs = with_next(base, ["text", "sigs"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut))
    rows = (pairs.select("doc_id", n.cast("long").alias("n_chars"), "sigs", edited.alias("edited"),
                         likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
            .withColumn("edited_sigs", signatures(F.col("edited"))))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), shown(F.col("sigs")).alias("fingerprint"),
                       shown(F.col("edited_sigs")).alias("edited_fingerprint"),
                       likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), "near_next")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, likeness``: pairs of different fingerprints with at least this likeness,
    each fingerprint standing for its documents by their smallest id (a < b).
    Equal fingerprints are one class; rows without an id are left to ``fingerprints``."""
    base = docs.select(docs["doc_id"], signatures(text_of(docs)).alias("sigs")).filter("doc_id is not null")
    classes = cut_lineage(base.groupBy("sigs").agg(F.min("doc_id").alias("id")).filter(F.size("sigs") > 0)
                          .withColumn("n", F.size("sigs")))
    spread = classes.select("id", "n", F.explode("sigs").alias("sig"))
    often = spread.groupBy("sig").agg(F.count("*").alias("df"))
    # a set's n - ceil(t n) + 1 rarest signatures: like sets have one of them in common
    rarest = (spread.join(often, "sig").groupBy("id", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("all"))
              .select("id", "n", F.explode(F.slice("all", F.lit(1), F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)).alias("k"))
              .select("id", "n", F.col("k.sig").alias("sig")))
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / threshold)) + 1e-9)
    left = rarest.select(F.col("id").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array(band, band + 1)).alias("band"))
    right = rarest.select(F.col("id").alias("b"), F.col("n").alias("nb"), "sig", band.alias("band"))
    found = (left.join(right, ["sig", "band"])
             .filter((F.col("a") != F.col("b")) & (F.col("na") <= F.col("nb")) & (F.col("na") >= F.col("nb") * threshold - 1e-9))
             .select("a", "b").distinct())
    one, two = classes.select(F.col("id").alias("a"), F.col("sigs").alias("sa")), classes.select(F.col("id").alias("b"), F.col("sigs").alias("sb"))
    return (found.join(one, "a").join(two, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
            .filter(F.col("likeness") >= threshold)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness").distinct())
