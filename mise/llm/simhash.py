"""SimHash near-duplicates found with Golay-code fuzzy hashing.

Fingerprints: 64-bit majority votes over the XXH64 of word shingles.  Equal
fingerprints are one node.  To find nodes up to two bits apart, a fingerprint is
cut into segments of 23, 23 and 18 bits.  Two differing bits leave at least one
segment untouched, and any other segment differs in at most two bits, so the two
fingerprints agree on that segment and share one of the codeword indices that
the next segment and its one-bit neighbours decode to: the key is (segment,
its bits, index).  Keys are joined and every pair is verified by its bit distance.

A key with more than ``pair_limit`` fingerprints isn't paired: its fingerprints
go the exact way for crowds instead.  Each emits itself and its 64 one-bit
neighbours; fingerprints up to two bits apart share one of them, and all that
share one are up to two bits apart, so each is linked to the smallest.  This keeps all
components and costs 65 rows a fingerprint.  No cap, no lost link.

Defined results: a null or empty text has no shingle and fingerprint zero, and
links like any other; fewer words than the shingle length: one shingle of all
words; ``component_id`` is the smallest non-null ``doc_id`` reachable (null if none has one);
repeated rows each get a row; an empty table gives an empty result; ``drop_near``
keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mise.llm.common import join_groups, text_of, with_suffix_free, written
from mise.llm.components import components
from mise.llm.golay import nearby_indices
from mise.session import cut_lineage, ship_library

SHINGLE, DISTANCE, SEED = 3, 2, 42
PAIR_LIMIT = 64
_BLOCK = 1 << 16  # shingles counted at once
#: Segments as (first bit, bits).
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits over the shingle hashes; ASCII letters lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = len(words)
    if n <= shingle:
        parts = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        parts = [joined[a:b] for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(parts), _BLOCK):
        block = parts[at: at + _BLOCK]
        hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in block], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """``doc_id`` and the signed 64-bit fingerprint of each row."""
    ship_library(docs.sparkSession)
    source = docs.select(docs["doc_id"], text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint_of(t.as_py(), shingle) for t in batch.column("text")]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], [id_field, name])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    id_field = "doc_id"
    return source.mapInArrow(run, f"doc_id {id_type}, {name} long")


def _keys(nodes: DataFrame) -> DataFrame:
    """(key, fp): the fuzzy keys of each distinct fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signed = batch.column("fp").to_numpy(zero_copy_only=False)
            fp = signed.view(np.uint64)
            for at in range(0, len(fp), 1 << 14):
                part = fp[at: at + (1 << 14)]
                segments = [((part >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int32) for a, n in SEGMENTS]
                for i, exact in enumerate(segments):
                    row, index = nearby_indices(segments[(i + 1) % len(segments)])
                    key = (np.int64(i) << 35) | (exact[row].astype(np.int64) << 12) | index.astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(signed[at: at + (1 << 14)][row])], ["key", "fp"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long")


def links(nodes: DataFrame, distance: int = DISTANCE, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``(a, b)``: verified links that connect all fingerprints up to
    ``distance`` (0 to 2) bits apart."""
    if not 0 <= distance <= 2:
        raise ValueError("the segment scheme finds fingerprints up to two bits apart")
    keyed = written(_keys(nodes), "golay-keys")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(keyed.join(counts, "key"), "golay-shared")
    few = shared.filter(F.col("n") <= pair_limit).select("key", "fp")
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (apart <= distance))
    found = pairs.select("a", "b").distinct()
    if distance == 0:
        return found
    crowd = shared.filter(F.col("n") > pair_limit).select("fp").distinct()
    reach = 64 if distance == 2 else 0
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(reach)])
    if distance == 1:  # fingerprints one bit apart: the smaller one's neighbours hold the larger
        masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
        near = crowd.select("fp", F.explode(masks).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("spot"))
        met = near.join(crowd.withColumnRenamed("fp", "spot"), "spot").filter("fp < spot")
        return found.unionAll(met.select(F.col("fp").alias("a"), F.col("spot").alias("b"))).distinct()
    spots = crowd.select("fp", F.explode(masks).alias("m")).select(F.col("fp").bitwiseXOR(F.col("m")).alias("spot"), "fp")
    least = spots.groupBy("spot").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("spot", "a")
    stars = spots.join(least, "spot").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return found.unionAll(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")))
    joined = components(links(nodes, distance, pair_limit))
    linked = nodes.join(joined, nodes["fp"] == joined["node"])
    smallest = linked.groupBy("label").agg(F.min("least_id").alias("component_id"))
    where = linked.join(smallest, "label").select("fp", "component_id")
    ids = cut_lineage(nodes.join(where, "fp", "left")
                      .select("fp", "n", F.coalesce("component_id", "least_id").alias("component_id")))
    return (join_groups(prints, ids, ["fp"], "n", ["doc_id"])
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents without all but one of each component: that with the
    smallest id stays, null ids last. Documents without an id are known by their text, so
    of equal ones in a component that has no id one stays; rows with the same id and text stay or go together."""
    key = with_suffix_free(docs, "near_key")
    none = docs["doc_id"].isNull()
    own = F.struct(none.alias("none"), docs["doc_id"].alias("id"),
                   F.when(none, F.xxhash64(text_of(docs))).otherwise(F.lit(0).cast("long")).alias("text"))
    keyed = docs.withColumn(key, own)
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), docs["text"]), shingle, distance)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    left = keyed.join(gone, key, "left_anti")
    named = left.filter(~F.col(f"{key}.none"))
    unnamed = left.filter(F.col(f"{key}.none")).dropDuplicates([key])
    return named.unionByName(unnamed).select(*docs.columns)
