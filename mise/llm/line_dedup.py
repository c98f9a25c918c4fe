"""Repeated runs of lines, found by winnowing over line hashes.

The lines of a text (blank ones aside) are hashed.  From each line on, the
shortest run with ``min_lines`` lines or ``min_words`` words is a window, and a
window selects its smallest line hash (the last of equals) as its fingerprint.  Any repeated
run that long holds a window that is the same in both places and selects the same line
there: a guarantee, not a chance.  Windows whose fingerprint no other one selected (most) go no
further.  The places of the others are joined, each with the earliest place of the same
window.  The window and not the selected line alone is what places must share: a
common line's earliest place may lie among other lines than the passage that it marks.

A match is then extended while it stays a match.  To the left the line before opens a window of its own,
which lies inside the longer run, so nothing is looked up twice.  To the right lines may follow
that open no whole window inside the run; those are at most ``min_lines`` lines from the match's first line
on (else they would open one), so the window grown by each of these lines is joined with
its own earliest place in the same pass.  Matches that follow one another make a run when the lines they
cover are put together: exactly the lines that lie in some run of ``min_lines`` lines or
``min_words`` words that occurs earlier.  They are deleted; the
earliest occurrence, by ``doc_id`` and line, stays.

Defined results: a null text counts as empty; a null ``doc_id`` comes last, in the order
of the text's hash; lines are compared after trimming and turning white space
into one space; blank lines are never deleted; a run that overlaps its own first
occurrence keeps the lines that belong to that; rows repeated with the same id
and text are one document and give equal rows; an empty table gives an
empty result; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mise.llm.common import join_groups, text_of, written
from mise.session import cut_lineage, ship_library

MIN_LINES, MIN_WORDS = 3, 50


def windows_of(text: str, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, bytes, int]]:
    """(first line, lines, content, fingerprint) of each window and of the window grown to the
    right up to ``min_lines`` lines; lines are counted without blank ones."""
    parts = [p for line in text.split("\n") if (p := line.encode("utf-8", "surrogatepass").split())]
    lines = [b" ".join(p) for p in parts]
    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
    reach = np.cumsum([0, *map(len, parts)])
    for at in range(len(lines)):
        size = min(max(int(np.searchsorted(reach, reach[at] + min_words)) - at, 1), min_lines)
        if at + size > len(lines):
            continue
        mark = min(hashes[at: at + size])
        for grown in range(size, min(max(size, min_lines), len(lines) - at) + 1):
            yield at, grown, b"\n".join(lines[at: at + grown]), mark


def _windows(docs: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    ship_library(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, text_hash, at, size, mark, low, high, first = [], [], [], [], [], [], [], []

            def out() -> pa.RecordBatch:
                made = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(np.array(text_hash, np.uint64).view(np.int64)),
                     pa.array(at, pa.int32()), pa.array(size, pa.int32()), pa.array(np.array(mark, np.uint64).view(np.int64)),
                     pa.array(np.array(low, np.uint64).view(np.int64)), pa.array(np.array(high, np.uint64).view(np.int64)),
                     pa.array(first, pa.bool_())],
                    ["doc_id", "text_hash", "at", "size", "mark", "low", "high", "first"])
                for held in (row, text_hash, at, size, mark, low, high, first):
                    held.clear()
                return made

            for i, value in enumerate(batch.column("text")):
                text = value.as_py()
                own = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
                before = -1
                for start, n, content, smallest in windows_of(text, min_lines, min_words):
                    first.append(start != before)
                    before = start
                    full = xxhash.xxh3_128_intdigest(content)
                    row.append(i)
                    text_hash.append(own)
                    at.append(start)
                    size.append(n)
                    mark.append(smallest)
                    low.append(full & (1 << 64) - 1)
                    high.append(full >> 64)
                if len(row) > 100_000:
                    yield out()
            yield out()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select(docs["doc_id"], text_of(docs).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, text_hash long, at int, size int, mark long, low long, high long, first boolean"))


def later_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_hash, spans``: per document the (first line, end) of the
    windows to delete, lines counted without blank ones."""
    found = written(_windows(docs, min_lines, min_words), "line-windows")
    # a window and what it has grown to are one place
    marks = cut_lineage(found.groupBy("mark").agg(F.count("*").alias("n"), F.count_if("first").alias("places"))
                        .filter("places > 1").select("mark", "n"))
    shared = join_groups(found, marks, ["mark"], "n", ["doc_id", "at"]).drop("mark", "first")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash"))
                     .otherwise(F.lit(0).cast("long")).alias("tie"), "at", "text_hash")
    shared = shared.withColumn("place", place)
    first = cut_lineage(shared.groupBy("low", "high").agg(F.min("place").alias("first"), F.count("*").alias("n"))
                        .filter("n > 1"))
    late = join_groups(shared, first, ["low", "high"], "n", ["doc_id", "at"]).filter("place > first")
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash"))
    start = F.when(same, F.greatest("at", F.col("first.at") + F.col("size"))).otherwise(F.col("at"))
    return (late.select("doc_id", "text_hash", start.alias("start"), (F.col("at") + F.col("size")).alias("stop"))
            .filter("start < stop").groupBy("doc_id", "text_hash")
            .agg(F.collect_set(F.struct("start", "stop")).alias("spans")))


def without_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text, n_lines, n_deleted``: each document without later runs."""
    runs = later_runs(docs, min_lines, min_words)
    own = docs.select(docs["doc_id"], text_of(docs).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    joined = own.join(runs.withColumnRenamed("doc_id", "run_id"),
                      F.col("doc_id").eqNullSafe(F.col("run_id")) & (own["text_hash"] == runs["text_hash"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_gone = [], [], []
            for value, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                lines = value.as_py().split("\n")
                real = [i for i, line in enumerate(lines) if line.encode("utf-8", "surrogatepass").split()]
                gone: set[int] = set()
                for span in spans.as_py() or ():
                    gone.update(real[span["start"]: span["stop"]])
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
                n_lines.append(len(real))
                n_gone.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())],
                ["doc_id", "text", "n_lines", "n_deleted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, text string, n_lines long, n_deleted long")


