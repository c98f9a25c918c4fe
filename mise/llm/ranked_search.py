"""Ranked lexical search over tries of documents, by branch and bound.

Items are short texts; each gets its best documents by a weighted sum over its terms.  A
document is cut down to the items' terms, ordered by their frequency in the corpus, rarest first,
with its counts.  A block of documents forms a prefix tree of these vectors: documents with the same
rare terms share a path, documents with equal vectors and lengths share a leaf.
A node knows, for every term below it, the largest count of any document, and the smallest length
factor; the score made of these is a bound for all of them, and at a leaf it is the score.
Each node keeps what it knows of its children by term (a header table), so an item looks at its
own terms only.

An item goes depth first: children whose bound doesn't reach the score of the item's
last place so far are left, the most promising of the others come first.  A task carries each
item's best from block to block and returns them; the tasks' lists are merged by rank.
Nothing is dealt by term or document, so a frequent term or a large group of copies is no task's own.

Items are broadcast, in blocks of bounded bytes (documents are read again for each block of items).

Defined results: a null or empty text has no term; a document needs a score above 0; equal
scores go by ascending ``doc_id``, null last; rows with equal ids and texts are documents of
their own, each with a rank; repeated items count once, items of one id with different texts are
ranked apart; empty tables give an empty result; whole texts are read; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mise.llm.common import text_of, written
from mise.session import ship_library

BEST = 10
#: Terms of documents that one tree holds, and its deepest level (below it documents are leaves side by side).
TREE_TERMS, DEEPEST = 1 << 20, 24
#: Bytes of item texts that are broadcast at a time.
ITEM_BYTES = 16 << 20
#: Fixed values of the score.
FULL, LENGTH_SHARE, TF_FACTOR, M_FACTOR = 1_000_000_000, 75, 1_000, 8

#: ASCII letters and digits and all code points above ASCII make terms; only A-Z is lower-cased.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass
class Tree:
    """Nodes of a block of documents; node 0 is the root.  What the children of a node hold lies
    in ``keys`` (node * terms + term, ascending), ``child`` and ``most`` (largest count)."""

    terms: int
    keys: np.ndarray
    child: np.ndarray
    most: np.ndarray
    first: np.ndarray   # a node's children are the numbers from ``first`` to ``stop``
    stop: np.ndarray
    least_m: np.ndarray
    leaf: np.ndarray    # the leaf's vector, -1 for other nodes


def grow(starts: np.ndarray, ranks: np.ndarray, counts: np.ndarray, m: np.ndarray, terms: int, deepest: int = DEEPEST) -> Tree:
    """The tree of vectors in lexicographic order: vector i has the ranks and counts from
    ``starts[i]`` to ``starts[i + 1]`` and the length factor ``m[i]``."""
    n = len(starts) - 1
    sizes = np.diff(starts)
    # what neighbours have in common
    shared = np.zeros(max(n - 1, 0), np.int64)
    if n > 1:
        both = np.minimum(sizes[:-1], sizes[1:])
        pair = np.repeat(np.arange(n - 1), both)
        step = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
        other = ranks[starts[pair] + step] != ranks[starts[pair + 1] + step]
        shared = both.copy()
        np.minimum.at(shared, pair[other], step[other])
    # level by level: a group of vectors splits where its neighbours share least
    first, stop, leaf, low = [0], [0], [-1], [int(m.min()) if n else 0]
    parts_key, parts_child, parts_most = [], [], []
    level = [(0, 0, n)]
    depth = 0
    while level:
        below, owner, node_of = [], np.full(n, -1), np.full(n, -1)
        for node, a, b in level:
            if depth < deepest and b - a > 1:
                cuts = shared[a: b - 1]
                edges = [a, *(np.nonzero(cuts == cuts.min())[0] + a + 1).tolist(), b]
            else:
                edges = range(a, b + 1)
            first[node] = len(first)
            for x, y in zip(edges, edges[1:]):
                new = len(first)
                first.append(0)
                stop.append(0)
                low.append(int(m[x:y].min()))
                leaf.append(x if y - x == 1 else -1)
                owner[x:y], node_of[x:y] = node, new
                if y - x > 1:
                    below.append((new, x, y))
            stop[node] = len(first)
        inside = np.repeat(owner >= 0, sizes)
        own, held, rank, count = (np.repeat(owner, sizes)[inside], np.repeat(node_of, sizes)[inside], ranks[inside], counts[inside])
        key = own * terms + rank
        order = np.lexsort((held, key))
        key, held, count = key[order], held[order], count[order]
        new_entry = np.ones(len(key), bool)
        new_entry[1:] = (key[1:] != key[:-1]) | (held[1:] != held[:-1])
        at = np.nonzero(new_entry)[0]
        parts_key.append(key[at])
        parts_child.append(held[at])
        parts_most.append(np.maximum.reduceat(count, at) if len(at) else count)
        level, depth = below, depth + 1
    keys = np.concatenate(parts_key)  # levels come in ascending order of nodes
    return Tree(terms, keys, np.concatenate(parts_child), np.concatenate(parts_most),
                np.array(first), np.array(stop), np.array(low, np.int64), np.array(leaf))


def bounds(tree: Tree, node: int, item_terms: np.ndarray, item_weights: np.ndarray) -> np.ndarray:
    """Per child of ``node`` the largest score that a document below it can have."""
    first = int(tree.first[node])
    out = np.zeros(int(tree.stop[node]) - first, np.int64)
    wanted = node * tree.terms + item_terms
    a, b = np.searchsorted(tree.keys, wanted), np.searchsorted(tree.keys, wanted, side="right")
    sizes = b - a
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(a, sizes)
    child, tf = tree.child[at], tree.most[at]
    part = FULL * tf // (TF_FACTOR * tf + M_FACTOR * tree.least_m[child])
    np.add.at(out, child - first, np.repeat(item_weights, sizes) * part)
    return out


def search(tree: Tree, item_terms: np.ndarray, item_weights: np.ndarray, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Depth first: yields vectors with their scores and takes the new score of the last place by ``send``."""
    stack = [(last, 0)]
    while stack:
        bound, node = stack.pop()
        if bound < last:
            continue
        scores = bounds(tree, node, item_terms, item_weights)
        children = np.arange(int(tree.first[node]), int(tree.stop[node]))
        able = scores >= last
        scores, children = scores[able], children[able]
        leaves = tree.leaf[children] >= 0
        if leaves.any():
            # vectors are numbered by their order, so equal scores keep it
            found, vectors = scores[leaves], tree.leaf[children[leaves]]
            last = yield vectors, found
        inner, high = children[~leaves], scores[~leaves]
        order = np.argsort(high, kind="stable")
        stack += [(int(high[i]), int(inner[i])) for i in order if high[i] >= last]


class Block:
    """Documents of a block as distinct vectors in order, with their tree."""

    def __init__(self, ids: list, ranks: list[np.ndarray], counts: list[np.ndarray], m: np.ndarray, terms: int, best: int) -> None:
        same: dict[tuple[bytes, bytes, int], list] = {}
        for i, (r, c) in enumerate(zip(ranks, counts, strict=True)):
            same.setdefault((r.astype(">u4").tobytes(), c.tobytes(), int(m[i])), []).append(i)
        order = sorted(same)
        groups = [same[k] for k in order]
        # documents of one vector score alike: more than ``best`` of them can't be among the best
        self.ids = [sorted((ids[i] for i in g), key=by_id)[:best] for g in groups]
        heads = [g[0] for g in groups]
        starts = np.concatenate([[0], np.cumsum([len(ranks[i]) for i in heads])]).astype(np.int64)
        self.tree = grow(starts, np.concatenate([ranks[i] for i in heads]).astype(np.int64),
                         np.concatenate([counts[i] for i in heads]).astype(np.int64), m[heads], terms)


def by_id(doc_id) -> tuple:
    return (doc_id is None, doc_id if doc_id is not None else 0)


def improve(tops: list[list[tuple]], block: Block, items: list[tuple[np.ndarray, np.ndarray]], best: int) -> None:
    """Every item's best list (score descending, id ascending) with the block's documents in it."""
    for top, (item_terms, item_weights) in zip(tops, items, strict=True):
        last = top[-1][0] if len(top) == best else 1
        walk = search(block.tree, item_terms, item_weights, last)
        step = next(walk, None)
        while step is not None:
            vectors, scores = step
            if len(scores) > best:  # the block's best scores, and all that tie with the last of them
                edge = np.partition(scores, len(scores) - best)[len(scores) - best]
                vectors, scores = vectors[scores >= edge], scores[scores >= edge]
            top += [(int(s), d) for v, s in zip(vectors, scores, strict=True) for d in block.ids[v]]
            top.sort(key=lambda r: (-r[0], *by_id(r[1])))
            del top[best:]
            last = top[-1][0] if len(top) == best else 1
            try:
                step = walk.send(last)
            except StopIteration:
                step = None


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts``: all terms' number, and the vocabulary's terms with their counts."""
    spark = docs.sparkSession
    ship_library(spark)
    known = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value
        for batch in batches:
            lengths, terms, counts = [], [], []
            for text in batch.column("text"):
                found = Counter(terms_of(text.as_py()))
                own = found.keys() & words.keys()
                lengths.append(found.total())
                terms.append([words[t] for t in own])
                counts.append([found[t] for t in own])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(terms, kind),
                                              pa.array(counts, kind)], ["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select(docs["doc_id"], text_of(docs).cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, counts array<int>"))


def weights(found: DataFrame, n_docs: int) -> dict[int, tuple[int, int]]:
    """Per vocabulary term its document frequency and weight (a row per term of the items' block)."""
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.ln((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1)))
    return {r["term"]: (r["df"], r["w"]) for r in df.select("term", "df", weight.alias("w")).collect()}


def _ranked_block(docs: DataFrame, items: list[tuple], kind: str, best: int) -> DataFrame:
    """The best documents of a block of items, ``(item_id, text)`` each."""
    spark = docs.sparkSession
    counted = [Counter(terms_of((text or "").encode("utf-8", "surrogatepass"))) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    found = written(vectors(docs, vocabulary), "ranked-vectors")
    n_docs, n_terms = found.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    by_term = weights(found, n_docs)
    # rarest first; terms of no document take no part
    order = sorted(by_term, key=lambda t: (by_term[t][0], t))
    rank = np.full(len(vocabulary) + 1, -1, np.int64)
    rank[order] = np.arange(len(order))
    asked = []
    for counts in counted:
        own = sorted((int(rank[vocabulary[t]]), n * by_term[vocabulary[t]][1]) for t, n in counts.items() if vocabulary[t] in by_term)
        asked.append((np.array([r for r, _ in own], np.int64), np.array([w for _, w in own], np.int64)))
    given = spark.sparkContext.broadcast((rank, asked, [i for i, _ in items]))
    doc_kind = found.schema["doc_id"].dataType.simpleString()
    n_ranks = max(len(order), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks_of, asked_for, item_ids = given.value
        tops: list[list[tuple]] = [[] for _ in asked_for]
        kinds = {}
        held: list[tuple] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                ids, lengths, ranks, counts = (list(x) for x in zip(*held, strict=True))
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * np.array(lengths, np.int64) * n_docs) // n_terms
                improve(tops, Block(ids, ranks, counts, m, n_ranks, best), asked_for, best)
                held.clear()
                size = 0

        for batch in batches:
            kinds["doc"] = batch.schema.field("doc_id").type
            terms, counts = batch.column("terms"), batch.column("counts")
            flat, many, at = (ranks_of[terms.values.to_numpy()], counts.values.to_numpy(), terms.offsets.to_numpy())
            ids, lengths = batch.column("doc_id").to_pylist(), batch.column("n").to_pylist()
            for i in range(batch.num_rows):
                r, c = flat[at[i]: at[i + 1]], many[at[i]: at[i + 1]]
                if len(r):
                    by_rank = np.argsort(r)
                    held.append((ids[i], lengths[i], r[by_rank], c[by_rank]))
                    size += len(r)
                if size >= TREE_TERMS:
                    flush()
        flush()
        rows = [(item, *r) for item, top in enumerate(tops) for r in top]
        if rows:
            item, score, doc = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, kinds["doc"]), pa.array(score, pa.int64())],
                                             ["item", "doc_id", "score"])

    parts = found.filter("size(terms) > 0").mapInArrow(run, f"item int, doc_id {doc_kind}, score long")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best_rows = parts.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= best)
    names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(items)], f"item int, item_id {kind}")
    return best_rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item with a score above 0."""
    own = items.select(items["item_id"], text_of(items).alias("text")).distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / item_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for b in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in own.filter(part == b).orderBy("item_id", "text").collect()]
        if rows:
            made = _ranked_block(docs, rows, kind, best)
            out = made if out is None else out.unionByName(made)
    if out is None:
        doc_kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id {doc_kind}, score long")
    return out
