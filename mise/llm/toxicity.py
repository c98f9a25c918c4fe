"""Toxicity scores from a counterfactual-regularised classifier.

Features are words, word beginnings and word endings that occur at least 1, 2, 4
or 8 times.  Those that
separate the labels are chosen from document counts made in Spark; a logistic
regression on them is then fitted with one more term: every labelled text that
holds identity terms is also seen with the terms swapped for others of their
group, and the squared difference of the two log-odds is penalised, so a
neutral mention of a group can't carry a score.

The fit uses at most ``sample`` labelled rows (half of them of either label at
most, those with the smallest hash of the id, so reruns agree), the only bound
here.  All rows are scored, whole texts, in Arrow batches; the model that
travels is bounded by ``features``.

Defined results: a null or empty text has no feature and gets the prior's score;
null ids are scored but never learnt from; of several labels for an id the
largest counts, null labels don't; without both labels in the sample every score is the
smoothed share of label 1; repeated rows each get a row; an empty table gives
an empty result; ``reject`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mise.llm.common import text_of, with_suffix_free, written
from mise.session import ship_library

SAMPLE = 30_000
FEATURES = 600
#: A feature counts once for each of these numbers of occurrences that it reaches.
LEVELS = (1, 2, 4, 8)
CANDIDATES = 200_000
THRESHOLD = 0.7
CACHE_WORDS = 1 << 18

#: Identity terms, a line for each group of terms that may stand for one another.
IDENTITY = (
    "women men", "woman man", "girls boys", "muslims christians jews hindus buddhists atheists",
    "muslim christian jewish hindu buddhist atheist", "gay lesbian straight bisexual transgender",
    "black white asian latino arab", "african european american mexican chinese indian",
    "immigrants refugees natives", "disabled deaf blind", "old young",
    "frauen männer", "frau mann", "muslime christen juden", "ausländer flüchtlinge deutsche",
    "femmes hommes", "femme homme", "musulmans chrétiens juifs", "immigrés réfugiés français",
    "mujeres hombres", "mujer hombre", "musulmanes cristianos judíos", "inmigrantes refugiados españoles",
)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features_of(word: str) -> list[str]:
    """The word, its beginnings and its endings, told apart by a mark."""
    out = ["=" + word]
    out += [f"^{word[:k]}" for k in range(3, min(6, len(word)) + 1)]
    out += [f"{word[-k:]}$" for k in range(4, min(6, len(word)) + 1)]
    return out


def counts_of(words: Iterable[str]) -> Counter[str]:
    """How often each feature occurs."""
    found: Counter[str] = Counter()
    for word, n in Counter(words).items():
        for f in features_of(word):
            found[f] += n
    return found


def levels_of(counts: Counter[str]) -> Iterator[str]:
    """The features with the levels that their counts reach."""
    for f, n in counts.items():
        for level in LEVELS:
            if n < level:
                break
            yield f"{level}{f}"


@dataclass(frozen=True)
class Model:
    """``weights[index[feature], level]``; a level not chosen has weight 0."""

    index: dict[str, int]
    weights: np.ndarray
    bias: float

    @staticmethod
    def of(names: Sequence[str], weights: np.ndarray, bias: float) -> Model:
        bare = sorted({n.lstrip("0123456789") for n in names})
        index = {f: i for i, f in enumerate(bare)}
        table = np.zeros((len(bare), len(LEVELS)))
        for name, w in zip(names, weights, strict=True):
            f = name.lstrip("0123456789")
            table[index[f], LEVELS.index(int(name[: len(name) - len(f)]))] = w
        return Model(index, table, bias)

    def scorer(self) -> Callable[[str], float]:
        """Scores texts; the features of words are remembered (bounded)."""
        known: dict[str, tuple[int, ...]] = {}
        sums = np.cumsum(self.weights, axis=1)
        reached = np.searchsorted(LEVELS, np.arange(LEVELS[-1] + 1), side="right") - 1

        def look(word: str) -> tuple[int, ...]:
            hit = tuple(i for f in features_of(word) if (i := self.index.get(f)) is not None)
            if len(known) < CACHE_WORDS:
                known[word] = hit
            return hit

        def score(text: str) -> float:
            found: Counter[int] = Counter()
            for word, n in Counter(words_of(text)).items():
                hit = known.get(word)
                if hit is None:
                    hit = look(word)
                for i in hit:
                    found[i] += n
            z = self.bias + sum(float(sums[i, reached[min(found[i], LEVELS[-1])]]) for i in sorted(found))
            return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

        return score


def swaps(identity: Sequence[str] = IDENTITY) -> dict[str, str]:
    """Each identity term to the next one of its group."""
    table: dict[str, str] = {}
    for line in identity:
        group = line.split()
        table |= {a: b for a, b in zip(group, group[1:] + group[:1], strict=True) if a not in table}
    return table


def swapped(words: Sequence[str], table: dict[str, str]) -> list[str]:
    return [table.get(w, w) for w in words]


def _sample(labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled ids, half of them of one label at most."""
    one = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return (one.filter("toxic = 1").orderBy(*order).limit(sample // 2)
            .unionAll(one.filter("toxic = 0").orderBy(*order).limit(sample // 2)))


def _document_counts(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """Per feature the documents of either label that hold it, summed per batch first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                 pa.array([c[1] for c in counts.values()], pa.int64())], ["feature", "clean", "toxic"])
            counts.clear()
            return made

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic"), strict=True):
                found = set(levels_of(counts_of(words_of(text.as_py()))))
                side = 1 if label.as_py() == 1 else 0
                for f in found if wanted is None else found & wanted:
                    counts.setdefault(f, [0, 0])[side] += 1
                if len(counts) > 200_000:
                    yield out()
        yield out()

    return (rows.mapInArrow(run, "feature string, clean long, toxic long").groupBy("feature")
            .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))


def _matrix(rows: DataFrame, index: dict[str, int], table: dict[str, str]) -> list:
    """(label, columns, columns after swapping) of the sample, which is bounded."""
    def columns(words: Sequence[str]) -> list[int]:
        return sorted(index[f] for f in levels_of(counts_of(words)) if f in index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                own.append(columns(words))
                other.append(columns(swapped(words, table)) if any(w in table for w in words) else None)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(own, kind), pa.array(other, kind)],
                                             ["toxic", "own", "other"])

    return rows.mapInArrow(run, "toxic int, own array<int>, other array<int>").collect()


def train(x: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], n: int,
          ridge: float = 0.1, counterfactual: float = 10.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Newton's method on the logistic loss with a ridge and the counterfactual
    term ``counterfactual * sum((w.x - w.x')^2) / 2``."""
    merged: dict[tuple[int, ...], list[float]] = {}  # equal rows are one, with rows and labels summed
    for row, label in zip(x, y.tolist(), strict=True):
        one = merged.setdefault(tuple(row), [0.0, 0.0])
        one[0] += 1
        one[1] += label
    rows, sums = list(merged), np.array(list(merged.values()))

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, len(rows), 2048):
            part = rows[at: at + 2048]
            dense = np.zeros((len(part), n + 1), np.float32)
            dense[:, n] = 1
            for i, row in enumerate(part):
                dense[i, list(row)] = 1
            yield dense, sums[at: at + 2048, 0], sums[at: at + 2048, 1]

    quadratic = np.diag(np.append(np.full(n, ridge), 1e-6))
    for a, b in pairs:
        gap = np.zeros(n + 1)
        gap[a] += 1
        gap[b] -= 1
        on = np.nonzero(gap)[0]
        quadratic[np.ix_(on, on)] += counterfactual * np.outer(gap[on], gap[on])
    w = np.zeros(n + 1)
    for _ in range(rounds):
        gradient, curve = quadratic @ w, quadratic.copy()
        for dense, rows_of, ones in blocks():
            p = 1 / (1 + np.exp(-np.clip(dense @ w, -35, 35)))
            gradient += dense.T @ (p * rows_of - ones)
            curve += (dense.T * np.maximum(p * (1 - p) * rows_of, 1e-6).astype(np.float32)) @ dense
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w[:n], float(w[n])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES,
        identity: Sequence[str] = IDENTITY, **training) -> Model:
    """A model from the texts of labelled ids."""
    spark = docs.sparkSession
    ship_library(spark)
    picked = _sample(labels, sample)  # bounded: at most `sample` ids
    slim = docs.select(docs["doc_id"], text_of(docs).alias("text"))
    rows = written(slim.join(F.broadcast(picked), "doc_id").select("toxic", "text"), "toxicity-sample")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        share = (n1 + 0.5) / (n1 + n0 + 1)
        return Model({}, np.zeros((0, len(LEVELS))), math.log(share / (1 - share)))
    seen = _document_counts(rows.filter("toxic = 1"), None).filter("toxic >= 3")
    candidates = frozenset(r["feature"] for r in seen.orderBy(F.desc("toxic"), "feature").limit(CANDIDATES).collect())
    counts = _document_counts(rows, candidates)
    # log-odds against its standard error, shares smoothed by half a document
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (n1 + 1 - a)) - F.log(b / (n0 + 1 - b))
    error = F.sqrt(1 / a + 1 / (n1 + 1 - a) + 1 / b + 1 / (n0 + 1 - b))
    best = (counts.select("feature", (odds / error).alias("z")).filter("z > 3 and feature is not null")
            .orderBy(F.desc("z"), "feature").limit(features).collect())
    table = swaps(identity)
    names = sorted({r["feature"] for r in best} | {"1=" + w for w in table})
    index = {f: i for i, f in enumerate(names)}
    data = _matrix(rows, index, table)
    data.sort(key=lambda r: (r["toxic"], list(r["own"])))
    pairs = [(list(r["own"]), list(r["other"])) for r in data if r["other"] is not None]
    weights, bias = train([list(r["own"]) for r in data], np.array([r["toxic"] for r in data], np.float64),
                          pairs, len(names), **training)
    return Model.of(names, weights, bias)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score of every row's whole text."""
    ship_library(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by `features`
    hidden = with_suffix_free(docs, "scored_text")
    source = docs.select(*[docs[c] for c in docs.columns], text_of(docs).alias(hidden))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            made = pa.array([score(t.as_py()) for t in batch.column(hidden)], pa.float64())
            at = batch.schema.get_field_index(hidden)
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(batch.columns) if i != at], made],
                                             [*[n for n in batch.schema.names if n != hidden], name])

    from pyspark.sql import types as T
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return source.mapInArrow(run, schema)


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold."""
    name = with_suffix_free(docs, "score")
    return scored(docs, model, name).filter(F.col(name) < threshold).select(docs.columns)
