"""A hashed maximum-entropy language model with a class-factored softmax.

``P(word | history) = P(class | history) * P(word | class)``.  Classes: the end and
the most frequent tokens have one each; other tokens share a class by how they
begin and end, the commonest of those endings and beginnings first.  The class
softmax has a bias and four kinds of features: the token before, the tokens two
and three before (skips), and the hashed pair of the two before.  A token stands
for itself in a history if it is frequent, else for its class.  Within a class
words keep their smoothed corpus frequency, and unseen words share 0.1 there.

Training sees every training document: counts and features are gathered by
Spark from the whole corpus; weights start from the observed feature counts,
and in each round every task adds up, in sparse numpy batches, how often the model
expects each class with each feature; the sums meet in Spark, and weights and bias
move along the gradient (observed against expected) with momentum, until the likelihood of the
training tokens stops rising.  The history tokens and the buckets of pairs grow with the square
root of the training tokens (``Size``), so the model grows with the corpus and the tables that
meet in the driver grow more slowly than the input.

Counts of the ``head`` most frequent tokens travel with the tasks; the others
(whose number has no bound) are joined in Spark, so every text is scored against all counts.

Defined results: a null or empty text is the end token alone; null ids are held
out; with nothing to learn from, N and V are 0 and every token is unseen; repeated
rows each get a row; an empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mise.llm.common import text_of, written
from mise.session import ship_library

END = b""  # no word is empty
CLASSES, SINGLE = 64, 24
#: Tokens that stand for themselves in a history, and buckets of hashed pairs: the least, and
#: how many for each square root of a training token.
OWN, OWN_RATE = 1_024, 1 / 8
PAIRS, PAIRS_RATE = 4_096, 2.0
MOST_ROWS = 1 << 20  # of a model (256 MB as broadcast): reached beyond some 10 TB
HEAD = 100_000
BANDS = 8  # frequency bands for each doubling of a count
GAIN = 5e-4  # nats a token by which a round must raise the training likelihood for another one
DAMP, LEAST_DAMP = 0.5, 0.125
MOMENTUM = 0.6  # share of the last move that is made again
PRIOR = 20.0
FLUSH = 200_000
PART = 1 << 12
LARGEST = 15.0
MANY = 32  # lines of one id that are added up together at most
#: Scale of the first weights of: one before, two before, three before, the pair.
_FIRST = (0.5, 0.25, 0.2, 0.35)
_FIXED = 1 << 12  # expected counts are sent as whole multiples of this fraction


def tokens_of(text: str) -> list[bytes]:
    """ASCII letters lower-cased, words between ASCII white space, then the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def shape_of(token: bytes) -> bytes:
    """How a token begins, and whether it ends in an odd sign."""
    last = token[-1:]
    return token[:2] + (b"" if last.isalnum() or last in b".," or last >= b"\x80" else b"!")


@dataclass(frozen=True)
class Size:
    """How many tokens stand for themselves in a history, and how many buckets pairs have."""

    own: int = OWN
    pairs: int = PAIRS

    @classmethod
    def of(cls, tokens: int) -> Size:
        """For a corpus of that many training tokens."""
        root = math.sqrt(tokens)
        own, pairs = max(OWN, int(root * OWN_RATE)), max(PAIRS, int(root * PAIRS_RATE))
        over = max(1.0, (3 * own + pairs) / (MOST_ROWS - 4 * CLASSES))
        return cls(int(own / over), int(pairs / over))

    @property
    def start(self) -> int:
        """The sign of what stands before a text."""
        return self.own + CLASSES

    @property
    def width(self) -> int:
        return self.start + 1

    @property
    def rows(self) -> int:
        return 3 * self.width + self.pairs


@dataclass
class Vocabulary:
    """What the tasks need to know about tokens; its size is bounded by ``HEAD``."""

    single: dict[bytes, int]
    shapes: dict[bytes, int]
    own: dict[bytes, int]
    counts: dict[bytes, int]
    n: int = 0
    v: int = 0
    size: Size = Size()
    mass: np.ndarray = field(default_factory=lambda: np.full(CLASSES, 0.1))

    def class_of(self, token: bytes) -> int:
        own = self.single.get(token)
        return self.shapes.get(shape_of(token), CLASSES - 1) if own is None else own

    def sign_of(self, token: bytes) -> int:
        """What the token is in a history; frequent ones are themselves."""
        own = self.own.get(token)
        return self.size.own + self.class_of(token) if own is None else own

    def classes(self) -> np.ndarray:
        """The class of each sign."""
        out = np.zeros(self.size.width, np.int64)
        for token, i in self.own.items():
            out[i] = self.class_of(token)
        out[self.size.own: self.size.start] = np.arange(CLASSES)
        return out


def _count(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                              ["token", "c"])
            counts.clear()
            return made

        for batch in batches:
            for text in batch.column("text"):
                counts.update(tokens_of(text.as_py()))
                if len(counts) > FLUSH:
                    yield out()
        yield out()

    return docs.mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _masses(counts: DataFrame, shared) -> np.ndarray:
    """Per class the smoothed counts of its tokens, and 0.1 for unseen ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        total, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            of = np.array([words.class_of(t) for t in batch.column("token").to_pylist()], np.int64)
            total += np.bincount(of, weights=batch.column("c").to_numpy(), minlength=CLASSES).astype(np.int64)
            kinds += np.bincount(of, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(total), pa.array(kinds)], ["class", "c", "kinds"])

    sums = counts.mapInArrow(run, "class long, c long, kinds long").groupBy("class").agg(F.sum("c").alias("c"), F.sum("kinds").alias("kinds"))
    out = np.full(CLASSES, 0.1)
    for r in sums.collect():  # a row per class
        out[r["class"]] += r["c"] + 0.1 * r["kinds"]
    return out


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    # the lowest frequency band from which on there are at most `head` tokens: a few hundred
    # sums reach the driver, then those tokens, not a sorted list from every task
    band = F.floor(F.log2("c") * BANDS)
    left, lowest = head, math.inf
    for r in counts.groupBy(band.alias("band")).agg(F.count("*").alias("n")).orderBy(F.desc("band")).collect():
        left -= r["n"]
        if left < 0:
            break
        lowest = r["band"]
    # bounded by `head`; as Arrow columns, which take a tenth of the driver's memory that rows do
    top = counts.filter(band >= lowest if lowest < math.inf else F.lit(False)).select("token", "c").toArrow()
    top = sorted(zip(top.column("token").to_pylist(), top.column("c").to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    often = [t for t, _ in top]
    single = {t: i for i, t in enumerate([END, *[t for t in often if t != END]][:SINGLE])}
    shape = F.concat(F.substring("token", 1, 2), F.when(F.substring("token", -1, 1).cast("string").rlike(r"^[^0-9A-Za-z.,\x{80}-\x{10FFFF}]$"),
                                                        F.lit(b"!")).otherwise(F.lit(b"")))
    shapes = (counts.filter(~F.col("token").isin([bytearray(t) for t in single])).groupBy(shape.alias("shape")).agg(F.sum("c").alias("c"))
              .orderBy(F.desc("c"), "shape").limit(CLASSES - SINGLE - 1).collect())
    size = Size.of(total["n"] or 0)
    return Vocabulary(single, {bytes(r["shape"]): SINGLE + i for i, r in enumerate(shapes)}, {t: i for i, t in enumerate(often[:size.own])},
                      dict(top), total["n"] or 0, total["v"] or 0, size)


def _encode(docs: DataFrame, shared) -> DataFrame:
    """Per row its key, signs, and what the head counts give; other tokens are listed."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        place = {t: i for i, t in enumerate(words.counts)}
        signs = np.array([words.sign_of(t) for t in words.counts] or [0], np.int32)
        logs = np.log10(np.array(list(words.counts.values()) or [1]) + 0.1)
        key = TaskContext.get().partitionId() << 40

        def made(part: pa.RecordBatch, tokens: list[bytes], lens: list[int]) -> pa.RecordBatch:
            nonlocal key
            ends = np.cumsum([0, *lens])
            at = np.fromiter(map(place.get, tokens, repeat(-1)), np.int64, len(tokens))
            head = at >= 0
            codes = signs[at]
            others = np.flatnonzero(~head)
            codes[others] = [words.sign_of(tokens[i]) for i in others]
            rare, times, rare_ends = [], [], [0]
            of_text = np.searchsorted(others, ends)
            for a, b in zip(of_text[:-1], of_text[1:], strict=True):
                if a < b:
                    found = Counter([tokens[i] for i in others[a:b]])
                    rare.extend(found)
                    times.extend(found.values())
                rare_ends.append(len(rare))
            starts = ends[:-1]  # every text has a token at least: the end
            keys = np.arange(key + 1, key + 1 + len(lens))
            key += len(lens)
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(keys, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes)), pa.array(lens, pa.int64()),
                 pa.array(np.add.reduceat(head.astype(np.int64), starts)), pa.array(np.add.reduceat(np.where(head, logs[at], 0.0), starts)),
                 pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), pa.array(rare, pa.binary())),
                 pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), pa.array(times, pa.int64()))],
                ["doc_id", "held_out", "row_key", "signs", "n_tokens", "n_known", "logs", "rare", "times"])

        for batch in batches:
            first, tokens, lens = 0, [], []
            for value in batch.column("text"):
                text = tokens_of(value.as_py())
                tokens += text
                lens.append(len(text))
                if len(tokens) > FLUSH:
                    yield made(batch.slice(first, len(lens)), tokens, lens)
                    first, tokens, lens = first + len(lens), [], []
            if lens:
                yield made(batch.slice(first, len(lens)), tokens, lens)

    return docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, row_key long, signs array<int>, n_tokens long, n_known long, "
                                "logs double, rare array<binary>, times array<long>")


def feature_rows(size: Size, signs: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The weight rows (4, tokens) that are on for each token of some texts."""
    on = np.full((4, len(signs)), size.start, np.int32)
    place = np.arange(len(signs), dtype=np.int32) - np.repeat(starts.astype(np.int32), lens)
    for k in (1, 2, 3):
        if k < len(signs):
            np.copyto(on[k - 1, k:], signs[:-k], where=place[k:] >= k, casting="unsafe")
    return _as_rows(size, on)


def _as_rows(size: Size, on: np.ndarray) -> np.ndarray:
    """Signs one, two and three before (and a line to fill) as weight rows, in place."""
    on[3] = 3 * size.width + ((on[0] * 40_503 + on[1] * 65_599) >> 3) % size.pairs
    on[1] += size.width
    on[2] += 2 * size.width
    return on


def logits(on: Sequence[np.ndarray], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Bias and the weights that are on, (tokens, classes); within float32's
    range for exp, as no weight is above ``LARGEST``."""
    z = np.take(weights, on[0], axis=0)
    z += bias
    more = np.empty_like(z)
    for f in range(1, len(on)):
        z += np.take(weights, on[f], axis=0, out=more, mode="clip")
    return z


def log_softmax(on: np.ndarray, weights: np.ndarray, bias: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Natural log probability of each token's class ``of``."""
    z = logits(on, weights, bias)
    own = z[np.arange(len(of)), of]
    return own - np.log(np.exp(z, out=z).sum(axis=1, dtype=np.float64))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[ends[0]: ends[-1]].astype(np.int64)
    ends = (ends - ends[0]).astype(np.int64)
    return values, ends[:-1], np.diff(ends)


def _table(rows: DataFrame, size: Size, per_batch, scale: float) -> np.ndarray:
    """Sums over all rows of what ``per_batch`` adds to a (rows + 1, CLASSES) table: the
    model's rows, and one for the likelihood's sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((size.rows + 1, CLASSES))
        for batch in batches:
            if batch.num_rows:
                per_batch(table, batch)
        on = np.nonzero(table.any(axis=1))[0]
        values = np.rint(table[on] * scale).astype(np.int64)
        flat = pa.array(values.ravel())
        ends = pa.array(np.arange(len(on) + 1) * CLASSES, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.ListArray.from_arrays(ends, flat)], ["row", "v"])

    sums = (rows.mapInArrow(run, "row int, v array<long>").groupBy("row")
            .agg(*[F.sum(F.get("v", F.lit(c))).alias(f"c{c}") for c in range(CLASSES)]))
    out = np.zeros((size.rows + 1, CLASSES))
    got = sums.toArrow()  # bounded: the model's rows
    at = got.column("row").to_numpy()
    for c in range(CLASSES):
        out[at, c] = got.column(f"c{c}").to_numpy()
    out /= scale
    return out


def _contexts(rows: DataFrame, size: Size) -> DataFrame:
    """``block``: the histories (three signs in one number) of all tokens and how often each
    occurs, as pickled ``Histories``.  Tasks sum up first; then the histories of a bucket of pairs
    come together, so that in each round few tasks send the same bucket's row, and in order, so
    that those with the same two signs before lie in one block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
            held.clear()
            pair = _of_keys(size, keys)[3]
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(keys), pa.array(n.astype(np.int64))], ["pair", "key", "n"])

        for batch in batches:
            if batch.num_rows:
                on = feature_rows(size, *_flat(batch.column("signs"))).astype(np.int64)
                held.append((on[0] * size.width + on[1] - size.width) * size.width + on[2] - 2 * size.width)
            if sum(map(len, held)) > 10 * FLUSH:
                yield out()
        yield out()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = Histories(size, batch.column("key").to_numpy(), batch.column("n").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made, protocol=5)], pa.binary())], ["block"])

    return (rows.select("signs").mapInArrow(run, "pair int, key long, n long")
            .repartition("pair").groupBy("pair", "key").agg(F.sum("n").alias("n"))
            .sortWithinPartitions("key").select("key", "n").mapInArrow(packed, "block binary"))


def _pieces(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines in an order in which they can be added up by whole arrays: first a line of every id, the ids with
    most lines first, then a second line of those that have one, and so on; how many there are
    of each, and the ids.  An id with more than ``MANY`` lines comes several times."""
    order = np.argsort(ids, kind="stable")
    ids, at = ids[order], np.arange(len(ids))
    turn = (at - np.maximum.accumulate(np.where(np.diff(ids, prepend=-1) != 0, at, 0))) % MANY
    first = np.flatnonzero(turn == 0)
    many = np.diff(first, append=len(ids))
    by = np.argsort(-many, kind="stable")
    rank = np.empty_like(by)
    rank[by] = np.arange(len(by))
    return order[np.lexsort((np.repeat(rank, many), turn))].astype(np.int32), np.bincount(turn), ids[first][by]


def _steps(ids: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """``_pieces``, again until each id comes once: the orders and numbers, and the ids."""
    steps = []
    while True:
        order, many, ids = _pieces(ids)
        steps.append((order, many))
        if len(np.unique(ids)) == len(ids):
            return steps, ids


def _added(lines: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The sums of lines in the order of ``_pieces``."""
    out, at = lines[: many[0]].copy(), many[0]
    for n in many[1:]:
        out[:n] += lines[at: at + n]
        at += n
    return out


class Histories:
    """Some histories and how often each occurs.  Those with the same two signs before share three of
    their four weight rows; how their sums are taken is worked out once, for all rounds."""

    def __init__(self, size: Size, key: np.ndarray, times: np.ndarray):
        two, third = np.divmod(key, size.width)
        order, self.many, two = _pieces(two)
        self.times, self.third = times[order], third[order].astype(np.int32)
        self.of = np.concatenate([np.arange(n, dtype=np.int32) for n in self.many])
        on = _of_keys(size, two * size.width)
        self.on = [on[0], on[1], on[3]]
        self.sums = [_steps(rows) for rows in self.on]
        self.third_sums = _steps(self.third)

    def add_expected(self, size: Size, now: Model, third: np.ndarray, table: np.ndarray) -> None:
        """Add to the table how often the model expects each class with each feature, and to its last
        row the log of the sums over classes; ``third`` is ``exp`` of the weights of three before."""
        shared = logits(self.on, now.weights, now.bias)
        np.exp(shared, out=shared)
        left, right = np.take(shared, self.of, axis=0), np.take(third, self.third, axis=0)
        total = np.einsum("ij,ij->i", left, right)
        table[size.rows, 0] += self.times @ np.log(total, dtype=np.float64)
        rate = (self.times / total).astype(np.float32)[:, None]
        right *= rate
        left *= rate
        shared *= _added(right, self.many)
        for steps, ids in self.sums:
            self._add(table, ids, steps, shared)
        steps, ids = self.third_sums
        self._add(table, 2 * size.width + ids, steps, left, third[ids])

    @staticmethod
    def _add(table: np.ndarray, ids: np.ndarray, steps, lines: np.ndarray, times: np.ndarray | float = 1.0) -> None:
        for order, many in steps:
            lines = _added(np.take(lines, order, axis=0), many)
        table[ids] += lines * times


def _of_keys(size: Size, key: np.ndarray) -> np.ndarray:
    """The weight rows (4, histories) of histories in one number."""
    w = size.width
    return _as_rows(size, np.array([key // (w * w), key // w % w, key % w, key % w], np.int32))


@dataclass
class Model:
    weights: np.ndarray
    bias: np.ndarray
    likelihoods: list[float] = field(default_factory=list)  # of the training tokens, in nats a token, as rounds measured them


def train(rows: DataFrame, words: Vocabulary, gain: float = GAIN) -> Model:
    """The model of encoded rows, from all of them in every round.

    Rounds go on until the likelihood of the training tokens stops rising: a step that raises it by less than
    ``gain`` is the last one if it is the first or had no momentum and the least length; else the next goes without
    momentum, then half as long.  A step that lowers the likelihood is taken back and tried again in the same way."""
    spark = rows.sparkSession
    classes, size = words.classes(), words.size
    width, n_rows = size.width, size.rows

    def observed(table: np.ndarray, batch: pa.RecordBatch) -> None:
        signs, starts, lens = _flat(batch.column("signs"))
        flat = table.reshape(-1)
        of = classes[signs].astype(np.int32)
        for on in feature_rows(size, signs, starts, lens):
            flat += np.bincount(on * CLASSES + of, minlength=len(flat))

    seen = _table(rows.select("signs"), size, observed, 1.0)[:n_rows]
    prior = seen[:width].sum(axis=0) + 0.1
    prior /= prior.sum()
    # the tables are the driver's largest arrays: worked on in place
    first = seen + PRIOR * prior
    first /= seen.sum(axis=1, keepdims=True) + PRIOR
    first /= prior
    np.log(first, out=first)
    first *= np.concatenate([np.full(n, s) for n, s in zip((width, width, width, size.pairs), _FIRST, strict=True)])[:, None]
    model = Model(np.clip(first, -LARGEST, LARGEST, out=first).astype(np.float32), np.log(prior).astype(np.float32))
    del first
    tokens = seen[:width].sum()
    if not tokens:
        return model

    # what is expected depends on the history alone: each is looked at once in a round, for all its tokens
    contexts = written(_contexts(rows, size), "lm-contexts")
    by_class = seen[:width].sum(axis=0)

    def measured(now: Model) -> tuple[np.ndarray, float]:
        """How often the model expects each class with each feature, and the likelihood."""
        # the logits of a history's last sign go in as factors
        shared = spark.sparkContext.broadcast((now, np.exp(now.weights[2 * width: 3 * width])))

        def expected(table: np.ndarray, batch: pa.RecordBatch) -> None:
            now, third = shared.value
            for block in batch.column("block"):
                pickle.loads(block.as_buffer()).add_expected(size, now, third, table)

        out = _table(contexts, size, expected, _FIXED)
        shared.destroy()  # no later round needs it, and the driver would keep a copy of each
        return out[:n_rows], float((np.einsum("ij,ij", seen, now.weights) + by_class @ now.bias - out[n_rows, 0]) / tokens)

    guess, reached = measured(model)
    model.likelihoods.append(reached)
    damp, moved = DAMP, None
    while damp >= LEAST_DAMP:
        # along the gradient: a row's step is the log ratio of observed to expected counts, damped where counts are few;
        # a part of the last move is made again
        step = seen + PRIOR * prior
        step /= guess + PRIOR * prior
        np.log(step, out=step)
        step *= damp
        shift = np.log((by_class + PRIOR * prior) / (guess[:width].sum(axis=0) + PRIOR * prior)) * damp
        if moved is not None:
            step += MOMENTUM * moved[0]
            shift += MOMENTUM * moved[1]
        further = Model(np.clip(model.weights + step, -LARGEST, LARGEST).astype(np.float32),
                        np.clip(model.bias + shift, -LARGEST, LARGEST).astype(np.float32), model.likelihoods)
        there, now = measured(further)
        model.likelihoods.append(now)
        if now < reached:
            if moved is None:
                damp /= 2
            moved = None
            continue
        little = now - reached < gain
        if little and (len(model.likelihoods) == 2 or (moved is None and damp <= LEAST_DAMP)):
            return further
        # a move may overshoot and so rise a little only: the next is without momentum, or half as long
        if little and moved is None:
            damp /= 2
        moved, model, guess, reached = None if little else (step, shift), further, there, now
    return model


def scored(docs: DataFrame, held_out: Column, head: int = HEAD, gain: float = GAIN) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of
    every row; the model learns from the rows that aren't held out."""
    spark = docs.sparkSession
    ship_library(spark)
    own = docs.select(docs["doc_id"], F.coalesce(held_out, F.lit(True)).alias("held_out"), text_of(docs).alias("text"))
    counts = written(_count(own.filter(~F.col("held_out")).select("text")), "lm-counts")
    words = vocabulary(counts, head)
    shared = spark.sparkContext.broadcast(words)  # bounded by HEAD tokens
    words.mass = _masses(counts, shared)
    rows = written(_encode(own, shared), "lm-rows")
    model = train(rows.filter(~F.col("held_out")), words, gain)
    inside = np.log10(words.mass)
    classes, size = words.classes(), words.size
    weights = spark.sparkContext.broadcast((model, classes, inside))  # at most MOST_ROWS rows
    base_part = math.log10(words.n + 0.1 * (words.v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, of_sign, of_class = weights.value
        for batch in batches:
            if not batch.num_rows:
                continue
            signs, starts, lens = _flat(batch.column("signs"))
            on, of = feature_rows(size, signs, starts, lens), of_sign[signs]
            each = np.empty(len(signs))
            for at in range(0, len(signs), PART):
                block = of[at: at + PART]
                each[at: at + PART] = log_softmax(on[:, at: at + PART], now.weights, now.bias, block) / math.log(10) - of_class[block]
            total = np.add.reduceat(each, starts)  # every row has a token at least: the end
            columns = [batch.column(c) for c in ("doc_id", "held_out", "row_key", "n_tokens", "n_known", "logs")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total)], ["doc_id", "held_out", "row_key", "n_tokens", "n_known", "logs", "classes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    by_class = (rows.select("doc_id", "held_out", "row_key", "n_tokens", "n_known", "logs", "signs")
                .mapInArrow(run, f"doc_id {kind}, held_out boolean, row_key long, n_tokens long, n_known long, logs double, classes double"))
    other = (rows.select("row_key", F.explode(F.arrays_zip("rare", "times")).alias("r"))
             .select("row_key", F.col("r.rare").alias("token"), F.col("r.times").alias("times")))
    rest = (other.join(counts, "token", "left").groupBy("row_key")
            .agg(F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("more"),
                 F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known")))
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    return (by_class.join(rest, "row_key", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(words.n).cast("long").alias("train_tokens"),
                    (logs - F.col("n_tokens") * F.lit(base_part)).alias("base_score"), (logs + F.col("classes")).alias("score")))
