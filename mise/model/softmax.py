"""Multinomial logistic regression by whole passes over blocks of rows.

The objective is MLlib's (weighted log loss over the sum of weights, plus half of ``reg`` times the squared
coefficients; intercepts are free).  Rows are packed once into blocks of a few thousand, kept by Spark;
a pass sends the coefficients to the blocks, every task adds up loss and gradient of its blocks in numpy, and the
sums meet.  The steps are L-BFGS ones, measured by the features' weighted second moments, which bound the
curvature; without them correlated features take several times as many passes.

Where the classes have many rows, such steps are taken on some rows of every class, whose sum is tilted to have the
slope that all rows have (the surrogate likelihood of Jordan, Lee and Yang, and DANE): the place they end at is one step for
all rows, and some five passes over these do what a hundred did.  The objective, and when it has settled, are those of all rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from mise.session import ship_library

#: Rows of a block at most, and numbers of a dense one (8 MB).
BLOCK_ROWS, BLOCK_NUMBERS = 2_048, 2 << 20
#: A block is dense from this share of non-zero elements on.
DENSE = 0.2
#: Features up to which second moments are kept whole (the diagonal beyond), and steps that are remembered.
WHOLE, MEMORY = 2_048, 10
#: The objective has settled when this many steps change it by less than the tolerance's share of its first value.
SETTLED = 5
#: Rows of a class among those that the steps are sought on, and by how many times all rows must outnumber them.
NEAR_ROWS, NEAR_LESS = 1_024, 4
#: Steps that are remembered there, by models of at most as many coefficients.
NEAR_MEMORY, NEAR_MODEL = 30, 1 << 20
#: Share of what a search on some rows has gained that its last steps may still gain when it ends.
ENOUGH = 0.01
#: Exponents within this need no shift in float32.
SAFE = 60.0
#: Partial sums up to which the driver adds them up itself.
PARTIALS = 64


_HELD: dict[str, np.ndarray] = {}


def _buffer(name: str, rows: int, width: int) -> np.ndarray:
    """Room for a block's numbers, the same for every block of a task: fresh memory costs more than the sums."""
    held = _HELD.get(name)
    if held is None or held.size < rows * width:
        held = _HELD[name] = np.empty(rows * width, np.float32)
    return held[: rows * width].reshape(rows, width)


class Block:
    """Some rows' features, dense or sparse, and labels (a column per head, -1 unknown)."""

    def __init__(self, width: int, lens: np.ndarray, idx: np.ndarray, values: np.ndarray, labels: np.ndarray):
        self.width, self.dense = width, None
        order = np.argsort(-lens, kind="stable")  # rows with an element in a slot are the first ones
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.labels = labels[order]
        values = values.astype(np.float32)
        if len(values) == len(lens) * width and (lens == width).all():  # every element is there, in order
            self.dense = values.reshape(len(lens), width)
            return
        row = np.repeat(place, lens)
        if len(idx) >= DENSE * len(lens) * width:
            self.dense = np.zeros((len(lens), width), np.float32)
            np.add.at(self.dense, (row, idx), values)
            return
        slot = np.arange(len(idx)) - np.repeat(np.cumsum(lens) - lens, lens)
        by_slot, by_feature = np.lexsort((row, slot)), np.lexsort((row, idx))
        self.slots = np.bincount(slot)
        self.idx, self.values = idx[by_slot].astype(np.int32), values[by_slot]
        self.features, self.starts = np.unique(idx[by_feature], return_index=True)
        self.rows, self.by_feature = row[by_feature].astype(np.int32), values[by_feature]

    def times(self, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """``X W + b``, a row each."""
        out = _buffer("times", len(self.labels), weights.shape[1])
        if self.dense is not None:
            np.matmul(self.dense, weights, out=out)
            out += bias
            return out
        out[:] = bias
        at = 0
        for n in self.slots:
            part = np.take(weights, self.idx[at: at + n], axis=0, out=_buffer("part", n, weights.shape[1]), mode="clip")
            part *= self.values[at: at + n, None]
            out[:n] += part
            at += n
        return out

    def add_gradient(self, rest: np.ndarray, out: np.ndarray) -> None:
        """Add ``X' R`` to ``out``."""
        if self.dense is not None:
            out += self.dense.T @ rest
        elif len(self.rows):
            part = np.take(rest, self.rows, axis=0, out=_buffer("part", len(self.rows), rest.shape[1]), mode="clip")
            part *= self.by_feature[:, None]
            out[self.features] += np.add.reduceat(part, self.starts, axis=0)

    def some(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lengths, indices, values and labels of some of its rows."""
        if self.dense is not None:
            lens = np.full(len(rows), self.width)
            return lens, np.tile(np.arange(self.width), len(rows)), self.dense[rows].ravel(), self.labels[rows]
        place = np.full(len(self.labels), -1)
        place[rows] = np.arange(len(rows))
        row, of = place[self.rows], np.repeat(self.features, np.diff(np.append(self.starts, len(self.rows))))
        by_row = np.argsort(row, kind="stable")[np.count_nonzero(row < 0):]
        return np.bincount(row[by_row], minlength=len(rows)), of[by_row], self.by_feature[by_row], self.labels[rows]

    def used(self) -> tuple[np.ndarray, np.ndarray]:
        """The features that some row has, and their columns as a dense matrix."""
        if self.dense is not None:
            return np.arange(self.width), self.dense
        out = np.zeros((len(self.labels), len(self.features)), np.float32)
        of = np.repeat(np.arange(len(self.features)), np.diff(np.append(self.starts, len(self.rows))))
        np.add.at(out, (self.rows, of), self.by_feature)
        return self.features, out


def _packed(heads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x")
            arrays = pa.types.is_list(x.type)
            numbers = x if arrays else x.field("values")
            values = numbers.flatten().to_numpy(zero_copy_only=False)
            if x.null_count or not np.all(np.isfinite(values)):
                raise ValueError("features must not be null, NaN or infinite")
            lens = numbers.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            dense = np.ones(len(lens), bool) if arrays else x.field("type").to_numpy(zero_copy_only=False) == 1
            sizes = lens if arrays else np.where(dense, lens, x.field("size").fill_null(0).to_numpy(zero_copy_only=False))
            if (sizes != sizes[0]).any():
                raise ValueError(f"feature vectors of widths {sizes.min()} and {sizes.max()}")
            width, ends = int(sizes[0]), np.concatenate([[0], np.cumsum(lens)])
            idx = np.arange(len(values)) - np.repeat(ends[:-1], lens)
            if not arrays:
                idx[np.repeat(~dense, lens)] = x.field("indices").flatten().to_numpy(zero_copy_only=False)
            labels = np.stack([batch.column(f"y{h}").fill_null(-1).to_numpy(zero_copy_only=False) for h in range(heads)], axis=1)
            step = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(width, 1)))
            for a in range(0, batch.num_rows, step):
                b = min(a + step, batch.num_rows)
                of = slice(ends[a], ends[b])
                made = pickle.dumps(Block(width, lens[a:b], idx[of], values[of], labels[a:b]), protocol=5)
                yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["block"])
    return run


def packed(df: DataFrame, vec: str, labels: list[str]) -> RDD:
    """The rows' vectors (or arrays of numbers) and labels as blocks, kept (in memory, else on disk) until ``unpersist``."""
    ship_library(df.sparkSession)
    x = F.col(vec).cast("array<double>") if isinstance(df.schema[vec].dataType, ArrayType) else F.unwrap_udt(vec)
    rows = df.select(x.alias("x"), *[F.when(F.col(c) >= 0, F.col(c)).cast("long").alias(f"y{i}") for i, c in enumerate(labels)])
    return rows.mapInArrow(_packed(len(labels)), "block binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(blocks: RDD, shared, per_block: Callable, zero: Callable) -> tuple:
    """What ``per_block`` adds to ``zero()`` (a tuple of arrays) over all blocks: a partial sum per core."""
    def run(part):
        out, now = zero(), shared.value if shared is not None else None
        for block in part:
            per_block(pickle.loads(block), now, out)
        yield out

    cores = blocks.context.defaultParallelism
    few = blocks.coalesce(cores) if blocks.getNumPartitions() > cores else blocks
    depth = 2 if few.getNumPartitions() > PARTIALS else 1
    return few.mapPartitions(run).treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True)), depth)


def counted(blocks: RDD, heads: int) -> tuple[int, list[np.ndarray]]:
    """The features' width and per head how many rows each label has."""
    def run(part):
        width, out = -1, [np.zeros(0, np.int64)] * heads
        for block in map(pickle.loads, part):
            if width not in (-1, block.width):
                raise ValueError(f"feature vectors of widths {width} and {block.width}")
            width = block.width
            out = [_longer(o, np.bincount(y[y >= 0])) for o, y in zip(out, block.labels.T)]
        yield width, out

    cores = blocks.context.defaultParallelism
    parts = [p for p in (blocks.coalesce(cores) if blocks.getNumPartitions() > cores else blocks).mapPartitions(run).collect() if p[0] >= 0]
    widths = {w for w, _ in parts}
    if len(widths) > 1:
        raise ValueError(f"feature vectors of widths {sorted(widths)}")
    out = [np.zeros(0, np.int64)] * heads
    for _, some in parts:
        out = [_longer(a, b) for a, b in zip(out, some)]
    return (widths.pop() if widths else 0), out


def _drawn(blocks: RDD, head: int, rates: np.ndarray) -> RDD:
    """Blocks of rows drawn by their class's rate, kept until ``unpersist``."""
    def run(part, rows):
        rnd, held, n = np.random.default_rng(part), [], 0
        for block in map(pickle.loads, rows):
            y, full = block.labels[:, head], max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(block.width, 1)))
            chosen = np.flatnonzero((rnd.random(len(y)) < rates[np.maximum(y, 0)]) & (y >= 0))
            held.append(block.some(chosen))
            n += len(chosen)
            if n >= full:
                yield packing(block.width, held)
                held, n = [], 0
        if n:
            yield packing(block.width, held)

    def packing(width, held) -> bytes:
        return pickle.dumps(Block(width, *map(np.concatenate, zip(*held, strict=True))), protocol=5)

    return blocks.mapPartitionsWithIndex(run).persist(StorageLevel.MEMORY_AND_DISK)


def _longer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    out = a.astype(np.int64)
    out[: len(b)] += b
    return out


def _weighed(block: Block, head: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    y = block.labels[:, head]
    of = np.maximum(y, 0)
    return of, np.where(y >= 0, weights[np.minimum(of, len(weights) - 1)], 0.0)


def _moments(blocks: RDD, head: int, weights: np.ndarray, width: int) -> np.ndarray:
    """Weighted second moments of the features and a one; only the diagonal where they are many."""
    shape = (width + 1, width + 1) if width < WHOLE else (width + 1,)

    def per_block(block: Block, _, out) -> None:
        (of, x), w = block.used(), _weighed(block, head, weights)[1].astype(np.float32)
        scaled = x * w[:, None]
        if len(shape) == 1:
            out[0][of] += np.einsum("ij,ij->j", scaled, x)
            out[0][-1] += w.sum()
        else:
            sums = scaled.sum(axis=0)
            out[0][np.ix_(of, of)] += scaled.T @ x
            out[0][-1, of] += sums
            out[0][of, -1] += sums
            out[0][-1, -1] += w.sum()

    return _sums(blocks, None, per_block, lambda: (np.zeros(shape),))[0]


def _gradient(head: int, weights: np.ndarray):
    """Adds a block's loss and gradient at the given coefficients (the last row are intercepts)."""
    def per_block(block: Block, now: np.ndarray, out) -> None:
        of, w = _weighed(block, head, weights)
        at = np.arange(len(of))
        z = block.times(now[:-1], now[-1])
        if z.max() > SAFE or z.min() < -SAFE:
            z -= z.max(axis=1, keepdims=True)
        own = z[at, of].astype(np.float64)
        np.exp(z, out=z)
        total = z @ np.ones(z.shape[1], np.float32)
        out[0][0] += w @ (np.log(total, dtype=np.float64) - own)
        z *= (w / total).astype(np.float32)[:, None]
        z[at, of] -= w.astype(np.float32)
        block.add_gradient(z, out[1][:-1])
        out[1][-1] += np.ones(len(of), np.float32) @ z
    return per_block


def fit_softmax(blocks: RDD, head: int, counts: np.ndarray, weights: np.ndarray, width: int, reg: float, max_iter: int,
                tol: float = 1e-6) -> tuple[np.ndarray, np.ndarray, list[float], bool]:
    """Coefficients (classes, features), intercepts, the objective before and after each step, and whether it settled.

    ``counts`` and ``weights`` are those of the classes; a class without rows keeps its place."""
    k, per_class = len(counts), counts * weights
    if (counts > 0).sum() == 1:  # nothing to tell apart: the one class is certain
        return np.zeros((k, width)), np.where(counts > 0, np.inf, 0.0), [0.0], True
    total = per_class.sum()

    def towards_of(some: RDD, its: np.ndarray):
        moments = _moments(some, head, its, width) / total
        ridge = np.append(np.full(width, reg), 0.0) + 1e-9 * (np.trace(moments) if moments.ndim == 2 else moments.sum())
        if moments.ndim == 2:
            inverse = np.linalg.inv(moments / 2 + np.diag(ridge))
            return lambda g: inverse @ g
        return lambda g: g / (moments / 2 + ridge)[:, None]

    def measured_on(some: RDD, its: np.ndarray):
        per_block = _gradient(head, its)

        def measured(theta):
            shared = some.context.broadcast(theta.astype(np.float32))
            loss, slope = _sums(some, shared, per_block, lambda: (np.zeros(1), np.zeros((width + 1, k))))
            shared.destroy()
            slope /= total
            slope[:-1] += reg * theta[:-1]
            return loss[0] / total + reg / 2 * (theta[:-1] ** 2).sum(), slope
        return measured

    theta = np.zeros((width + 1, k))
    start = np.log1p(per_class)
    theta[-1] = start - start.mean()
    if np.minimum(counts, NEAR_ROWS).sum() * NEAR_LESS > counts.sum():
        theta, values, settled = minimise(measured_on(blocks, weights), theta, towards_of(blocks, weights), max_iter, tol)
    else:
        near = _drawn(blocks, head, np.minimum(1.0, NEAR_ROWS / np.maximum(counts, 1)))
        try:
            drawn = counted(near, head + 1)[1][head]
            its = np.zeros(k)  # a class weighs what it weighs among all rows
            its[: len(drawn)] = per_class[: len(drawn)] / np.maximum(drawn, 1)
            theta, values, settled = minimise_by(measured_on(blocks, weights), measured_on(near, its), theta, towards_of(near, its), max_iter, tol)
        finally:
            near.unpersist()
    theta[-1] -= theta[-1].mean()
    if not reg:
        theta[:-1] -= theta[:-1].mean(axis=1, keepdims=True)
    return theta[:-1].T, theta[-1], values, settled


def minimise_by(measured: Callable, near: Callable, theta: np.ndarray, towards: Callable, max_iter: int, tol: float):
    """Steps to where ``near``, tilted to have the slope of ``measured`` here, is least; until a whole step lowers the
    value by no more than ``tol`` of the first one.  As both are convex, such a step leads down.  The first step
    goes to where ``near`` as it is is least, if it leads down: its tilt far from there says little."""
    value, slope = measured(theta)
    values, pairs, memory = [value], [], NEAR_MEMORY if theta.size <= NEAR_MODEL else MEMORY
    there = minimise(near, theta, towards, max_iter, tol, value, pairs, ENOUGH, memory)[0]
    now, grade = measured(there)
    if now < value:
        values.append(now)
        theta, value, slope = there, now, grade
    while len(values) <= max_iter:
        if np.linalg.norm(slope) <= tol * max(abs(value), 1e-2):
            return theta, values, True
        here, tilt = theta, slope - near(theta)[1]

        def tilted(at, here=here, tilt=tilt):
            now, grade = near(at)
            return now + (tilt * (at - here)).sum(), grade + tilt

        there = minimise(tilted, theta, towards, max_iter, tol / 10, values[0], pairs, ENOUGH, memory)[0]
        step, length = theta - there, 1.0
        fall = (slope * step).sum()
        while True:
            there = theta - length * step
            now, grade = measured(there)
            if now <= value - 1e-4 * length * fall:
                break
            if fall <= tol * abs(values[0]):
                return theta, values, True
            if length < 1e-4:
                return theta, values, False
            best = length * fall / (2 * (now - value + length * fall)) if np.isfinite(now) else 0.1
            length *= min(0.5, max(0.1, best))
        values.append(now)
        theta, value, slope = there, now, grade
        if length == 1.0 and values[-2] - value <= tol * abs(values[0]):
            return theta, values, True
    return theta, values, False


def minimise(measured: Callable, theta: np.ndarray, towards: Callable, max_iter: int, tol: float, first: float | None = None,
             pairs: list | None = None, enough: float = 0.0, memory: int = MEMORY):
    """L-BFGS steps from ``theta`` with ``towards`` as the first guess of the inverse curvature, until ``SETTLED``
    steps together, or no step at all, lower the value by more than ``tol`` of the first one (or of ``first``), or by
    more than the share ``enough`` of what all steps did.
    ``pairs`` holds earlier steps of the same curvature, and then these."""
    value, slope = measured(theta)
    values, pairs = [value], [] if pairs is None else pairs
    first = abs(value if first is None else first)
    while len(values) <= max_iter:
        if np.linalg.norm(slope) <= tol * max(abs(value), 1e-2):
            return theta, values, True
        step, kept = slope, []
        for s, y, r in reversed(pairs):
            a = (s * step).sum() * r
            step = step - a * y
            kept.append(a)
        step = towards(step)
        if pairs:
            s, y, r = pairs[-1]
            step *= 1 / (r * (y * towards(y)).sum())
        for (s, y, r), a in zip(pairs, reversed(kept)):
            step = step + s * (a - (y * step).sum() * r)
        fall, length = (slope * step).sum(), 1.0
        while True:
            there = theta - length * step
            now, grade = measured(there)
            if now <= value - 1e-4 * length * fall:
                break
            if length * fall <= tol * tol * max(abs(value), 1e-2) or length < 1e-4:
                return theta, values, True  # within the rounding of float32
            best = length * fall / (2 * (now - value + length * fall)) if np.isfinite(now) else 0.1
            length *= min(0.5, max(0.1, best))
        s, y = there - theta, grade - slope
        if (s * y).sum() > 0:
            pairs.append((s, y, 1 / (s * y).sum()))
            del pairs[:-memory]
        theta, value, slope = there, now, grade
        values.append(value)
        if len(values) > SETTLED and values[-1 - SETTLED] - value <= max(tol * first, enough * (values[0] - value)):
            return theta, values, True
    return theta, values, False
