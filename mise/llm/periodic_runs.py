"""Runs of words that repeat with a period, found by a suffix automaton with link-cut access.

Words are read one by one into a suffix automaton.  The automaton's suffix links
form a tree, kept as a link-cut tree: every preferred path carries the place where
its strings ended last.  Reading a word looks the new state up by ``access``, which
walks the path to the root in stretches of one last end each and then recolours it.  A
stretch that ended ``d`` words ago and whose longest string has at least ``d`` words is a
square of period ``d``; while the next words go on reporting it the square grows to
a run, and it ends where they don't.  The last end is the nearest one, so ``d`` is the
smallest period, and the longest string of the stretch reaches back to the run's first
word: runs come out whole, without any search from a square outwards.

What is read so is only what can hold a run.  With ``g`` = half the least length, every word of a
run lies in a stretch of ``g`` words that the run itself repeats: at its first
``length - period`` words one period later, at its last ones one period earlier, and ``length >= 2 *
period`` leaves no word between.  So words outside repeated stretches are split off (by
sorted hashes, for a whole block of texts at once), again inside each piece until
nothing changes; a clash of hashes only keeps more.

A run is a stretch of consecutive words, longest for its smallest period, with at
least ``least`` words and two periods.  Words of a run behind its first period are repeats;
the collapsed text leaves them out.

Defined results: a null text counts as empty and has no run; a text of one repeated word is one
run of period 1; ties don't arise inside the list, which goes by start, then period; repeated rows
and rows with a null ``doc_id`` each get their own result; an empty table gives an empty
result; texts of any length are read whole; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from mise.llm.common import text_of
from mise.session import ship_library

LEAST = 12
#: Bytes of text that a task reads at a time (a longer text is read alone).
BLOCK_BYTES = 4 << 20

Run = tuple[int, int, int]


def runs_of(words: Sequence[int], least: int = LEAST) -> list[Run]:
    """(start, length, period) of the runs of one sequence, by start, then period."""
    # the automaton: most states have one way on, which is kept flat
    longest, link, key, goal = [0], [-1], [-1], [-1]
    more: dict[int, dict[int, int]] = {}
    # the link-cut tree: the splay trees of preferred paths, shallow states to the left
    up, left, right, ended = [-1], [-1], [-1], [-1]

    def lift(x: int) -> None:
        """``x`` to the top of its splay tree; ``ended`` is right at the top."""
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            if inner and (left[g] == p) == (left[p] == x):
                turn(p)
                turn(x)
            else:
                turn(x)
                if inner:
                    turn(x)

    def turn(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            right[x], left[p] = p, b
        else:
            b = left[x]
            left[x], right[p] = p, b
        if b >= 0:
            up[b] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[x], up[p] = g, x
        ended[x] = ended[p]

    def state(length: int, parent: int) -> int:
        longest.append(length)
        link.append(parent)
        key.append(-1)
        goal.append(-1)
        up.append(parent)
        left.append(-1)
        right.append(-1)
        ended.append(-1)
        return len(longest) - 1

    def step(s: int, word: int) -> int:
        if key[s] == word:
            return goal[s]
        return more[s].get(word, -1) if s in more else -1

    found: list[Run] = []
    open_runs: dict[int, int] = {}
    last = 0
    for at, word in enumerate(words):
        new = state(longest[last] + 1, 0)
        s = last
        while s >= 0 and (to := step(s, word)) < 0:
            if key[s] < 0:
                key[s], goal[s] = word, new
            else:
                more.setdefault(s, {})[word] = new
            s = link[s]
        if s >= 0:
            if longest[to] == longest[s] + 1:
                parent = to
            else:
                parent = state(longest[s] + 1, link[to])
                key[parent], goal[parent] = key[to], goal[to]
                if to in more:
                    more[parent] = dict(more[to])
                while s >= 0 and step(s, word) == to:
                    if key[s] == word:
                        goal[s] = parent
                    else:
                        more[s][word] = parent
                    s = link[s]
                link[to] = parent
                # the shorter strings ended where the longer ones did: the same path, one place above
                lift(to)
                above = left[to]
                left[parent] = above
                if above >= 0:
                    up[above] = parent
                left[to], up[parent] = parent, to
            link[new] = up[new] = parent
        last = new
        # access: stretches of one last end, from the new state to the root
        squares: dict[int, int] = {}
        x, below = new, -1
        while x >= 0:
            lift(x)
            end = ended[x]
            if right[x] >= 0:
                ended[right[x]] = end
            if 0 <= end and at - end <= longest[x]:
                squares[at - end] = longest[x]
            right[x] = below
            below, x = x, up[x]
        lift(new)
        ended[new] = at
        if open_runs:
            for period in [d for d in open_runs if d not in squares]:
                start = open_runs.pop(period)
                if at - start >= least:
                    found.append((start, at - start, period))
        for period, reach in squares.items():
            if period not in open_runs:
                open_runs[period] = at + 1 - reach - period
    for period, start in open_runs.items():
        if len(words) - start >= least:
            found.append((start, len(words) - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _hashes(ids: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` ids from each position on (the last ones run over the end)."""
    wide = np.concatenate([ids.astype(np.uint64) + np.uint64(1), np.zeros(gram, np.uint64)])
    out = np.zeros(len(ids), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            out = out * np.uint64(0x9E3779B97F4A7C15) + wide[k: k + len(ids)]
            out ^= out >> np.uint64(29)
    return out


def pieces_of(ids: np.ndarray, starts: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """The (start, stop) pieces of the sequences that begin at ``starts`` in ``ids`` that
    can hold a run: covered by stretches of ``least // 2`` words that occur again in the same piece."""
    gram = max(least // 2, 1)
    n = len(ids)
    hashes = _hashes(ids, gram)
    first = np.asarray(starts, dtype=np.int64)
    stop = np.append(first[1:], n)
    long_enough = stop - first >= least
    first, stop = first[long_enough], stop[long_enough]
    settled: list[tuple[int, int]] = []
    while len(first):
        sizes = stop - first - gram + 1
        total = int(sizes.sum())
        piece = np.repeat(np.arange(len(first)), sizes)
        place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[piece]
        with np.errstate(over="ignore"):
            mixed = (hashes[place] + piece.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.argsort(mixed)
        ordered = mixed[order]
        same = ordered[1:] == ordered[:-1]
        again = np.zeros(total, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        # the words covered, piece by piece: differences, summed up
        mark = np.zeros(n + gram + 1, np.int64)
        where = place[again]
        np.add.at(mark, where, 1)
        np.add.at(mark, where + gram, -1)
        covered = np.cumsum(mark[:n]) > 0
        inside = np.zeros(n + 1, bool)
        inside[:n] = covered
        begin = inside[:n] & ~np.append(False, inside[:n - 1])
        begin[first] |= inside[first]  # neighbouring texts stay apart
        end_after = inside[:n] & ~inside[1:]
        head = stop[:-1][stop[:-1] == first[1:]] if len(first) > 1 else stop[:0]
        end_after[head - 1] |= inside[head - 1]
        a, b = np.nonzero(begin)[0], np.nonzero(end_after)[0] + 1
        keep = b - a >= least
        a, b = a[keep], b[keep]
        unchanged = np.isin(a, first) & np.isin(b, stop)
        settled += zip(a[unchanged].tolist(), b[unchanged].tolist(), strict=True)
        first, stop = a[~unchanged], b[~unchanged]
    return sorted(settled)


def _texts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``BLOCK_BYTES`` of text, or one text."""
    sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > BLOCK_BYTES:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield batch.slice(at)


def _collapse(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(batch.column("text"))
    raw = split.values
    real = pc.not_equal(raw, "").to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(real)])[np.asarray(split.offsets)]
    words = raw.filter(pa.array(real))
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    keep = np.ones(len(ids), bool)
    found: dict[int, list[Run]] = {}
    for a, b in pieces_of(ids, offsets[:-1][np.diff(offsets) > 0], least):
        doc = int(np.searchsorted(offsets, a, side="right")) - 1
        base = a - int(offsets[doc])
        for start, length, period in runs_of(ids[a:b].tolist(), least):
            found.setdefault(doc, []).append((base + start, length, period))
            keep[a + start + period: a + start + length] = False
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(keep))), " ")
    runs = [[{"start": s, "length": n, "period": p} for s, n, p in found.get(i, ())] for i in range(batch.num_rows)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(runs, kind), joined],
        ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: per document its runs (by start, then period)
    and its words without the repeats, joined by one space."""
    ship_library(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _texts_of(batch):
                yield _collapse(part, least)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select(docs["doc_id"], text_of(docs).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"))
