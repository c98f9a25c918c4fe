"""SentencePiece BPE encoding and decoding as vectorised merge rounds.

The model's vocabulary is read through the library; encoding and decoding are
done here.  Texts are cut before each run of spaces (no vocabulary entry has a
space behind another character), each distinct word of a block is encoded once,
and all words are merged together in flat numpy arrays.  A round looks up the
rank of every adjacent pair, takes each word's smallest (a segmented minimum),
merges its leftmost occurrence, and compacts the arrays; words without a pair
leave.  Where the merged piece takes part in no pair of a smaller rank, the other
occurrences would be merged next anyway, so they are merged in the same round.

Defined results: a null text counts as empty, and an empty text gives only the
begin and end ids; unknown characters become byte ids; decoding skips control
ids, drops the space that encoding puts before a text, and gives U+FFFD for each byte of
an invalid byte run; memory is bounded by a block of characters, however long a
text is; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mise.llm.common import text_of, with_suffix_free
from mise.session import ship_library

MODEL = "piece_bpe_32k.model"
BLOCK_CHARS = 1 << 19  # characters whose words are held at once
CACHE_WORDS = 1 << 18
_NONE = np.iinfo(np.int32).max
_SPACE = "▁"
_WORD = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path(MODEL)


class Pieces:
    """A model's vocabulary as arrays, with a bounded cache of encoded words."""

    def __init__(self, model_file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.bos, self.eos = model.bos_id(), model.eos_id()
        names = [model.id_to_piece(i) for i in range(n)]
        special = {i for i in range(n) if model.is_control(i) or model.is_byte(i) or model.is_unknown(i)}
        ids = {p: i for i, p in enumerate(names) if i not in special}
        if any(_SPACE in p.lstrip(_SPACE) for p in ids):
            raise ValueError("a vocabulary entry has a space behind another character")
        self.byte_ids = np.zeros(256, np.int32)
        surface: list[bytes] = []
        for i, p in enumerate(names):
            if model.is_byte(i):
                self.byte_ids[int(p[1:-1], 16)] = i
                surface.append(bytes([int(p[1:-1], 16)]))
            elif model.is_control(i):
                surface.append(b"")
            elif model.is_unknown(i):
                surface.append(" ⁇ ".encode())
            else:
                surface.append(p.replace(_SPACE, " ").encode())
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])
        self.surface_len = np.array([len(s) for s in surface], np.int64)
        self.surface_at = np.concatenate([[0], np.cumsum(self.surface_len)])[:-1]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.char_id = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        # every way to put an entry together from two entries; the smallest rank wins
        order = {i: r for r, i in enumerate(sorted(ids.values(), key=lambda i: (-model.get_score(i), i)))}
        pairs = sorted((ids[p[:k]] * n + ids[p[k:]], order[i], i) for p, i in ids.items()
                       for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
        self.n = n
        self.pair_key = np.array([k for k, _, _ in pairs], np.int64)
        self.pair_rank = np.array([r for _, r, _ in pairs], np.int32)
        self.rank_piece = np.zeros(n, np.int32)
        least = np.full(n, _NONE, np.int64)  # smallest rank of a pair that a piece takes part in
        for key, rank, piece in pairs:
            self.rank_piece[rank] = piece
            for part in divmod(key, n):
                least[part] = min(least[part], rank)
        self.at_once = np.zeros(n, bool)  # by rank: all occurrences may be merged together
        for rank in {r for _, r, _ in pairs}:
            self.at_once[rank] = least[self.rank_piece[rank]] > rank
        touching = {(ord(a), ord(b)) for p in ids for a, b in zip(p, p[1:], strict=False)}
        self.touching = np.array(sorted(a << 21 | b for a, b in touching), np.int64)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.n + right
        spot = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[spot] == key) & (left >= 0) & (right >= 0), self.pair_rank[spot], _NONE)

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in turn, number of ids of each word)."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), sizes)
        sym = self.char_id[code]
        sym = np.where(sym < 0, -1 - code, sym).astype(np.int64)  # unknown: minus the character, less one
        # characters that touch in no entry never merge: cut there as well
        touch = code[:-1] << 21 | code[1:]
        spot = np.minimum(np.searchsorted(self.touching, touch), len(self.touching) - 1)
        cut = np.ones(len(code), bool)
        cut[1:] = (owner[1:] != owner[:-1]) | (self.touching[spot] != touch)
        part = np.cumsum(cut) - 1
        place = np.arange(len(code))  # order of the symbols that are left
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(sym), _NONE, np.int32)
        inner = np.nonzero(part[1:] == part[:-1])[0]
        rank[inner] = self._ranks(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.nonzero(np.concatenate([[True], part[1:] != part[:-1]]))[0]
            least = np.minimum.reduceat(rank, starts)
            lens = np.diff(np.append(starts, len(sym)))
            over = np.repeat(least == _NONE, lens)
            if over.any():
                done.append((place[over], sym[over]))
                keep = ~over
                sym, part, place, rank = sym[keep], part[keep], place[keep], rank[keep]
                lens, least = lens[least != _NONE], least[least != _NONE]
                if not len(sym):
                    break
            hit = np.nonzero(rank == np.repeat(least, lens))[0]
            first = np.concatenate([[True], part[hit[1:]] != part[hit[:-1]]])
            # within a run of overlapping occurrences every other one, from the left
            fresh = first | np.concatenate([[True], np.diff(hit) != 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            take = ((np.arange(len(hit)) - run) % 2 == 0) & (first | self.at_once[rank[hit]])
            hit = hit[take]
            sym[hit] = self.rank_piece[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            new = np.cumsum(keep) - 1
            sym, part, place, rank = sym[keep], part[keep], place[keep], rank[keep]
            at = new[hit]
            last = np.append(part[1:] != part[:-1], True)
            rank[at] = _NONE
            behind = at[~last[at]]
            rank[behind] = self._ranks(sym[behind], sym[behind + 1])
            before = at[at > 0] - 1
            before = before[part[before] == part[before + 1]]
            rank[before] = self._ranks(sym[before], sym[before + 1])
        where = np.concatenate([p for p, _ in done])
        flat = np.concatenate([s for _, s in done])
        back = np.argsort(where, kind="stable")
        where, flat = where[back], flat[back]
        owner = owner[where]
        if (flat < 0).any():  # unknown characters as bytes
            out, who = [], []
            at = 0
            for i in np.nonzero(flat < 0)[0].tolist():
                raw = chr(int(-1 - flat[i])).encode("utf-8", "surrogatepass")
                out += [flat[at:i], self.byte_ids[np.frombuffer(raw, np.uint8)]]
                who += [owner[at:i], np.full(len(raw), owner[i])]
                at = i + 1
            flat, owner = np.concatenate([*out, flat[at:]]), np.concatenate([*who, owner[at:]])
        return flat.astype(np.int32), np.bincount(owner, minlength=len(words))

    def _lookup(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new and len(self.known) + len(new) > CACHE_WORDS:
            self._reset()
            new = list(dict.fromkeys(words))
        if new:
            ids, lens = self.merge_words(new)
            n = len(self.known)
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(lens) - lens])
            self.len = np.concatenate([self.len, lens])
            self.ids = np.concatenate([self.ids, ids])
            self.known.update(zip(new, range(n, n + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        parts = [_WORD.findall(t) for t in texts]
        words = self._lookup([w for p in parts for w in p])
        ids = _spans(self.ids, self.at[words], self.len[words])
        ends = np.cumsum(np.concatenate([[0], self.len[words]]))[np.cumsum([len(p) for p in parts])]
        return np.split(ids, ends[:-1])

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text with begin and end ids, a block at a time."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            if len(text) > BLOCK_CHARS:
                yield from self._framed(waiting)
                waiting, size = [], 0
                yield np.concatenate([[self.bos], *[self._block([b])[0] for b in _blocks(_SPACE + text.replace(" ", _SPACE))],
                                      [self.eos]]).astype(np.int32)
                continue
            waiting.append(text)
            size += len(text)
            if size > BLOCK_CHARS:
                yield from self._framed(waiting)
                waiting, size = [], 0
        yield from self._framed(waiting)

    def _framed(self, texts: list[str]) -> Iterator[np.ndarray]:
        if texts:
            for ids in self._block([_SPACE + t.replace(" ", _SPACE) if t else "" for t in texts]):
                yield np.concatenate([[self.bos], ids, [self.eos]]).astype(np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the ids, as UTF-8."""
        ids = np.asarray(ids, np.int64)
        raw = _spans(self.surface, self.surface_at[ids], self.surface_len[ids]).tobytes()
        shown = np.nonzero(self.surface_len[ids])[0]
        lead = int(len(shown) and not self.is_byte[ids[shown[0]]] and raw[:1] == b" " and ids[shown[0]] != 0)
        if self.is_byte[ids].any():
            try:
                raw.decode("utf-8")
            except UnicodeDecodeError:
                raw = b"".join(self._runs(ids))
        return raw[lead:]

    def _runs(self, ids: np.ndarray) -> Iterator[bytes]:
        edge = np.nonzero(np.diff(self.is_byte[ids].astype(np.int8)))[0] + 1
        for part in np.split(ids, edge):
            raw = _spans(self.surface, self.surface_at[part], self.surface_len[part]).tobytes()
            if not len(part) or not self.is_byte[part[0]]:
                yield raw
                continue
            while raw:
                for k in (1, 2, 3, 4):
                    try:
                        raw[:k].decode("utf-8")
                    except UnicodeDecodeError:
                        continue
                    yield raw[:k]
                    break
                else:
                    k = 1
                    yield "�".encode()
                raw = raw[k:]


def _spans(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``flat[at:at + size]`` one after another."""
    total = int(size.sum())
    if not total:
        return flat[:0]
    shift = np.repeat(at - (np.cumsum(size) - size), size)
    return flat[np.arange(total) + shift]


def _blocks(text: str) -> Iterator[str]:
    """A long text in blocks that end before a run of spaces."""
    at = 0
    while at < len(text):
        end = at + BLOCK_CHARS
        while 0 < end < len(text) and not (text[end] == _SPACE and text[end - 1] != _SPACE):
            nxt = text.find(_SPACE, end + 1 if text[end] != _SPACE else end)
            if nxt < 0:
                end = len(text)
            elif text[nxt - 1] != _SPACE:
                end = nxt
            else:  # inside a run of spaces: go behind it
                while nxt < len(text) and text[nxt] == _SPACE:
                    nxt += 1
                end = nxt
        yield text[at:end]
        at = end


@cache
def loaded(model_file: str) -> Pieces:
    return Pieces(model_file)


def _rows(docs: DataFrame, model_file: str, make, fields: str, carry: list[str]) -> DataFrame:
    ship_library(docs.sparkSession)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    schema = ", ".join(x for x in (kinds, fields) if x)
    names = [*carry, *[f.strip().split(" ")[0] for f in fields.split(",")]]
    whole = with_suffix_free(docs, "whole")
    source = docs.select(*[docs[c] for c in carry], text_of(docs).alias(whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = pieces.encode(t.as_py() for t in part.column(whole))
                made = make(pieces, ids)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carry], *made], names)

    return source.mapInArrow(run, schema)


def _digests(pieces: Pieces, encoded: Iterator[np.ndarray]) -> list[pa.Array]:
    n, ids_sha, text_sha = [], [], []
    for ids in encoded:
        n.append(len(ids))
        ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
        text_sha.append(hashlib.sha256(pieces.decode(ids)).hexdigest())
    return [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]


def _ids(_: Pieces, encoded: Iterator[np.ndarray]) -> list[pa.Array]:
    parts = list(encoded)
    ends = np.cumsum([0, *[len(p) for p in parts]]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))]


def _both(pieces: Pieces, encoded: Iterator[np.ndarray]) -> list[pa.Array]:
    parts = list(encoded)
    return [*_digests(pieces, iter(parts)), *_ids(pieces, iter(parts))]


def encoded_with_digests(docs: DataFrame, model_file: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``digests``, with ``ids array<int>`` as well."""
    return _rows(docs, model_file or default_model(), _both,
                 "n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>", list(carry))


def encoded(docs: DataFrame, model_file: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``ids array<int>``."""
    return _rows(docs, model_file or default_model(), _ids, "ids array<int>", list(carry))


def digests(docs: DataFrame, model_file: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, ``n_tokens``, and SHA-256 of the ids and of the decoded text."""
    return _rows(docs, model_file or default_model(), _digests,
                 "n_tokens long, ids_sha256 string, decoded_sha256 string", list(carry))


def decoded(rows: DataFrame, model_file: str | None = None) -> DataFrame:
    """``rows`` (with ``ids array<int>``) as ``doc_id, text``; null ids give a null text."""
    ship_library(rows.sparkSession)
    file = model_file or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(file)
        for batch in batches:
            texts = [None if ids.as_py() is None else pieces.decode(np.array(ids.as_py(), np.int64)).decode("utf-8")
                     for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
