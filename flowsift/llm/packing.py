"""Sequence packing as vector bin packing with the dot-product heuristic.

Every partition packs its own rows while it reads them: nothing is shuffled, and a task holds a bounded pool of open
pieces. The open bin takes, again and again, the piece with the largest dot product of its demand and what the bin has left
in tokens, segments and loss-bearing tokens; when none fits whole, one is cut to fill the bin.

Sequence ids come from the partition number and a counter, so a repeated task gives the same rows as long as its input has a
fixed order: give this operator a table or a scan, as the pipeline does, not the direct output of a shuffle.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.arrays import Words, pieces, string_buffers

#: Words whose ids a worker keeps; the store is emptied when it is full.
CACHE_WORDS = 1_000_000
#: Open pieces of a task.
POOL = 512


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 4096
    segments: int = 512
    loss: int = 4096

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1 or self.tokens & (self.tokens - 1):
            raise ValueError("limits must be positive and the token limit a power of two")


#: 1: ASCII letters and digits, 2: punctuation that no subword shares with them, 0: everything else.
_CHARACTERS = np.zeros(256, np.uint8)
_CHARACTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CHARACTERS[list(b'.,!?;:*#$%&()"')] = 2


class WordTokenizer:
    """Ids of whole texts for a lower-casing tokenizer that never joins what blanks part, nor letters with punctuation.

    Each distinct word is encoded once and found again by its hash. Words are cut at ASCII blanks and where an ASCII letter or
    digit meets plain punctuation, so a word with another kind of blank or a special token in it is still encoded by the
    tokenizer itself. New words of letters alone are encoded many at a time and parted by their closing subwords.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closing[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 12, np.int64)

    def _learn(self, words: list[str], hashes: list[int]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self._clear()
        plain = [i for i, w in enumerate(words) if w.isalpha() and max(w) < "\u0130"]
        groups = [plain[a : a + 200] for a in range(0, len(plain), 200)]
        lines = self.model.encode_batch_fast([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)
        order, parts, sizes = [], [], []
        for group, line in zip(groups, lines):
            ids = np.array(line.ids, np.uint32)
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(group) and (not len(ends) or ends[-1] == len(ids)):
                order.extend(group)
                parts.append(ids)
                sizes.append(np.diff(ends, prepend=0))
        left = sorted(set(range(len(words))) - set(order))
        rows = [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast([words[i] for i in left], add_special_tokens=False)]
        order.extend(left)
        flat = np.concatenate([*parts, *rows, np.zeros(0, np.uint32)])
        sizes = np.concatenate([*sizes, np.array([len(r) for r in rows], np.int64)])
        n = len(self.known)
        end = int(self.bounds[n])
        while end + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(order) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.ids[end : end + len(flat)] = flat
        self.bounds[n + 1 : n + len(order) + 1] = end + np.cumsum(sizes)
        self.known.update(zip([hashes[i] for i in order], range(n, n + len(order))))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text's ids)."""
        data, offs = string_buffers(column)
        raw = data.tobytes()
        kind = _CHARACTERS[data]
        cuts = np.zeros(len(data), dtype=bool)
        cuts[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        # special tokens are told apart by case, so texts with anything like one are not folded
        words = Words(data, offs, fold_case=b"<|" not in raw, cuts=cuts)
        distinct, first, code = np.unique(words.hash, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        for begin in range(0, len(keys), CACHE_WORDS):
            part = keys[begin : begin + CACHE_WORDS]
            missing = [i for i, k in enumerate(part, begin) if k not in self.known]
            if missing:
                if len(self.known) + len(missing) > CACHE_WORDS:
                    self._clear()
                    missing = list(range(begin, begin + len(part)))
                at = first[missing]
                texts = [raw[a:z].decode("utf-8", "replace") for a, z in zip(words.start[at].tolist(), words.stop[at].tolist())]
                self._learn(texts, [keys[i] for i in missing])
            if len(keys) <= CACHE_WORDS:
                slot = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
                begins, sizes = self.bounds[slot], np.diff(self.bounds)[slot]
                return self._gather(begins[code], sizes[code], words.of_text)
        return self._plain(column)

    def _gather(self, begins: np.ndarray, sizes: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.concatenate(([0], np.cumsum(sizes)))
        source = np.repeat(begins - ends[:-1], sizes) + np.arange(ends[-1])
        return self.ids[source], ends[of_text]

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A text with more distinct words than the store holds is encoded whole."""
        rows = [self.model.encode(t or "", add_special_tokens=False).ids for t in column.to_pylist()]
        flat = np.fromiter((x for r in rows for x in r), np.uint32)
        return flat, np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_for(path: str) -> WordTokenizer:
    """One tokenizer with its word store per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class Packer:
    """Bins of one partition. `place` takes an example, `finish` closes what is open; both give finished pieces."""

    def __init__(self, limits: Limits, first_id: int):
        self.limits, self.next_id = limits, first_id
        self.full = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.keys: list[tuple] = [()] * POOL
        self.demand = np.zeros((POOL, 3))
        self.n = 0
        self.open: list[tuple] = []
        self.left = self.full.copy()
        self.done: list[tuple] = []

    def place(self, key, ids: np.ndarray, loss_from: int) -> None:
        """Put in `ids`; those from `loss_from` on bear loss. Whole sequences go out at once, the rest to the pool."""
        size, start = len(ids), 0
        while size - start >= self.limits.tokens and self._loss(start, start + self.limits.tokens, loss_from) <= self.limits.loss:
            self.done.append((key, start, ids[start : start + self.limits.tokens], size, self.next_id, 0))
            self.next_id += 1
            start += self.limits.tokens
        while start < size:
            stop = min(size, start + self.limits.tokens)
            stop = min(stop, max(start, loss_from) + self.limits.loss)
            if self.n == POOL:
                self._fill()
            self._keep(key, ids, size, start, stop, loss_from)
            start = stop

    @staticmethod
    def _loss(start: int, stop: int, loss_from: int) -> int:
        return max(0, stop - max(start, loss_from))

    def _keep(self, key, ids, size, start, stop, loss_from) -> None:
        self.keys[self.n] = (key, ids, size, start, stop, loss_from)
        self.demand[self.n] = (stop - start, 1, self._loss(start, stop, loss_from))
        self.n += 1

    def _take(self, at: int) -> tuple:
        self.n -= 1
        got, self.keys[at], self.keys[self.n] = self.keys[at], self.keys[self.n], ()
        self.demand[at] = self.demand[self.n]
        return got

    def _put(self, key, ids, size, start, stop, loss_from) -> None:
        self.open.append((key, start, ids[start:stop], size))
        self.left -= (stop - start, 1, self._loss(start, stop, loss_from))

    def _best(self) -> tuple[int, bool]:
        """(piece with the largest dot product, whether it fits whole)."""
        need = self.demand[: self.n]
        score = (need / self.full**2) @ (self.left * need.mean(axis=0) / self.full)
        fits = (need <= self.left).all(axis=1)
        if fits.any():
            return int(np.argmax(np.where(fits, score, -1.0))), True
        return int(np.argmax(score)), False

    def _fill(self) -> None:
        """Fill the open bin from the pool, cut one piece if it must, and close it."""
        while self.n and self.left[:2].min() >= 1:
            at, whole = self._best()
            key, ids, size, start, stop, loss_from = self._take(at)
            if not whole:
                cut = min(start + int(self.left[0]), max(start, loss_from) + int(self.left[2]))
                if cut <= start:
                    self._keep(key, ids, size, start, stop, loss_from)
                    break
                if cut < stop:
                    self._keep(key, ids, size, cut, stop, loss_from)
                stop = min(cut, stop)
            self._put(key, ids, size, start, stop, loss_from)
        self._close(False)

    def _close(self, last: bool) -> None:
        """Give out the open bin; the last one is cut into sequences whose lengths are powers of two, without padding."""
        total = sum(len(p[2]) for p in self.open)
        room = total if not last or not total else 1 << (total.bit_length() - 1)
        offset = 0
        for key, start, ids, size in self.open:
            while len(ids):
                take = min(len(ids), room - offset)
                self.done.append((key, start, ids[:take], size, self.next_id, offset))
                start, ids, offset, total = start + take, ids[take:], offset + take, total - take
                if offset == room and total:
                    self.next_id, offset, room = self.next_id + 1, 0, 1 << (total.bit_length() - 1)
        self.next_id += bool(self.open)
        self.open, self.left = [], self.full.copy()

    def finish(self) -> None:
        while self.n:
            before = self.n
            if self.demand[: self.n, 0].sum() <= self.left[0] and self.n <= self.left[1] and self.demand[: self.n, 2].sum() <= self.left[2]:
                for _ in range(before):
                    self._put(*self._take(self.n - 1))
                self._close(True)
            else:
                self._fill()

    def drain(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2].astype("<u4").tobytes() for r in rows], pa.binary()),
                pa.array([r[3] for r in rows], pa.int64()),
                pa.array([r[4] for r in rows], pa.int64()),
                pa.array([r[5] for r in rows], pa.int64()),
            ],
            names=["id", "start", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def _pack(path: str, end_id: int, limits: Limits, prompted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer_for(path)
        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for piece in pieces(batch, "text"):
                flat, bounds = model.encode(piece.column("text"))
                before, heads = model.encode(piece.column("prompt")) if prompted else (None, None)
                for i, key in enumerate(piece.column("id").to_pylist()):
                    ids, loss_from = flat[bounds[i] : bounds[i + 1]], 0
                    if prompted:
                        head = before[heads[i] : heads[i + 1]]
                        ids, loss_from = np.concatenate([head, ids]), len(head)
                    packer.place(key, np.append(ids, np.uint32(end_id)), loss_from)
                if packer.done:
                    yield packer.drain()
        packer.finish()
        yield packer.drain()

    return run


def pack_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    end_id: int = 2,
    limits: Limits = Limits(),
) -> DataFrame:
    """Pieces of tokenized examples in sequences: `id_col`, `start`, `length`, `ids`, `doc_tokens`, `sequence_id`, `offset`.

    An example is the ids of its prompt (if `prompt_col` is named), those of its text and `end_id`; loss falls on all but the
    prompt. `ids` holds little-endian unsigned 32-bit ids. Every id is in exactly one piece, pieces of a sequence lie gapless
    from offset 0, and no sequence passes any of the limits.

    Null and empty texts are examples of `end_id` alone. Repeated rows and rows with a null id are examples like any other.
    Other columns are not read; an empty table gives an empty result.
    """
    columns = [F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")]
    columns += [F.col(prompt_col).alias("prompt")] if prompt_col else []
    packed = docs.select(*columns).mapInArrow(
        _pack(tokenizer_path, end_id, limits, prompt_col is not None),
        "id long, start long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
    return packed.select(
        F.col("id").alias(id_col),
        "start",
        (F.length("ids") / 4).cast("long").alias("length"),
        "ids",
        "doc_tokens",
        "sequence_id",
        "offset",
    )
