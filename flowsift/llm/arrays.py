"""Whole-column text work in numpy, on the buffers of Arrow string columns.

All helpers run inside tasks on one bounded piece of a batch at a time (`pieces`), so a task's memory does not grow with the
rows of its partition. Word borders are the six ASCII blanks (space and U+0009 to U+000D), which never occur inside a
multi-byte UTF-8 character, so words can be cut from the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE_BYTES = 3 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """`n` fixed pseudo-random odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def short_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """`df`, with its session told to hand texts to Python in batches of at most `rows` rows: a batch of long texts is held several
    times over outside the heap. A smaller setting of the user's stays."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= rows:
        conf.set(name, str(rows))
    return df


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each; a longer text is a slice of its own."""
    _, offs = string_buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offs, offs[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


class Words:
    """The words of a slice of texts: byte range and 64-bit hash of each, and the range of words of each text.

    `cuts` marks bytes at which a word ends and another begins although no blank parts them.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, fold_case: bool = False, hashed: bool = True, cuts: np.ndarray | None = None):
        n = len(data)
        inside = ~_BLANK[data]
        first = np.zeros(n + 1, dtype=bool)
        first[1:n] = ~inside[:-1] if n else False
        if cuts is not None:
            first[:n] |= cuts
        first[offs] = True
        first = first[:n] & inside
        self.start = np.flatnonzero(first)
        self.of_text = np.searchsorted(self.start, offs)
        self.counts = np.diff(self.of_text)
        blanks = np.concatenate(([0], np.cumsum(~inside)))
        nxt = np.append(self.start[1:], n)
        self.stop = nxt - (blanks[nxt] - blanks[self.start])
        if not hashed:
            return
        lengths = self.stop - self.start
        values = _BYTE_VALUES[_FOLD[data] if fold_case else data]
        values[~inside] = 0
        place = np.arange(n, dtype=np.int64)
        if len(self.start):
            base = np.zeros(n, dtype=np.int64)
            base[self.start] = np.diff(self.start, prepend=0)
            place -= np.cumsum(base)
            top = int(lengths.max()) + 1
            np.clip(place, 0, top - 1, out=place)
            values *= odd_numbers(top, 7)[place]
            self.hash = mix(np.add.reduceat(values, self.start) + lengths.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` neighbours, len(hashes) - k + 1 values; runs over the border of two texts included."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = odd_numbers(k, 99)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += hashes[j : j + n] * factors[j]
    return mix(out)
