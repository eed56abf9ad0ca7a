"""Benchmark passages in documents by the q-gram lemma.

Two strings of n characters with at most e edits share at least n - q + 1 - q * e q-grams, all within e neighbouring diagonals.
Every document is read once: its q-grams are looked up in an index of the benchmark, shared ones are counted in overlapping
bands of diagonals, regions that reach the bound of the lemma are kept and verified by banded alignment.

The benchmark is a stated query set. It is run in blocks of at most about `BLOCK_BYTES` of text, so the index that goes to the
tasks is bounded however large the benchmark is. Where there is more than one block, documents are still read once: a filter of
fixed size over the q-grams of all items passes those that may hold a region, which are written, and the blocks read these alone.
All places and lengths are in characters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.functions.columns import lookup_side
from flowsift.llm.arrays import mix, odd_numbers, pieces, string_buffers
from flowsift.session import materialize

BLOCK_BYTES = 2 << 20
#: Bytes of text that are looked at together; each takes some forty bytes of arrays meanwhile.
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Budget:
    """A region of `length` characters may hold `edits` edits; shorter items get their share of them."""

    q: int = 10
    length: int = 80
    edits: int = 5

    def __post_init__(self) -> None:
        if self.length - self.q + 1 - self.q * self.edits < 1:
            raise ValueError("the lemma gives no bound for these numbers")

    def of(self, size: int) -> tuple[int, int, int]:
        """(region length, edits, least shared q-grams) for an item of `size` characters."""
        n = min(self.length, size)
        e = self.edits * n // self.length
        while e and n - self.q + 1 - self.q * e < 1:
            e -= 1
        return n, e, n - self.q + 1 - self.q * e


def code_points(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of texts given as UTF-8."""
    raw = data.tobytes()
    try:
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        return points, np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offs]
    except UnicodeDecodeError:  # bytes that are no text: every broken one counts as a character
        parts = [raw[a:z].decode("utf-8", "replace") for a, z in zip(offs[:-1].tolist(), offs[1:].tolist())]
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        return points, np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


@lru_cache(maxsize=1)
def _plain() -> np.ndarray:
    """What each code point of the basic plane becomes: its lower case if it is a letter, digit or mark, else a blank."""
    table = np.full(0x10000, 0x20, np.uint32)
    for point in range(0x10000):
        char = chr(point)
        if char.isalnum() or unicodedata.category(char)[0] == "M":
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def normalise(points: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, offsets, place of each in `points`): lower case, a run of anything but letters, digits and marks is one blank.

    Characters beyond the basic plane are letters and stay as they are.
    """
    plain = np.where(points < 0x10000, _plain()[np.minimum(points, 0xFFFF)], points)
    word = plain != 0x20
    after = np.zeros(len(points), dtype=bool)
    after[1:] = word[:-1]
    after[offs[:-1][offs[:-1] < len(points)]] = False
    place = np.flatnonzero(word | after)
    return plain[place], np.searchsorted(place, offs), place


def qgrams(text: np.ndarray, offs: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram at every place; 0 where it would pass the end of its text."""
    n = len(text) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = text.astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(odd_numbers(q, 3).tolist()):
        out += wide[j : j + n] * np.uint64(factor)
    out = mix(out) | np.uint64(1)
    last = np.zeros(len(text) + 1, np.int64)
    np.add.at(last, np.maximum(offs[1:] - q + 1, offs[:-1]), 1)
    np.add.at(last, offs[1:], -1)
    out[np.cumsum(last)[:n] > 0] = 0
    return out


class BenchmarkIndex:
    """q-grams of a block of items with the places they occur at."""

    def __init__(self, items: list[tuple], budget: Budget):
        self.budget = budget
        self.ids = [i for i, _ in items]
        self.text, self.offs, _ = normalise(*code_points(*string_buffers(pa.array([t for _, t in items], pa.string()))))
        grams = qgrams(self.text, self.offs, budget.q)
        at = np.flatnonzero(grams)
        at = at[np.argsort(grams[at], kind="stable")]
        self.grams, first, self.times = np.unique(grams[at], return_index=True, return_counts=True)
        self.first, self.at = first, at
        self.item_of = np.searchsorted(self.offs, at, side="right") - 1
        bounds = [budget.of(int(n)) for n in np.diff(self.offs)]
        self.bounds = np.array(bounds, np.int64).reshape(len(bounds), 3)
        usable = self.bounds[np.diff(self.offs) >= budget.q] if len(bounds) else self.bounds
        self.least = int(usable[:, 2].min()) if len(usable) else 1
        bits = max(16, min(24, int(np.ceil(np.log2(max(2, len(self.grams))))) + 4))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[(self.grams >> self.shift).astype(np.int64)] = True

    def item_text(self, i: int) -> np.ndarray:
        return self.text[self.offs[i] : self.offs[i + 1]]

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers of the benchmark's q-grams there)."""
        at = np.flatnonzero(self.table[(grams >> self.shift).astype(np.int64)])
        got = grams[at]
        number = np.minimum(np.searchsorted(self.grams, got), len(self.grams) - 1)
        same = self.grams[number] == got
        return at[same], number[same]


def _dense(at: np.ndarray, owner: np.ndarray, least: int, width: int) -> np.ndarray:
    """Hits that lie among `least` hits of one text within `width` places."""
    keep = np.zeros(len(at), dtype=bool)
    n = len(at) - least + 1
    if n <= 0:
        return keep
    full = (at[least - 1 :] - at[:n] <= width) & (owner[least - 1 :] == owner[:n])
    marks = np.zeros(len(at) + 1, np.int64)
    marks[:n] += full
    marks[least : least + n] -= full
    return np.cumsum(marks)[:-1] > 0


def aligned(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits between each row of `items` and a stretch of the same row of `texts`: arrays of edits, begins and ends.

    Columns of the tables are places of `texts`; both ends of a text are free. A text is the region with places to spare on
    either side, so each table is a band around one diagonal.
    """
    rows, n = texts.shape
    places = np.arange(n + 1)
    cost = np.zeros((rows, n + 1), np.int64)
    begin = np.broadcast_to(places, cost.shape)
    for j in range(items.shape[1]):
        both = cost + 1
        start = begin.copy()
        swap = cost[:, :-1] + (texts != items[:, j : j + 1])
        better = swap <= both[:, 1:]
        both[:, 1:] = np.where(better, swap, both[:, 1:])
        start[:, 1:] = np.where(better, begin[:, :-1], begin[:, 1:])
        both -= places
        low = np.minimum.accumulate(both, axis=1)
        source = np.maximum.accumulate(np.where(both == low, places, 0), axis=1)
        cost, begin = low + places, np.take_along_axis(start, source, axis=1)
    end = cost.argmin(axis=1)
    each = np.arange(rows)
    return cost[each, end], begin[each, end], end


#: Stretches that are aligned at once, and a code point that no text holds.
_AT_ONCE, _NOTHING = 128, 0xFFFFFFFF


def _verified(index: BenchmarkIndex, item: int, spots: np.ndarray, diagonal: int, text: np.ndarray):
    """Best alignment of a stretch of the item near `diagonal`: (begin, end, item begin, item end, edits) or None.

    `spots` are the places of shared q-grams in the item. If they span more than the region length and all of that is within the
    edits of its length, it is taken whole. Else every stretch of the region length with enough of them is aligned, so by the
    lemma none within the edits is missed; the one with the fewest edits is taken.
    """
    whole = index.item_text(item)
    n, _, least = index.bounds[item].tolist()
    budget = index.budget
    low, high = int(spots[0]), int(spots[-1]) + budget.q

    def check(starts: np.ndarray, size: int):
        most = budget.edits * size // budget.length
        room = most + 2 * budget.edits + 2
        wide = size + 2 * room
        left = np.clip(starts + diagonal - room, 0, len(text))
        first, last = int(left[0]), min(len(text), int(left[-1]) + wide)
        near = np.full(int(left[-1]) + wide - first, _NOTHING, np.uint32)
        near[: last - first] = text[first:last]
        cost, begin, end = aligned(whole[starts[:, None] + np.arange(size)], near[(left - first)[:, None] + np.arange(wide)])
        k = int(cost.argmin())
        if cost[k] > most:
            return None
        return int(left[k] + begin[k]), int(left[k] + end[k]), int(starts[k]), int(starts[k]) + size, int(cost[k])

    if high - low >= n:
        at = low + diagonal
        if 0 <= at and at + high - low <= len(text) and np.array_equal(text[at : at + high - low], whole[low:high]):
            return at, at + high - low, low, high, 0
        if high - low > n and (found := check(np.array([low]), high - low)):
            return found
    starts = np.arange(max(0, low - n), min(high, len(whole) - n) + 1)
    held = np.searchsorted(spots, starts + n - budget.q, side="right") - np.searchsorted(spots, starts)
    starts = starts[held >= least]
    found = None
    for k in range(0, len(starts), _AT_ONCE):
        got = check(starts[k : k + _AT_ONCE], n)
        if got and (found is None or got[4] < found[4]):
            found = got
            if found[4] == 0:
                break
    return found


#: Pairs of a place in a text and an occurrence in the benchmark that are looked at together.
PAIRS = 1_000_000


def regions(index: BenchmarkIndex, data: np.ndarray, offs: np.ndarray) -> list[tuple]:
    """(text number, item number, begin, end, item begin, item end, edits) of the best region per text and item.

    `begin` and `end` are places among the code points of all texts.
    """
    points, starts = code_points(data, offs)
    text, bounds, place = normalise(points, starts)
    budget = index.budget
    if not len(index.grams) or not len(text):
        return []
    at, number = index.hits(qgrams(text, bounds, budget.q))
    owner = np.searchsorted(bounds, at, side="right") - 1
    keep = _dense(at, owner, index.least, budget.length + budget.edits - budget.q)
    at, number, owner = at[keep], number[keep], owner[keep]
    best: dict[tuple[int, int], tuple] = {}
    # texts whose pairs are few go together, one with very many (a ruler, a grid of numbers) goes by slices of its diagonals
    edges = np.append(np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))), len(owner)) if len(owner) else np.zeros(1, int)
    weight = np.add.reduceat(index.times[number], edges[:-1]) if len(owner) else np.zeros(0, int)
    begin = 0
    while begin < len(weight):
        end = begin + 1
        total = int(weight[begin])
        while end < len(weight) and total + weight[end] <= PAIRS:
            total += int(weight[end])
            end += 1
        here = slice(edges[begin], edges[end])
        _search(index, text, bounds, place, at[here], number[here], owner[here], total, best)
        begin = end
    return [best[k] for k in sorted(best)]


def _spread(begin: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run, place) of every place of the runs that begin at `begin` and are `times` long."""
    many = np.repeat(np.arange(len(times)), times)
    return many, begin[many] + np.arange(len(many)) - np.repeat(np.cumsum(times) - times, times)


def _search(index: BenchmarkIndex, text, bounds, place, at, number, owner, total: int, best: dict) -> None:
    """Regions among hits. If there are more than `PAIRS` pairs, all of one text, item by item and in slices of diagonals."""
    if total <= PAIRS:
        many, source = _spread(index.first[number], index.times[number])
        item = index.item_of[source]
        _among(index, text, bounds, place, owner[many], item, index.at[source] - index.offs[item], at[many] - bounds[owner[many]], None, best)
        return
    width, doc, local = 2 * max(1, index.budget.edits), int(owner[0]), at - bounds[owner[0]]
    gram_of = np.repeat(np.arange(len(index.grams)), index.times)
    met = np.zeros(len(index.grams), dtype=bool)
    met[number] = True
    for i in np.unique(index.item_of[met[gram_of]]).tolist():
        size = int(index.offs[i + 1] - index.offs[i])
        own = np.flatnonzero((index.item_of == i) & met[gram_of])
        # the item's occurrences by q-gram and place, so that those of a range of diagonals are a run for every place of the text
        reach = size + 1
        keys = gram_of[own] * reach + index.at[own] - index.offs[i]
        most = int(np.unique(gram_of[own], return_counts=True)[1].max())
        step = max(2 * width, PAIRS // most - size, int(np.sqrt(PAIRS + size * size / 4) - size / 2))
        for low in range(-size - width, int(local[-1]) + 1, step):
            had = best.get((doc, i))
            if had and had[6] == 0 and had[5] - had[4] == size:
                break  # an item that is there whole and without an edit cannot be found better
            high = low + step
            here = slice(*np.searchsorted(local, [low - width, high + size + 2 * width]))
            spot_from = np.clip(local[here] - high - width, 0, reach - 1)
            spot_to = np.clip(local[here] - low + width + 1, 0, reach)
            begin = np.searchsorted(keys, number[here] * reach + spot_from)
            end = np.searchsorted(keys, number[here] * reach + np.maximum(spot_to, spot_from) - 1, side="right")
            many, source = _spread(begin, np.maximum(end - begin, 0))
            if len(many):
                spot = index.at[own[source]] - index.offs[i]
                _among(index, text, bounds, place, np.full(len(many), doc), np.full(len(many), i), spot, local[here][many], (low, high), best)


def _among(index: BenchmarkIndex, text, bounds, place, owner, item, spot, local, cut, best: dict) -> None:
    """Regions among pairs (text, item, place in the item, place in the text); with `cut` those of bands that begin in a range."""
    budget = index.budget
    diagonal = local - spot
    width = 2 * max(1, budget.edits)
    for offset in (0, width // 2):  # bands overlap by half: any `edits` + 1 neighbours lie in one of them
        band = (diagonal + offset) // width
        order = np.lexsort((spot, band, item, owner))
        if cut is not None:
            begins = band[order] * width - offset
            order = order[(begins >= cut[0]) & (begins < cut[1])]
        if not len(order):
            continue
        key = np.stack([owner, item, band], axis=1)[order]
        spots, diagonals = spot[order], diagonal[order]
        edges = np.append(np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))), len(order))
        enough = np.diff(edges) >= index.bounds[key[edges[:-1], 1], 2]
        for a, z in zip(edges[:-1][enough].tolist(), edges[1:][enough].tolist()):
            doc, i = int(key[a, 0]), int(key[a, 1])
            n, e, least = index.bounds[i].tolist()
            here = np.unique(spots[a:z])
            dense = _dense(here, np.zeros(len(here), np.int64), least, n - budget.q)
            if not dense.any():
                continue
            kept = here[dense]
            breaks = np.flatnonzero(np.diff(kept) > n - budget.q) + 1
            for part in np.split(kept, breaks):
                low, high = int(part[0]), int(part[-1]) + budget.q
                had = best.get((doc, i))
                if had and had[6] == 0 and had[4] <= low and had[5] >= high:
                    continue
                among = (spots[a:z] >= low) & (spots[a:z] < high)
                middle = int(np.median(diagonals[a:z][among]))
                got = _verified(index, i, part, middle, text[bounds[doc] : bounds[doc + 1]])
                if got and (had is None or (got[4], got[2] - got[3]) < (had[6], had[4] - had[5])):
                    begin, end = place[bounds[doc] + got[0]], place[bounds[doc] + max(got[0], got[1] - 1)]
                    best[(doc, i)] = (doc, i, int(begin), int(end) + 1, got[2], got[3], got[4])


#: Bits of the filter over all q-grams of the benchmark, and places of a q-gram in it.
FILTER_BITS, FILTER_PLACES = 27, 2


class GramFilter:
    """A filter of fixed size over all q-grams of a benchmark of any size; it passes every text that holds a region, and few others."""

    def __init__(self, budget: Budget):
        self.budget, self.least = budget, 1 << 30
        self.bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)

    @staticmethod
    def _places(grams: np.ndarray) -> list[np.ndarray]:
        return [(odd_numbers(FILTER_PLACES, 41)[k] * grams) >> np.uint64(64 - FILTER_BITS) for k in range(FILTER_PLACES)]

    def add(self, index: BenchmarkIndex) -> None:
        self.least = min(self.least, index.least) if len(index.grams) else self.least
        for at in self._places(index.grams):
            np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def passes(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Texts that have enough q-grams of the benchmark within the reach of a region."""
        text, bounds, _ = normalise(*code_points(data, offs))
        grams = qgrams(text, bounds, self.budget.q)
        known = grams != 0
        for at in self._places(grams):
            known &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        at = np.flatnonzero(known)
        owner = np.searchsorted(bounds, at, side="right") - 1
        found = np.zeros(len(offs) - 1, dtype=bool)
        found[owner[_dense(at, owner, self.least, self.budget.length + self.budget.edits - self.budget.q)]] = True
        return found


class _Benchmark:
    """The items of a benchmark in blocks, each indexed when it is asked for."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, budget: Budget):
        items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("text is not null")
        total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.n, self.items, self.budget = max(1, -(-total // BLOCK_BYTES)), items, budget

    def blocks(self) -> Iterator[BenchmarkIndex]:
        block = F.pmod(F.xxhash64("item", "text"), F.lit(self.n))
        for b in range(self.n):
            rows = self.items.where(block == b).distinct().collect()
            yield BenchmarkIndex(sorted(((r["item"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0], r[1])), self.budget)

    def candidates(self, docs: DataFrame, text_col: str) -> DataFrame:
        """Of many blocks' sake, the rows of `docs` that may hold a region of any item, written: the blocks read these alone."""
        passing = GramFilter(self.budget)
        for index in self.blocks():
            passing.add(index)
        sent = docs.sparkSession.sparkContext.broadcast(passing)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, text_col, SLICE_BYTES):
                    yield piece.filter(pa.array(sent.value.passes(*string_buffers(piece.column(text_col)))))

        return materialize(docs.mapInArrow(run, docs.schema), "candidates")


def leaked_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    budget: Budget = Budget(),
) -> DataFrame:
    """One row per document and benchmark item found in it: the best region.

    Columns: `id_col`, `item_col`, `start`, `end` (code points of the text, end exclusive), `item_start`, `item_end` (characters of
    the normalised item), `edits`, `item_chars`. A region is a stretch of an item of `budget.length` normalised characters or more
    (the whole item, if shorter) with at most `budget.edits` edits in that length, in proportion.

    Null and empty texts have no rows, nor have items of fewer than `q` normalised characters. Repeated rows and rows with a
    null id are searched one by one; copies of an item are one item. Other columns are not read; an empty table on either side
    gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = _Benchmark(benchmark, item_col, item_text_col, budget)
    if known.n > 1:
        source = known.candidates(source, "text")
    context = docs.sparkSession.sparkContext
    found = None
    for index in known.blocks():
        sent = context.broadcast(index)
        part = source.mapInArrow(_find(sent), _FOUND)
        if known.n > 1:  # written at once, so that one block's index is held at a time
            part = materialize(part, "leaks")
            sent.destroy()
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


_FOUND = "id long, item long, start long, end long, item_start long, item_end long, edits long, item_chars long"


def _find(sent):
    names = ["id", "item", "start", "end", "item_start", "item_end", "edits", "item_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            for piece in pieces(batch, "text", SLICE_BYTES):
                data, offs = string_buffers(piece.column("text"))
                ids, rows = piece.column("id").to_pylist(), []
                starts = None
                for doc, i, begin, end, a, z, edits in regions(index, data, offs):
                    starts = code_points(data, offs)[1] if starts is None else starts
                    first = int(starts[doc])
                    rows.append((ids[doc], index.ids[i], begin - first, end - first, a, z, edits, int(index.offs[i + 1] - index.offs[i])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return run


def _drop(sent, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            for piece in pieces(batch, text_col, SLICE_BYTES):
                clean = np.ones(piece.num_rows, dtype=bool)
                clean[[r[0] for r in regions(index, *string_buffers(piece.column(text_col)))]] = False
                yield piece.filter(pa.array(clean))

    return run


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", budget: Budget = Budget()
) -> DataFrame:
    """Rows of `docs` in whose text no benchmark passage was found (see `leaked_passages`), with all their columns.

    Rows with a null or empty text stay, repeated rows stay or go together, rows with a null id are judged like any other. A benchmark
    of one block is looked for while the documents are read. One of more is looked for in the candidates alone, and
    documents whose text is found there go.
    """
    known = _Benchmark(benchmark, item_col, item_text_col, budget)
    context = docs.sparkSession.sparkContext
    if known.n == 1:
        return docs.mapInArrow(_drop(context.broadcast(next(known.blocks())), text_col), docs.schema)
    texts = docs.select(F.sha2(F.col(text_col), 256).alias("digest"), F.col(text_col).alias("text")).where("text is not null")
    candidates = known.candidates(texts, "text")
    leaks = None
    for index in known.blocks():
        sent = context.broadcast(index)
        clean = candidates.mapInArrow(_drop(sent, "text"), candidates.schema).select("digest").distinct()
        found = materialize(candidates.select("digest").distinct().join(clean, "digest", "left_anti"), "leaks")
        sent.destroy()
        leaks = found if leaks is None else leaks.unionByName(found)
    gone = lookup_side(leaks.distinct())
    return docs.join(gone, F.sha2(F.col(text_col), 256) == gone["digest"], "left_anti")
