"""Frequent phrases and their collocation scores by multikey quicksort of suffix pointers.

A suffix is a word position with up to `longest` words from there to the end of its piece. Tasks cut texts into words, order the
suffixes of a stretch of text and fold equal ones, and route them by their leading two words as compact blocks (a dictionary
of words, one column of codes per depth, counts). Where suffixes meet, pointers to them go through a three-way quicksort:
partitions by less, equal and greater than a pivot word, the equal ones going on with the next word. The weight of an equal
partition is the count of its phrase, and a partition lighter than the least count is abandoned, whatever it holds.

A route that holds more than `ROUTE_ROWS` suffixes is dealt out again by one word more, as often as it takes; the phrases
that are shorter than the new lead are then counted from their own, folded blocks. So no task holds more than a bounded part
of even the commonest pair of words. Words are compared as they are, hashes only choose routes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.arrays import _FOLD, mix, odd_numbers, pieces, string_buffers
from flowsift.session import materialize

#: Bytes of text that are folded together before they are routed, and those that are cut into words at once.
CHUNK_BYTES, CUT_BYTES = 8 << 20, 2 << 20
#: Bytes of text for each route of suffixes.
ROUTE_BYTES = 8 << 20
#: A route with more suffixes than this is dealt out again.
ROUTE_ROWS = 4_000_000

_OUTSIDE = np.zeros(256, dtype=bool)
_OUTSIDE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = True

BLOCK = "lang string, low int, high int, route long, n long, words binary, codes binary, counts binary"


def _cut(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words of a slice of texts, words from each to the end of its piece, text of each)."""
    data, offs = string_buffers(column)
    inside = ~_OUTSIDE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_text = offs[:-1][np.diff(offs) > 0]
    first[starts_text] = inside[starts_text]
    start = np.flatnonzero(first)
    if not len(start):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = np.cumsum(inside)
    bounds = np.append(held[start] - 1, held[-1]).astype(np.int64)
    letters = _FOLD[data[inside]]
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    text = np.searchsorted(offs, start, side="right") - 1
    piece = np.cumsum(_BREAK[data])[start]
    ends = np.append((piece[1:] != piece[:-1]) | (text[1:] != text[:-1]), True)
    last = np.flatnonzero(ends)
    return words, last[np.searchsorted(last, np.arange(len(start)))] - np.arange(len(start)) + 1, text


def _order(matrix: np.ndarray, size: int) -> np.ndarray:
    """Order of the rows of `matrix` (codes from -1 to size - 1), several columns to a sort key."""
    bits = max(1, int(size).bit_length())
    each = max(1, 62 // bits)
    keys = []
    for a in range(0, matrix.shape[1], each):
        key = np.zeros(len(matrix), np.int64)
        for j in range(a, min(a + each, matrix.shape[1])):
            key = (key << bits) | (matrix[:, j] + 1)
        keys.append(key)
    return np.lexsort(keys[::-1])


def _folded(matrix: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sum of their counts."""
    if not len(matrix):
        return matrix, counts
    order = _order(matrix, size)
    matrix = matrix[order]
    new = np.flatnonzero(np.concatenate(([True], (matrix[1:] != matrix[:-1]).any(axis=1))))
    return matrix[new], np.add.reduceat(counts[order], new)


class _Vocabulary:
    """Distinct words of a stretch of text: their bytes, and a number of each that chooses routes."""

    def __init__(self, words: pa.Array):
        self.size = len(words)
        self.bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        self.data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
        self.spread = np.fromiter((zlib.crc32(w) for w in words.to_pylist()), np.uint64, len(words)) + np.uint64(1)

    def take(self, codes: np.ndarray) -> bytes:
        """Number, lengths and bytes of the words with these codes."""
        begin, sizes = self.bounds[codes], np.diff(self.bounds)[codes]
        ends = np.cumsum(sizes)
        source = np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return np.uint32(len(codes)).tobytes() + sizes.astype("<u4").tobytes() + self.data[source].tobytes()


def _blocks(lang, low: int, high: int, lead: int, routes: int, words: _Vocabulary, matrix, counts) -> Iterator[dict]:
    """Blocks of folded rows, one per route, dealt by the first `lead` words.

    A block has words of its own, the commonest first, and codes from 1 (0: no word) as planes of their low and high bytes.
    """
    if not len(matrix):
        return
    route = np.zeros(len(matrix), np.uint64)
    for j, factor in zip(range(lead), odd_numbers(lead, 23)):
        route = mix(route + np.where(matrix[:, j] >= 0, words.spread[matrix[:, j]], 0).astype(np.uint64) * factor)
    route = (route % np.uint64(routes)).astype(np.int64)
    order = np.argsort(route, kind="stable")
    route, matrix, counts = route[order], matrix[order], counts[order]
    cuts = np.append(np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1]))), len(route))
    press = zstandard.ZstdCompressor(level=3)
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        used, codes, often = np.unique(matrix[a:z], return_inverse=True, return_counts=True)
        shift = int(used[0] == -1)
        by_use = np.argsort(-often[shift:], kind="stable")
        code = np.zeros(len(used), np.uint32)
        code[shift:][by_use] = np.arange(1, len(by_use) + 1)
        planes = np.ascontiguousarray(code[codes].reshape(z - a, -1).T).astype("<u4").view(np.uint8).reshape(-1, 4).T
        held = planes if len(used) >= 1 << 16 else planes[:2]
        yield {
            "lang": lang, "low": low, "high": high, "route": int(route[a]), "n": z - a,
            "words": press.compress(words.take(used[shift:][by_use])),
            "codes": press.compress(held.tobytes()), "counts": press.compress(counts[a:z].astype("<i8").tobytes()),
        }


_BLOCK_FIELDS = pa.schema([
    ("lang", pa.string()), ("low", pa.int32()), ("high", pa.int32()), ("route", pa.int64()), ("n", pa.int64()),
    ("words", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary()),
])


def _read(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lengths and bytes of the words, matrix of codes from 0, -1 for no word, counts) of a block."""
    n, raw = row["n"], zstandard.decompress(row["words"])
    size = int(np.frombuffer(raw, "<u4", 1)[0])
    lengths = np.frombuffer(raw, "<u4", size, 4).astype(np.int64)
    planes = np.frombuffer(zstandard.decompress(row["codes"]), np.uint8).reshape(-1, n * width)
    codes = np.zeros(n * width, np.int32)
    for i, plane in enumerate(planes):
        codes |= plane.astype(np.int32) << (8 * i)
    counts = np.frombuffer(zstandard.decompress(row["counts"]), "<i8")
    return lengths, np.frombuffer(raw, np.uint8, -1, 4 + 4 * size), codes.reshape(width, n).T - 1, counts


def _words(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


def _chunks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array]]:
    """(words, words from each to the end of its piece up to `longest`, language of each) of bounded stretches of text."""
    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch, "text", CUT_BYTES):
            words, left, text = _cut(piece.column("text"))
            held.append((words, np.minimum(left, longest).astype(np.int8), piece.column("lang").take(pa.array(text))))
            size += piece.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield _chunk(held)
                held, size = [], 0
    if held:
        yield _chunk(held)


def _chunk(held: list[tuple]) -> tuple[pa.Array, np.ndarray, pa.Array]:
    words, left, langs = zip(*held)
    return pa.concat_arrays(words).dictionary_encode(), np.concatenate(left), pa.concat_arrays(langs).dictionary_encode()


def _suffixes(longest: int, routes: int):
    """Blocks of single words and of suffixes of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for coded, left, langs in _chunks(batches, longest):
            code, known = coded.indices.to_numpy(), _Vocabulary(coded.dictionary)
            of_word = langs.indices.to_numpy()
            for number, lang in enumerate(langs.dictionary.to_pylist()):
                at = np.flatnonzero(of_word == number)
                if not len(at):
                    continue
                single, often = np.unique(code[at], return_counts=True)
                blocks = list(_blocks(lang, 1, 1, 1, routes, known, single.astype(np.int32)[:, None], often.astype(np.int64)))
                at = at[left[at] > 1]
                matrix = np.full((len(at), longest), -1, np.int32)
                for j in range(longest):
                    has = left[at] > j
                    matrix[has, j] = code[at[has] + j]
                matrix, counts = _folded(matrix, np.ones(len(at), np.int64), known.size)
                blocks += _blocks(lang, 2, longest, 2, routes, known, matrix, counts)
                for a in range(0, len(blocks), 50):
                    yield pa.RecordBatch.from_pylist(blocks[a : a + 50], _BLOCK_FIELDS)

    return run


def _deal_again(row: dict, routes: int) -> list[dict]:
    """A block of a hot route, dealt by one word more; phrases as long as the old lead go into blocks of their own."""
    lead, high = row["low"], row["high"]
    lengths, data, matrix, counts = _read(row, high)
    known = _Vocabulary(_words(lengths, data))
    short, often = _folded(matrix[:, :lead], counts, known.size)
    blocks = list(_blocks(row["lang"], lead, lead, lead, routes, known, short, often))
    more = matrix[:, lead] >= 0
    return [*blocks, *_blocks(row["lang"], lead + 1, high, lead + 1, routes, known, matrix[more], counts[more])]


def frequent_prefixes(matrix: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, a row that begins with the phrase, weight) of all prefixes of rows that weigh `least` or more.

    Three-way quicksort on pointers to rows, all partitions of a round at once: a partition is a run of `rows`, its pivot the median
    of three of its words. What weighs less than `least` is abandoned with its pointers; a row ends at a code below 0.
    """
    flat, width = np.ascontiguousarray(matrix).ravel(), matrix.shape[1]
    rows = np.arange(len(matrix), dtype=np.int32)
    part = np.zeros(len(rows), np.int32)
    depth = np.zeros(1, np.int64)
    while len(rows):
        begin = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        part = np.cumsum(np.concatenate(([0], part[1:] != part[:-1])), dtype=np.int32)
        size = np.diff(np.append(begin, len(rows)))
        word = flat[rows.astype(np.int64) * width + depth[part]]
        three = np.sort(np.stack([word[begin], word[begin + size // 2], word[begin + size - 1]]), axis=0)
        pivot = three[1][part]
        side = part * 3 + (word >= pivot) + (word > pivot)
        weight = np.bincount(side, weights=weights[rows], minlength=3 * len(begin))
        heavy = weight >= least
        equal = np.arange(3 * len(begin)) % 3 == 1
        heavy &= ~(equal & (np.repeat(three[1], 3) < 0))
        deep = np.repeat(depth, 3) + equal
        met = heavy & equal
        keep = heavy[side]
        rows, side = rows[keep], side[keep]
        order = np.argsort(side, kind="stable")
        rows, side = rows[order], side[order]
        if met.any():
            found = np.flatnonzero(met)
            yield deep[found], rows[np.searchsorted(side, found)], weight[found].astype(np.int64)
        on = deep[side] < width
        rows, part, depth = rows[on], side[on].astype(np.int32), deep
        if len(rows):
            kinds, part = np.unique(part, return_inverse=True)
            depth = depth[kinds]


COUNTED = f"phrase binary, f long, {BLOCK}"
_COUNTED_FIELDS = pa.schema([("phrase", pa.binary()), ("f", pa.int64()), *_BLOCK_FIELDS])


def _count(least: int, routes: int, most: int):
    """Phrases of one route: its blocks are brought to one dictionary, then sorted. A hot route's blocks are dealt again instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, hot = [], 0, False
        for batch in batches:
            for row in batch.to_pylist():
                rows += row["n"]
                held.append(row)
                # with as many words in the lead as in the suffix there is nothing left to deal by, and equal rows are folded
                hot = hot or (rows > most and 1 < row["low"] < row["high"])
                if hot:
                    for old in held:
                        again = _deal_again(old, routes)
                        yield pa.RecordBatch.from_pylist([{"phrase": None, "f": None, **b} for b in again], _COUNTED_FIELDS)
                    held = []
        if held:
            found = _phrases(held, least)
            if found:
                yield pa.RecordBatch.from_pylist(found, _COUNTED_FIELDS)

    return run


def _phrases(blocks: list[dict], least: int) -> list[dict]:
    low, high, lang = blocks[0]["low"], blocks[0]["high"], blocks[0]["lang"]
    sets = [_read(b, high) for b in blocks]
    coded = _words(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets])).dictionary_encode()
    code, known, parts, at = coded.indices.to_numpy().astype(np.int32), coded.dictionary, [], 0
    for lengths, _, matrix, _ in sets:
        own = np.append(code[at : at + len(lengths)], np.int32(-1))
        parts.append(own[matrix])
        at += len(lengths)
    matrix, weights = np.concatenate(parts), np.concatenate([s[3] for s in sets])
    found = []
    for depths, rows, sums in frequent_prefixes(matrix, weights, least):
        for d, r, f in zip(depths.tolist(), rows.tolist(), sums.tolist()):
            if d >= low:
                text = b" ".join(known[c].as_py() for c in matrix[r, :d].tolist())
                found.append({"phrase": text, "f": f, "lang": lang, "low": d})
    return found


def frequent_phrases(
    docs: DataFrame, text_col: str = "text", lang: Column | None = None, longest: int = 5, least: int = 100
) -> DataFrame:
    """`lang`, `phrase` (words joined by a blank), `words`, `f` of all phrases of 1 to `longest` words that occur `least` times or more.

    A-Z are lower-cased; texts are cut into pieces at `.,;:!?` and U+000A to U+000D, pieces into words at blanks and tabs. A phrase
    occurs wherever its words follow one another in a piece, overlaps included. Counts are per language; a null language is `und`.
    Null and empty texts hold no words, repeated rows count each time, other columns are not read, an empty table has no phrases.
    """
    lang = F.coalesce(lang if lang is not None else F.col("lang"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    extent = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = int(max(16, -(-extent // ROUTE_BYTES)))
    blocks, found = texts.mapInArrow(_suffixes(longest, routes), BLOCK), []
    while True:
        by_route = blocks.groupBy("lang", "low", "high", "route")
        counted = materialize(by_route.applyInArrow(_count(least, routes, ROUTE_ROWS), COUNTED), "phrases")
        found.append(counted.where("phrase is not null").select("lang", F.col("phrase").cast("string"), F.col("low").alias("words"), "f"))
        blocks = counted.where("phrase is null").drop("phrase", "f")
        if blocks.isEmpty():  # each round has one word more in the lead, so there are fewer rounds than words
            return reduce(DataFrame.unionAll, found)


def collocations(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Scored phrases of two words or more: `lang`, `phrase`, `words`, `a`, `l`, `r`, `n`, `score`.

    `phrases` is what `frequent_phrases` gives, `totals` has `lang` and `n`, all words of it. A phrase cut after k words has the score
    floor(1000 * a * n / (l * r)), a, l and r being the counts of the phrase and of its parts; of its cuts the one with the
    lowest score counts, the earliest of these. Phrases inside a longer one with the same count are left out.
    """
    words = F.split("phrase", " ")
    many = phrases.where("words > 1").withColumn("w", words)
    joined = lambda a: F.array_join(a, " ")
    cuts = many.select("lang", "phrase", "words", F.col("f").alias("a"), "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "words", "a", "k",
        joined(F.slice("w", F.lit(1), F.col("k"))).alias("left"),
        joined(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k"))).alias("right"),
    )
    # phrases grow with the corpus: merge joins at every size, whatever their estimates say
    side = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count)).hint("merge")
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(totals, "lang")
    # counts of up to 10^18 as decimals: the products stay exact beyond 64 bits
    exact = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    above = (exact["a"] * exact["n"] * F.lit(1000).cast("decimal(4,0)")).alias("above")
    cuts = cuts.select("*", above, (exact["l"] * exact["r"]).alias("below")).withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # a phrase with a longer one around it has one that is longer by one word, and that is at least as frequent as the longest
    wider = many.where("words > 2").select(
        "lang",
        F.explode(F.array(joined(F.slice("w", F.lit(1), F.col("words") - 1)), joined(F.slice("w", F.lit(2), F.col("words") - 1)))).alias("phrase"),
        "f",
    )
    wider = wider.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = best.join(wider.hint("merge"), ["lang", "phrase"], "left").where("around is null or around < a")
    return kept.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def strongest(scored: DataFrame, n: int, parts: int = 32) -> DataFrame:
    """The first `n` phrases of each language by score, count and bytes of the phrase, with their `rank` from 1.

    Each language is ranked in parts first, so the task that ranks it as a whole reads `parts` times `n` rows at most.
    """
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    for keys in (["lang", part], ["lang"]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)
    return scored


def word_totals(docs: DataFrame, text_col: str = "text", lang: Column | None = None) -> DataFrame:
    """`lang` and `n`, all words of its texts; a null language is `und`."""
    lang = F.coalesce(lang if lang is not None else F.col("lang"), F.lit("und"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", CHUNK_BYTES):
                text = _cut(piece.column("text"))[2]
                sizes = np.bincount(text, minlength=piece.num_rows)
                yield pa.RecordBatch.from_arrays([piece.column("lang"), pa.array(sizes, pa.int64())], ["lang", "n"])

    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    return texts.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
