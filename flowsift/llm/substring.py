"""Repeated word windows by FM-indexes over content-routed shards.

A window of `window` words is routed by the smallest hash among its grams of `gram` words. Neighbouring windows with the same
smallest gram form a segment, and equal windows, wherever they stand, have equal smallest grams: so all places of a window meet in
one shard, each shard is bounded, and work grows with the input. Segments whose gram stands nowhere else end early. The others,
copies folded to one, are indexed shard by shard; every segment that stands alone is streamed against its shard's index by
backward search, which gives its matching statistics and the stretches that are repeated.

A gram with very many different segments (a common line amid changing text) would not fit a shard: its windows are counted one by
one instead, by a plain aggregate over their hashes.

Words are compared by 48-bit hashes inside a shard and rows are told apart by a 64-bit hash of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.arrays import Words, gram_hashes, pieces, short_batches, string_buffers
from flowsift.llm.fm_index import FMIndex, repeated_stretches
from flowsift.session import materialize

GRAM = 8
#: Windows in one segment; runs of the same gram are cut there.
LONGEST_RUN = 64
SHARD_WORDS = 500_000
#: Different segments of a gram from which on its windows are counted singly.
CROWD = 2000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each `width` neighbours."""
    low, size = x, 1
    while size * 2 <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def segments(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, windows, smallest gram, content hash) of every segment of a slice of texts."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    n = len(words.hash) - window + 1
    if n <= 0:
        return none
    least = _sliding_min(gram_hashes(words.hash, gram), window - gram + 1)
    owner = words.text_of_word()
    at = np.flatnonzero(owner[:n] == owner[window - 1 :])
    if not len(at):
        return none
    key, text = least[at], owner[at]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    runs = np.diff(np.append(first, len(at)))
    parts = -(-runs // LONGEST_RUN)
    of = np.repeat(np.arange(len(first)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    first, runs = first[of] + nth * LONGEST_RUN, np.minimum(runs[of] - nth * LONGEST_RUN, LONGEST_RUN)
    begin = at[first]
    total = _range_hash(words.hash, begin, begin + runs + window - 1)
    return text[first], begin - words.of_text[text[first]], runs, key[first], total


def _stands_twice(words: Words, text, begin, runs, key, window: int, gram: int) -> np.ndarray:
    """Whether a segment holds its gram at two places, so that windows of one segment may equal each other."""
    grams = gram_hashes(words.hash, gram)
    sizes = runs + window - gram
    ends = np.cumsum(sizes)
    at = np.repeat(begin + words.of_text[text] - (ends - sizes), sizes) + np.arange(ends[-1])
    return np.add.reduceat((grams[at] == np.repeat(key, sizes)).astype(np.int64), ends - sizes) > 1


def _range_hash(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words [begin, end): a polynomial in an odd base, from running sums and powers of its inverse."""
    base, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    powers = np.full(len(hashes), base, np.uint64)
    powers[:1] = 1
    back = np.full(len(hashes) + 1, inverse, np.uint64)
    back[:1] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * np.multiply.accumulate(powers))))
    value = (sums[end] - sums[begin]) * np.multiply.accumulate(back)[begin]
    value += (end - begin).astype(np.uint64)
    value ^= value >> np.uint64(29)
    return value * base


def _list_segments(window: int, gram: int, keys_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(*string_buffers(piece.column("text")))
                text, begin, runs, key, total = segments(words, window, gram)
                if not len(text):
                    continue
                gram_key = pa.array(key.view(np.int64))
                if keys_only:
                    again = _stands_twice(words, text, begin, runs, key, window, gram)
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays([gram_key, gram_key.filter(pa.array(again))])], names=["gram"])
                else:
                    row = piece.column("row").to_numpy()[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row), pa.array(begin * 128 + runs), gram_key, pa.array(total.view(np.int64))], names=["row", "place", "gram", "content"]
                    )

    return run


def _segment_words(window: int):
    """Words of the segments a row stands for, six bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(*string_buffers(piece.column("text")))
                six = np.ascontiguousarray(words.hash.view(np.uint8).reshape(-1, 8)[:, :6])
                rows: list[tuple] = []
                for i, wanted in enumerate(piece.column("wanted").to_pylist()):
                    for w in wanted or []:
                        begin = int(words.of_text[i]) + w["place"] // 128
                        rows.append((w["gram"], w["content"], w["times"], w["crowded"], six[begin : begin + w["place"] % 128 + window - 1].tobytes()))
                if rows:
                    g, c, t, m, b = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g, pa.int64()), pa.array(c, pa.int64()), pa.array(t, pa.int64()), pa.array(m, pa.bool_()), pa.array(b, pa.binary())],
                        names=["gram", "content", "times", "crowded", "words"],
                    )

    return run


def _unpack(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    six = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    return wide.view(np.uint64).ravel(), np.array([len(p) // 6 for p in packed], np.int64)


def _search_shards(window: int):
    def one(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        words, sizes = _unpack(rows.column("words").to_pylist())
        times = rows.column("times").to_numpy()
        found: list[list] = [[(0, int(n))] if t > 1 else [] for n, t in zip(sizes, times)]
        asked = np.flatnonzero(times == 1)
        if len(asked):
            which, begin, end = repeated_stretches(FMIndex(words, sizes), asked, sizes, window)
            for i, a, z in zip(asked[which].tolist(), begin.tolist(), end.tolist()):
                found[i].append((a, z))
        hit = np.array([i for i, f in enumerate(found) if f], np.int64)
        if len(hit):
            kept = rows.take(pa.array(hit))
            stretches = [[{"a": a, "z": z} for a, z in found[i]] for i in hit]
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column("gram").combine_chunks(),
                    kept.column("content").combine_chunks(),
                    pa.array(stretches, pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())]))),
                ],
                names=["gram", "content", "stretches"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, z in zip(edges[:-1], edges[1:]):
                if a == z:
                    continue
                if shard[a] != last and held:
                    yield from one(pa.Table.from_batches(held))
                    held = []
                last = shard[a]
                held.append(batch.slice(a, z - a))
        if held:
            yield from one(pa.Table.from_batches(held))

    return run


def _single_windows(window: int):
    """Every window of a crowded gram's segments with its own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes = _unpack(batch.column("words").to_pylist())
            counts = np.maximum(sizes - window + 1, 0)
            of = np.repeat(np.arange(len(sizes)), counts)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            begin = (np.cumsum(sizes) - sizes)[of] + nth
            value = _range_hash(words, begin, begin + window)
            take = lambda c: batch.column(c).to_numpy()[of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(take("gram")), pa.array(take("content")), pa.array(take("times")), pa.array(nth), pa.array(value.view(np.int64))],
                names=["gram", "content", "times", "nth", "value"],
            )

    return run


def _digests(removed: bool):
    """Numbers of words and the digest of what stays of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "id", "n_words", "n_removed", "kept_sha256"] if not removed else ["row", "n_removed", "kept_sha256"]
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offs = string_buffers(piece.column("text"))
                raw = data.tobytes()
                cuts = piece.column("cuts").to_pylist() if removed else None
                sizes, gone, marks = [], [], []
                for i in range(piece.num_rows):
                    words = raw[offs[i] : offs[i + 1]].split()
                    sizes.append(len(words))
                    if removed:
                        stay = np.ones(len(words), dtype=bool)
                        for c in cuts[i] or []:
                            stay[c["a"] : c["z"]] = False
                        words = [words[j] for j in np.flatnonzero(stay).tolist()]
                    gone.append(sizes[-1] - len(words))
                    marks.append(hashlib.sha256(b" ".join(words)).hexdigest())
                columns = [piece.column("row")]
                columns += [] if removed else [piece.column("id"), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.int64()), pa.array(marks, pa.string())], names=names)

    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(texts that may be affected, with `row` and `text`; `row` and `cuts`: word ranges covered by repeated windows).

    `row` is a hash of id and text. Null, empty and short texts have no windows. A repeated row repeats all its windows.
    """
    source = _rows(docs, id_col, text_col)
    grams = source.select("text").mapInArrow(_list_segments(window, gram, True), "gram long")
    shared = materialize(grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams")
    listed = source.select("row", "text").mapInArrow(_list_segments(window, gram, False), "row long, place long, gram long, content long")
    places = materialize(listed.join(shared.hint("merge"), "gram"), "places")
    kinds = places.groupBy("gram", "content").agg(F.count("*").alias("times"), F.min(F.struct("row", "place")).alias("first"))
    kinds = materialize(kinds, "kinds")
    extent = kinds.groupBy("gram").agg(F.count("*").alias("n_kinds"))
    chosen = kinds.join(extent.hint("merge"), "gram").select(
        F.col("first.row").alias("row"),
        F.struct(F.col("first.place").alias("place"), "gram", "content", "times", (F.col("n_kinds") > CROWD).alias("crowded")).alias("w"),
    )
    # rows that stand for a segment, and rows that only have one: both may lose words
    marked = chosen.unionByName(places.select("row", F.lit(None).cast(chosen.schema["w"].dataType).alias("w")).distinct())
    wanted = marked.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    texts = source.select("row", "text").join(wanted.hint("merge"), "row")
    texts = materialize(texts, "texts")
    spelled = texts.where(F.size("wanted") > 0).mapInArrow(
        _segment_words(window), "gram long, content long, times long, crowded boolean, words binary"
    )
    total = kinds.agg(F.sum(F.pmod(F.col("first.place"), F.lit(128)) + window - 1)).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_WORDS))
    dealt = spelled.where("not crowded").withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)).cast("int"))
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard")
    hits = dealt.select("shard", "gram", "content", "times", "words").mapInArrow(
        _search_shards(window), "gram long, content long, stretches array<struct<a:int,z:int>>"
    )
    single = spelled.where("crowded").select("gram", "content", "times", "words")
    single = single.mapInArrow(_single_windows(window), "gram long, content long, times long, nth long, value long")
    often = single.groupBy("value").agg(F.sum("times").alias("n")).where("n > 1").select("value")
    counted = single.join(often, "value").groupBy("gram", "content").agg(
        F.collect_list(F.struct(F.col("nth").cast("int").alias("a"), (F.col("nth") + window).cast("int").alias("z"))).alias("stretches")
    )
    found = materialize(hits.unionByName(counted), "stretches")
    covered = places.join(found.hint("merge"), ["gram", "content"]).select(
        "row",
        F.transform(
            "stretches",
            lambda s: F.struct((F.shiftright("place", 7) + s["a"]).alias("a"), (F.shiftright("place", 7) + s["z"]).alias("z")),
        ).alias("part"),
    )
    return texts.select("row", "text"), covered.groupBy("row").agg(F.flatten(F.collect_set("part")).alias("cuts"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return short_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("id", "text"))


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = GRAM) -> DataFrame:
    """Per row: `id_col`, `n_words`, `n_removed`, `kept_sha256` of the words that stay, joined by blanks.

    Removed is every word covered by a window that starts anywhere else too. A null text has no words. Repeated rows lose all
    their windows; rows with a null id are texts like any other; other columns are not read; an empty table gives an empty result.
    """
    source = _rows(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    whole = source.mapInArrow(_digests(False), f"row long, id {kind}, n_words long, n_removed long, kept_sha256 string")
    texts, cuts = repeated_passages(docs, id_col, text_col, window, gram)
    left = texts.join(cuts.hint("merge"), "row").mapInArrow(_digests(True), "row long, n_removed long, kept_sha256 string")
    less = left.groupBy("row").agg(F.max("n_removed").alias("gone"), F.max("kept_sha256").alias("rest"))
    return whole.join(less.hint("merge"), "row", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("gone", "n_removed").alias("n_removed"), F.coalesce("rest", "kept_sha256").alias("kept_sha256")
    )
