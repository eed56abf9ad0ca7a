"""Near-duplicate documents by MinHash: universal hash minima, banding, signature check, exact check, star components.

One row per document comes out; pairs are never expanded. Equal shingle sets are folded into one representative before
anything else, so copies cost one count each. Representatives that share a band are gathered into candidate clusters by
large-star/small-star; each cluster is then checked in blocks of bounded size: signatures first, full shingle sets after,
and a block hands on only a spanning forest of the links it confirmed. Star components of these give the result.

The candidate step is probabilistic: `bands_for` keeps the chance to miss a pair exactly at the threshold below 1e-4, less for
closer pairs. Whatever is linked was confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.arrays import Words, gram_hashes, mix, odd_numbers, pieces, string_buffers
from flowsift.llm.components import star_components
from flowsift.session import materialize

#: Number of hash minima a signature may have.
MINIMA = 192
#: A block of a candidate cluster holds about so many documents and shingles; two blocks meet in one task.
BLOCK_DOCS = 1024
BLOCK_SHINGLES = 2_000_000


def bands_for(threshold: float, minima: int = MINIMA, miss: float = 1e-4) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold with at most the given chance."""
    for rows in range(minima, 0, -1):
        bands = minima // rows
        if (1 - threshold**rows) ** bands <= miss:
            return bands, rows
    raise ValueError(f"no banding of {minima} minima reaches {threshold}")


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; a text of fewer than `k` words is one shingle."""
    grams = gram_hashes(hashes, k)
    sets = []
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if z - a >= k:
            sets.append(np.unique(grams[a : z - k + 1]))
        elif z > a:
            sets.append(gram_hashes(hashes[a:z], z - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], minima: int, seed: int) -> np.ndarray:
    """(texts, minima) 32-bit minima of multiply-add-shift hashes; all sets must have members."""
    out = np.empty((len(sets), minima), np.uint32)
    factors, shifts = odd_numbers(minima, seed), mix(odd_numbers(minima, seed + 1))
    begin = 0
    while begin < len(sets):
        end, total = begin, 0
        while end < len(sets) and (end == begin or total + len(sets[end]) <= 1 << 14):
            total += len(sets[end])
            end += 1
        keys = np.concatenate(sets[begin:end]) >> np.uint64(32)
        starts = np.cumsum([0] + [len(s) for s in sets[begin : end - 1]])
        room = np.empty_like(keys)
        for j in range(minima):
            np.multiply(keys, factors[j], out=room)
            np.add(room, shifts[j], out=room)
            out[begin:end, j] = np.minimum.reduceat(room, starts) >> np.uint64(32)
        begin = end
    return out


def _sets_of(piece: pa.RecordBatch, k: int) -> list[np.ndarray]:
    words = Words(*string_buffers(piece.column("text")), fold_case=True)
    return shingle_sets(words.hash, words.of_text, k)


def _describe(k: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = odd_numbers(rows, seed + 2)
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = _sets_of(piece, k)
                sizes = np.array([len(s) for s in sets], np.int64)
                keys: list[bytes | None] = [
                    None if not len(s) else np.array([len(s), mix(s).sum(), mix(s ^ np.uint64(seed)).sum()], np.uint64).tobytes()
                    for s in sets
                ]
                slots: list[np.ndarray | None] = [None] * len(sets)
                full = np.flatnonzero(sizes)
                if len(full):
                    signs = signatures([sets[i] for i in full], bands * rows, seed).astype(np.uint64)
                    parts = (signs.reshape(len(full), bands, rows) * factors).sum(axis=2)
                    parts = mix(parts + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                    for i, row in zip(full.tolist(), parts):
                        slots[i] = row
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(slots, pa.list_(pa.int64()))],
                    names=["id", "n_shingles", "set_key", "slots"],
                )

    return run


def _full_sets(k: int, minima: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = _sets_of(piece, k)
                full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
                if not len(full):
                    continue
                signs = signatures([sets[i] for i in full], minima, seed)
                kept = piece.take(pa.array(full))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column("id"),
                        kept.column("cluster"),
                        kept.column("n_blocks"),
                        pa.array([s.tobytes() for s in signs], pa.binary()),
                        pa.array([sets[i].tobytes() for i in full], pa.binary()),
                    ],
                    names=["id", "cluster", "n_blocks", "signature", "shingles"],
                )

    return run


def confirmed_links(ids: np.ndarray, signs: np.ndarray, sets: list[np.ndarray], percent: int, slack: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with 100 * |a & b| >= percent * |a | b|.

    Pairs whose signatures agree in too few minima are passed over; the others are counted exactly: shingles of more than
    one document are numbered and a product of 0/1 matrices, in bounded pieces, gives all intersections.
    """
    n, minima = signs.shape
    order = np.argsort(ids, kind="stable")
    ids, signs, sets = ids[order], signs[order], [sets[i] for i in order]
    least = percent / 100 - slack * np.sqrt(0.25 / minima)
    alike = np.zeros((n, n), dtype=bool)
    for a in range(0, n, 64):
        same = np.zeros((min(64, n - a), n), np.uint16)
        for j in range(minima):
            same += signs[a : a + 64, j, None] == signs[None, :, j]
        alike[a : a + 64] = same >= least * minima
    np.fill_diagonal(alike, False)
    live = np.flatnonzero(alike.any(axis=1))
    if not len(live):
        return []
    alike = alike[np.ix_(live, live)]
    sizes = np.array([len(sets[i]) for i in live], np.int64)
    whole = np.concatenate([sets[i] for i in live])
    owner = np.repeat(np.arange(len(live)), sizes)
    _, code, times = np.unique(whole, return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[code]
    owner, code = owner[keep], place[code[keep]]
    both = np.zeros((len(live), len(live)), np.float32)
    width = max(1, (8 << 20) // len(live))
    for low in range(0, int(shared.sum()), width):
        here = (code >= low) & (code < low + width)
        table = np.zeros((len(live), width), np.float32)
        table[owner[here], code[here] - low] = 1
        both += table @ table.T
    common = both.astype(np.int64)
    linked = alike & (100 * common >= percent * (sizes[:, None] + sizes[None, :] - common))
    forest, seen = [], np.zeros(len(live), dtype=bool)
    for root in range(len(live)):
        if seen[root]:
            continue
        seen[root] = True
        stack = [root]
        while stack:
            at = stack.pop()
            new = np.flatnonzero(linked[at] & ~seen)
            seen[new] = True
            stack.extend(new.tolist())
            forest.extend((int(ids[live[at]]), int(ids[live[x]])) for x in new)
    return forest


def _check_blocks(percent: int, slack: float):
    def one(rows: pa.Table) -> pa.RecordBatch:
        signs = np.stack([np.frombuffer(x, np.uint32) for x in rows.column("signature").to_pylist()])
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        found = confirmed_links(rows.column("id").to_numpy(), signs, sets, percent, slack)
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cluster", "left", "right")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, z in zip(edges[:-1], edges[1:]):
                if a == z:
                    continue
                key = tuple(keys[a].tolist())
                if key != last and held:
                    yield one(pa.Table.from_batches(held))
                    held = []
                last = key
                held.append(batch.slice(a, z - a))
        if held:
            yield one(pa.Table.from_batches(held))

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 3,
    percent: int = 85,
    minima: int = MINIMA,
    seed: int = 20,
    slack: float = 5.0,
) -> DataFrame:
    """Component of every document: columns `id_col`, `n_shingles`, `component_id`, `kept`.

    Words are lower-cased in A-Z; a document's set are its distinct shingles of `k` words (all words, if fewer). Documents
    are linked when 100 * |intersection| >= `percent` * |union|.

    * A null, empty or blank text has no shingles, is linked with nothing and kept.
    * A row without an id that repeats the set of a row with one is not kept; any other row without an id stays, with a
      null component.
    * Repeated rows come back once each. Rows that share an id are one document to the others: what is linked with any of its
      texts is in its component, and the rows are kept or not together.
    * Other columns are not read. An empty table gives an empty result.

    `slack`: a pair is confirmed exactly unless its signatures fall so many standard deviations below the threshold.
    """
    bands, rows = bands_for(percent / 100, minima)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = materialize(
        source.mapInArrow(_describe(k, bands, rows, seed), "id long, n_shingles long, set_key binary, slots array<long>"), "sets"
    )
    first = described.where("set_key is not null and id is not null").groupBy("set_key").agg(F.min("id").alias("rep"))
    first = materialize(first, "classes")
    slots = materialize(
        described.join(first, [described.set_key == first.set_key, described.id == first.rep], "left_semi").select(
            "id", F.explode("slots").alias("slot")
        ),
        "slots",
    )
    hubs = slots.groupBy("slot").agg(F.min("id").alias("hub"), F.max("id").alias("top")).where("hub < top")
    together = slots.join(hubs.select("slot", "hub"), "slot").where("id <> hub").select("id", "hub").distinct()
    clusters = star_components(together, "id", "hub")
    links = _links(source, described, first, clusters, k, percent, bands * rows, seed, slack)
    parts = star_components(links, "a", "b")
    named = (
        described.select("id", "n_shingles", "set_key")
        .join(first, "set_key", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component_id", F.coalesce("component", "rep", "id"))
    )
    return named.select(
        F.col("id").alias(id_col),
        "n_shingles",
        "component_id",
        (F.col("component_id").isNull() | F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def _links(source, described, first, clusters, k, percent, minima, seed, slack) -> DataFrame:
    """Confirmed links inside the candidate clusters, as a spanning forest per block pair."""
    sized = described.join(first, [described.set_key == first.set_key, described.id == first.rep], "left_semi").select("id", "n_shingles")
    members = materialize(
        clusters.withColumnRenamed("node", "id").join(sized.groupBy("id").agg(F.max("n_shingles").alias("n_shingles")), "id"), "members"
    )
    extent = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("n_blocks")
    )
    wanted = members.join(extent, "component").select("id", F.col("component").alias("cluster"), "n_blocks")
    # one plan at every size: a broadcast that ends at some number of candidates would change what is shuffled
    texts = source.where("id is not null and text is not null").join(wanted.hint("merge"), "id")
    sets = texts.select("id", "cluster", "n_blocks", "text").mapInArrow(
        _full_sets(k, minima, seed), "id long, cluster long, n_blocks int, signature binary, shingles binary"
    )
    block = F.expr("cast(pmod(xxhash64(id, 5), n_blocks) as int)")
    paired = (
        sets.withColumn("block", block)
        .withColumn("other", F.explode(F.expr("sequence(0, n_blocks - 1)")))
        .select(
            "id", "cluster", "signature", "shingles", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
        )
    )
    dealt = paired.repartition("cluster", "left", "right").sortWithinPartitions("cluster", "left", "right")
    return dealt.select("id", "cluster", "left", "right", "signature", "shingles").mapInArrow(_check_blocks(percent, slack), "a long, b long")
