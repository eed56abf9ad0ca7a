"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are dealt by length into buckets. A first round against a few buckets gives every query a lower bound of its k-th score;
from it, the query's length and a bucket's largest length follows the cosine a vector of that bucket must reach. A bucket whose
threshold passes 1 is left out, one with a high threshold is searched by coordinates (a vector can reach the cosine only if
its components on the query's largest coordinates lie in known ranges), any other by the length each vector must have. What
remains is verified by its integer product.

Queries and buckets meet in blocks of bounded size, spread by a salt over the tasks; no block is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.session import materialize

BUCKET, QUERY_BLOCK = 2048, 2048
#: Buckets that give the first bounds: the longest vectors and an even choice of the others.
SEEDS = 4
#: Above this cosine a bucket is searched by the ranges of `FOCUS` coordinates, below by length.
BY_COORDINATES, FOCUS = 0.85, 4
_SLACK = 1e-9


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """`id`, `v` = floor(scale * component), `norm`; rows that are null, empty or not finite throughout, or without id, are left out."""
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(wide, lambda x: F.floor(x * F.lit(scale)))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(usable & (F.size(vector_col) > 0))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return rows.select(F.col(id_col).cast("long").alias("id"), whole.alias("v")).withColumn("norm", norm)


def _blocks(rows: DataFrame, size: int, ordered: bool) -> DataFrame:
    """Rows of `dim` components gathered into matrices of at most `size` rows: block, dim, ids, values."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, values = held.pop(dim)
            ids, values = np.concatenate(ids), np.concatenate(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([values.tobytes()], pa.binary())],
                names=["dim", "ids", "values"],
            )

        for batch in batches:
            v = batch.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            ids = batch.column("id").to_numpy()
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                flat = v.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
                for a in range(0, len(at), 256):
                    part = held.setdefault(dim, ([], []))
                    part[0].append(ids[at[a : a + 256]].astype(np.int64))
                    part[1].append(flat[a : a + 256].astype(np.int64))
                    if sum(map(len, part[0])) + 256 > size:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    dealt = rows.sortWithinPartitions(F.desc("norm"), "id") if ordered else rows
    return dealt.select("id", "v").mapInArrow(gather, "dim int, ids array<long>, values binary")


def _matrix(ids: list[int], values: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array(ids, np.int64), np.frombuffer(values, np.int64).reshape(-1, dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products a @ b.T; sums outside 64 bits are moved to the nearest end."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 2**62:
        return a @ b.T
    full = a.astype(object) @ b.astype(object).T
    return np.clip(full, -(2**63), 2**63 - 1).astype(np.int64)


def best_of(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best (score, then smaller id) of each row number."""
    order = np.lexsort((ids, -scores, rows))
    sorted_rows = rows[order]
    first = np.searchsorted(sorted_rows, sorted_rows, side="left")
    return order[np.arange(len(order)) - first < k]


def search_bucket(q_ids, q, bound, ids, vectors, k: int):
    """(query numbers, scores, ids) of the vectors of one bucket that reach the queries' bounds, the k best of each.

    `bound` is each query's score to reach (-inf: none known). The way through the bucket is chosen query by query.
    """
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    q_len = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(q_len > 0, bound / q_len, np.where(bound > 0, np.inf, -np.inf))
        cosine = np.where(need > 0, need / lengths[0] if lengths[0] > 0 else np.inf, -1.0)
    live = np.flatnonzero(cosine <= 1 + _SLACK)
    found: list[tuple] = []
    steep = live[cosine[live] >= BY_COORDINATES]
    if len(steep):
        unit = vectors / np.maximum(lengths, 1e-300)[:, None]
        columns = np.ascontiguousarray(unit.T)
        for i in steep.tolist():
            t = min(1.0, cosine[i]) - _SLACK
            direction = q[i] / q_len[i]
            keep = lengths >= need[i] * (1 - _SLACK)
            for f in np.argsort(-np.abs(direction))[:FOCUS]:
                reach = np.sqrt(max(0.0, (1 - t * t) * (1 - direction[f] ** 2))) + _SLACK
                middle = t * direction[f]
                # a vector beyond the threshold may point at the coordinate itself
                high = middle + reach if direction[f] < t else 1.0
                low = middle - reach if -direction[f] < t else -1.0
                keep &= (columns[f] >= low - _SLACK) & (columns[f] <= high + _SLACK)
            at = np.flatnonzero(keep)
            if len(at):
                found.append((np.full(len(at), i), _products(q[i : i + 1], vectors[at])[0], ids[at]))
    flat = live[cosine[live] < BY_COORDINATES]
    reach = np.searchsorted(-lengths, -need[flat] * (1 - _SLACK), side="right") if len(flat) else flat
    flat, reach = flat[np.argsort(reach, kind="stable")], np.sort(reach)
    for a in range(0, len(flat), 128):
        part, deep = flat[a : a + 128], int(reach[a : a + 128].max(initial=0))
        scores = _products(q[part], vectors[:deep])
        row, col = np.nonzero(scores >= bound[part][:, None])
        found.append((part[row], scores[row, col], ids[col]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, scores, got = (np.concatenate(x) for x in zip(*found))
    good = (scores >= bound[rows]) & (got != q_ids[rows])
    rows, scores, got = rows[good], scores[good], got[good]
    best = best_of(rows, scores, got, k)
    return rows[best], scores[best], got[best]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, q = _matrix(r["q_ids"], r["q_values"], r["dim"])
                ids, v = _matrix(r["ids"], r["values"], r["dim"])
                bound = np.frombuffer(r["bounds"], np.float64) if r["bounds"] else np.full(len(q_ids), -np.inf)
                rows, scores, got = search_bucket(q_ids, q, bound, ids, v, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[rows]), pa.array(got), pa.array(scores)], names=["query_id", "id", "score"]
                )

    return run


def _add_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        bounds = []
        for r in rows:
            known = {x["query_id"]: x["score"] for x in r["known"] or []}
            bounds.append(np.array([known.get(i, -np.inf) for i in r["q_ids"]]).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("block", "dim", "q_ids", "q_values")] + [pa.array(bounds, pa.binary())],
            names=["block", "dim", "q_ids", "q_values", "bounds"],
        )


def _meet(queries: DataFrame, buckets: DataFrame, n_buckets: int, k: int) -> DataFrame:
    """Every query block with every bucket of its dimension, spread by a salt over the tasks."""
    parts = max(1, min(n_buckets, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    left = queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = buckets.withColumn("salt", F.pmod(F.xxhash64("bucket"), F.lit(parts)).cast("int"))
    both = left.join(right.hint("merge"), ["dim", "salt"])
    return both.select("dim", "q_ids", "q_values", "bounds", "ids", "values").mapInArrow(_search(k), "query_id long, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """The `k` largest integer inner products of every query: `query_id`, `rank`, `vec_id`, `score`; ties to the smaller id.

    Queries are the rows where `is_query` holds for `vec_id`; candidates are all rows with another id and as many components. Rows
    whose vector is null or empty or holds a null or non-finite component, and rows without an id, take no part. A repeated row is
    a candidate once for each time it stands there; equal query rows are one query. Other columns are not read; an empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    rows = materialize(integer_vectors(vectors.withColumnRenamed(id_col, "vec_id"), "vec_id", vector_col, scale), "vectors")
    n = rows.count()
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET)))
    dealt = rows.repartitionByRange(parts, F.desc("norm"), "id")
    buckets = materialize(_blocks(dealt, BUCKET, True).withColumn("bucket", F.monotonically_increasing_id()), "buckets")
    asked = rows.withColumn("vec_id", F.col("id")).where(is_query).select("id", "v", "norm").distinct()
    asked = materialize(asked, "asked")
    blocks = _blocks(asked.repartition(max(1, -(-asked.count() // QUERY_BLOCK))), QUERY_BLOCK, False)
    blocks = blocks.withColumn("block", F.monotonically_increasing_id())
    queries = materialize(blocks.select("block", "dim", F.col("ids").alias("q_ids"), F.col("values").alias("q_values")), "queries")
    total = buckets.count()
    longest = [r["b"] for r in buckets.groupBy("dim").agg(F.min("bucket").alias("b")).limit(64).collect()]
    first = buckets.where(F.col("bucket").isin(longest) | (F.pmod(F.xxhash64("bucket"), F.lit(max(1, total))) < SEEDS - 1))
    plain = queries.withColumn("bounds", F.lit(None).cast("binary"))
    known = _ranked(_meet(plain, first, total, k), k).where(F.col("rank") == k).select("query_id", "score")
    told = materialize(_with_bounds(queries, known), "bounds")
    found = _ranked(_meet(told, buckets, total, k), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _with_bounds(queries: DataFrame, known: DataFrame) -> DataFrame:
    """Each query block with its queries' bounds, in the order of its rows; seeds only speed the search up, never change it."""
    ids = queries.select("block", F.explode("q_ids").alias("query_id"))
    listed = ids.join(known, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "score")).alias("known"))
    return queries.join(listed, "block", "left").mapInArrow(_add_bounds, "block long, dim int, q_ids array<long>, q_values binary, bounds binary")
