"""Exact top-k against all products, for usual, tied, extreme and unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.llm import topk
from oracle import compare, connect


class _Query:
    def __init__(self, name):
        from flowsift.llm import queries

        self.run, self.sql = queries.QUERIES[name], queries.ORACLES[name]


@pytest.mark.parametrize("name", ["op4_exact_top_k", "op6_warc_transactions"])
def test_same_as_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), _Query(name), folder) is None


def _brute(rows, wanted, k):
    usable = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in usable if wanted(i)}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(b) == len(a))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_unusual_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1 + i % 7, 6).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(60)]  # ties, also of length
    rows += [(400, None), (420, []), (440, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (460, [float("nan")] * 6), (480, [float("inf")] + [0.0] * 5)]
    rows += [(500, [0.0] * 6), (520, [1.0, 2.0]), (521, [3.0, -1.0]), (None, [1.0] * 6), (7, rows[7][1]), (540, [-1e6] * 6), (560, [1e-9] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, id int")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == _brute(rows, lambda i: i % 20 == 0, 20)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pruning_never_loses_a_hit():
    rng = np.random.default_rng(1)
    for spread in (0.05, 0.5, 3.0):
        middle = rng.normal(0, 40, 16)
        vectors = np.floor(middle + rng.normal(0, 40 * spread, (400, 16))).astype(np.int64)
        queries = np.floor(middle + rng.normal(0, 40 * spread, (30, 16))).astype(np.int64)
        scores = queries @ vectors.T
        bound = np.sort(scores, axis=1)[:, -10].astype(float)
        rows, found, ids = topk.search_bucket(np.arange(1000, 1030), queries, bound, np.arange(400), vectors, 10)
        expected = {(q, i) for q in range(30) for i in np.lexsort((np.arange(400), -scores[q]))[:10].tolist()}
        assert set(zip(rows.tolist(), ids.tolist())) == expected
        assert all(scores[q, i] == s for q, i, s in zip(rows, ids, found))
