"""Exact top-k with pruning against a plain product of matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import nearest


def by_hand(index, queries, k):
    out = set()
    for qid, q in queries:
        scores = []
        for i, v in index:
            if q and v and len(q) == len(v) and None not in v and None not in q:
                a, b = np.array(q, float), np.array(v, float)
                scores.append((round(float(a @ b / ((np.sqrt(a @ a) + 1e-9) * (np.sqrt(b @ b) + 1e-9))), 9), i))
        scores.sort(reverse=True)
        out |= {(qid, r + 1, i) for r, (_, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize(("k", "pivots"), [(5, 16), (3, 1)])
def test_same_as_brute_force(spark, monkeypatch, k, pivots):
    """Clusters, a third of equal vectors, zero vectors, other lengths, nulls; blocks far smaller than the cells."""
    monkeypatch.setattr(nearest, "SLICE", 16)
    monkeypatch.setattr(nearest, "CHUNK", 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 3
    index = [(i, (centres[i % 12] + rng.normal(size=8) * 0.05).round(3).tolist()) for i in range(240)]
    index += [(1000 + i, [1.0] * 8) for i in range(120)] + [(2000, [0.0] * 8), (2001, [0.0] * 8), (2002, None), (2003, []), (2004, [1.0, None] + [0.0] * 6), (2005, [1.0, 2.0]), (2006, [-1.0] * 8)]
    queries = [(i, v) for i, v in index if i % 7 == 0 or i >= 2000] + [(-1, [1.0] * 3), (-2, (-np.ones(8)).tolist())]
    a, b = spark.createDataFrame(index, "id long, embedding array<float>"), spark.createDataFrame(queries, "query_id long, q array<double>")
    held = [(r["id"], None if r["embedding"] is None else list(r["embedding"])) for r in a.collect()]
    found = nearest.search(a, b, k, pivots=pivots).collect()
    assert {(r["query_id"], r["rank"], r["id"]) for r in found} == by_hand(held, queries, k) and len(found) == len({(r["query_id"], r["rank"]) for r in found})


def test_most_is_left_out_where_vectors_cluster(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    index = spark.createDataFrame([(i, (centres[i % 30] + rng.normal(size=16) * 0.02).tolist()) for i in range(1500)], "id long, embedding array<double>")
    queries = index.filter("id % 10 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    share = nearest.compared(index, queries, 10).agg(F.avg("n")).first()[0] / 1500
    assert share < 0.15
    none = index.filter("false")
    assert nearest.search(none, queries, 3).count() == 0 and nearest.search(index, queries.filter("false"), 3).count() == 0
