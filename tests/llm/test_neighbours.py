"""The neighbour search against brute force: exact distances, order, ties, and its recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neighbours


def plainly(rows, every, k):
    """{query: [(distance, id)]} over distinct rows, ties to the smaller id."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i % every == 0:
            d = np.sqrt(((x - np.array(v)) ** 2).sum(1))
            out[i] = sorted((float(d[n]), j) for n, (j, _) in enumerate(rows) if j != i)[:k]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.vec_id, r.rank)):
        out.setdefault(r.vec_id, []).append((r.distance, r.near_id))
        assert len(out[r.vec_id]) == r.rank
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3_000, 24))
    x[1_000:2_000] = x[5] + rng.normal(0, 0.01, (1_000, 24))  # a third nearly the same
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = results(neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), F.col("vec_id") % 20 == 0, 10)), plainly(rows, 20, 10)
    assert got.keys() == want.keys()
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert found == sorted(found)
        assert np.allclose([d for d, _ in found], [np.linalg.norm(x[q] - x[j]) for _, j in found], rtol=1e-14)


@pytest.mark.parametrize("k", [3, 10])
def test_copies_and_ties(spark, k):
    """Copies in their thousands are one vector to search; of equally near ones the smaller ids come first."""
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(1_500)] + [(i, [0.0, 1.0, float(i % 2)]) for i in range(1_500, 1_520)] + [(5_000, [0.0, 1.0, 2.0]), (5_000, [0.0, 1.0, 2.0])]
    df = spark.createDataFrame([*rows, rows[0]], "vec_id long, embedding array<double>").repartition(6)
    assert results(neighbours.search(df, F.col("vec_id") % 500 == 0, k)) == plainly(rows, 500, k)


def test_slots_are_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLOT_ROWS", 50)
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 6)))]
    got, want = results(neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, 5)), plainly(rows, 10, 5)
    assert sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (10, [1.0, 2.5]), (1, None), (2, []), (3, [0.0, 0.0]), (20, [nan, 1.0]), (30, [inf, 1.0]), (40, [None, 1.0]), (None, [1.0, 2.1]), (5, [1.0, 3.0]), (6, [1.0, 2.0, 3.0]), (50, [-0.0, 1.0, 1.0]), (7, [0.0, 1.0, 1.0]), (8, [1e300, -1e300]),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, rep string")
    got = results(neighbours.search(df, F.col("vec_id") % 10 == 0, 3))
    assert got[0][:2] == [(0.5, 10), (1.0, 5)] and got[10][:2] == [(0.5, 0), (0.5, 5)] and got[50][0] == (0.0, 7)
    assert not {20, 30, 40} & got.keys() and all(j in (0, 10, 5, 8, 6, 7, 50) for found in got.values() for _, j in found)
    assert neighbours.search(df.limit(0), F.col("vec_id") % 10 == 0, 3).count() == 0
    assert neighbours.search(df.filter("vec_id = 0"), F.col("vec_id") % 10 == 0, 3).count() == 0
