"""Integer codebooks against all entries for all parts, and the grid's exactness."""

import hashlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from tidemark.llm import codebooks


def plainly(rows, rounds=4):
    """rows: (vec_id, label, vector) in order of vec_id, all finite, one length."""
    x = np.floor(np.array([v for _, _, v in rows], np.float64) * 1024).astype(np.int64)
    parts = np.split(x, 4, axis=1)
    books = [p[:256].copy() for p in parts]

    def nearest(p, book):
        d = ((p[:, None] - book[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        for p, book in zip(parts, books):
            index, _ = nearest(p, book)
            for e in set(index.tolist()):
                mine = p[index == e]
                book[e] = mine.sum(0) // len(mine)
    found = [nearest(p, book) for p, book in zip(parts, books)]
    error = sum(d for _, d in found)
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return {r[0]: ("".join("%02x" % i[n] for i, _ in found), int(error[n]), int(sum(e for e, o in zip(error, rows) if o[1] == r[1])), digest) for n, r in enumerate(rows)}


def results(df):
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()}


def test_equals_its_sql(spark):
    small = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    want = db.sql(contract.oracle_sql()["op13_grid_cells"])
    got = contract.queries()["op13_grid_cells"](spark, small).select(want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_clustered_vectors_and_copies(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 0.3, (20, 16))
    rows = [(i, int(i % 5) if i % 7 else None, (centres[i % 20] + rng.normal(0, 0.02, 16)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(900 + i, 1, rows[3][2]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5)
    assert results(codebooks.encode(df)) == plainly(rows)


@pytest.mark.parametrize("size", [16, 4])
def test_the_grid_gives_the_nearest_entry(size):
    rng = np.random.default_rng(size)
    entries = rng.integers(-300, 300, (256, size))
    entries[7] = entries[3]  # ties go to the lower index
    points = np.concatenate([entries, rng.integers(-900, 900, (500, size)), np.repeat(entries[:1] + 1, 50, axis=0)])
    for fineness in (1, 2, 8):
        grid = codebooks.Grid(entries, fineness)
        index, distance = grid.nearest(points)
        all_ = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (index == all_.argmin(1)).all() and (distance == all_.min(1)).all() and 7 not in index
        before = len(grid.known)
        grid.nearest(points)
        assert len(grid.known) == before


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [0.5, -0.25, 0.0, 1.0]), (2, None, [0.5, None, 0.0, 1.0]), (3, 0, [nan, 0.0, 0.0, 0.0]), (4, 0, [0.0, inf, 0.0, 0.0]), (5, 0, None), (6, None, [0.1, 0.1, 0.1]), (None, 1, [-0.5, -0.25, 0.0, -1.0]), (7, 1, [1e30, -1e30, 0.0, 0.0]), (7, 1, [1e30, -1e30, 0.0, 0.0]), (8, 1, [])]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, label int, embedding array<double>, code string, error int")
    got = sorted(((r.vec_id, r.code, r.error) for r in codebooks.encode(df).collect()), key=str)
    assert [g[0] for g in got] == [1, 6, 7, 7, None] and got[1][1:] == (None, None) and got[2] == got[3]
    assert got[0][2] == 0 and len({r.codebooks_sha256 for r in codebooks.encode(df).collect()}) == 1
    assert codebooks.encode(df.limit(0)).count() == 0
    assert codebooks.encode(df.filter("vec_id = 5")).count() == 0
