"""The classifier against dense normal equations and an isotonic fit by its min-max formula, on the same statistics."""

import zlib

import numpy as np
import pytest

from tidemark.llm import quality

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    known = {r["doc_id"]: r["quality"] for r in labels.filter("quality in (0, 1)").collect()}
    rows = [(r["doc_id"], quality.statistics(r["text"]), known[r["doc_id"]], zlib.crc32(str(r["doc_id"]).encode()) % 5) for r in docs.select("doc_id", "text").collect() if r["doc_id"] in known]
    return quality.fit(docs, labels), [r for r in rows if r[3] != 0]


def test_weights_solve_the_dense_equations(learned):
    model, rows = learned
    x = np.stack([r[1] for r in rows])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.sqrt(np.maximum(x.var(0), 1e-6)), rtol=1e-4)
    fits = [r for r in rows if r[3] != 1]
    z, y = model.features(np.stack([r[1] for r in fits])), np.array([r[2] for r in fits], float)
    penalty = np.full(z.shape[1], 1e-4 * len(rows))
    penalty[-1] = 1e-9
    dense = np.linalg.solve(z.T @ z + np.diag(penalty), z.T @ y)
    assert np.allclose(model.weights, dense, rtol=1e-5, atol=1e-7)
    # the same as least squares with a row for each penalty
    stacked = np.linalg.lstsq(np.vstack([z, np.diag(np.sqrt(penalty))]), np.r_[y, np.zeros(z.shape[1])], rcond=None)[0]
    assert np.allclose(z @ model.weights, z @ stacked, atol=1e-5)


def test_features_approximate_the_gaussian_kernel(learned):
    model, rows = learned
    x = np.stack([r[1] for r in rows[:150]])
    z = model.features(x)[:, :-1]
    scaled = np.clip((x - model.mean) / model.scale, -8, 8)
    apart = ((scaled[:, None] - scaled[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * 4.0**2))).mean() < 0.05


def test_calibration_is_the_isotonic_fit(learned):
    """Of binned scores every level is the largest mean from somewhere before it to the smallest mean somewhere behind."""
    model, rows = learned
    held = [r for r in rows if r[3] == 1]
    raw, y = model.raw(np.stack([r[1] for r in held])), np.array([r[2] for r in held], float)
    bins: dict[int, list] = {}
    for s, label in zip(raw, y):
        bins.setdefault(int(np.floor(np.clip(s, -1, 2) * (4096 / 3))), []).append((s, label))
    order = sorted(bins, key=lambda b: np.mean([s for s, _ in bins[b]]))
    total, weight = np.array([sum(v for _, v in bins[b]) for b in order]), np.array([float(len(bins[b])) for b in order])
    at = np.array([np.mean([s for s, _ in bins[b]]) for b in order])
    t, w = np.r_[0, np.cumsum(total)], np.r_[0, np.cumsum(weight)]
    n = len(order)
    level = [max(min((t[k] - t[j]) / (w[k] - w[j]) for k in range(i + 1, n + 1)) for j in range(i + 1)) for i in range(n)]
    knots = [at[np.isclose(level, v)] @ weight[np.isclose(level, v)] / weight[np.isclose(level, v)].sum() for v in sorted(set(np.round(level, 12)))]
    assert np.allclose(model.levels, sorted(set(np.round(level, 12)))) and np.allclose(model.knots, knots)


def test_clashing_columns_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "some words", 7.0, "kept"), (1, "", 8.0, "kept")], "doc_id long, text string, score double, note string")
    model = quality.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    got = quality.classify(docs, model)
    assert got.columns == ["doc_id", "text", "score", "note", "predicted"] and {(r["score"], r["note"]) for r in got.collect()} <= {(0.5, "kept"), (1.0, "kept")}
