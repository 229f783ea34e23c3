"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Byte classes whose shares of a text are features.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".,;:'-", b"!?", b"#$%&*@^~+=", b"|/\\<>{}[]()_\"`", bytes(range(128, 256)), bytes(range(0, 9))]
N_STATISTICS = len(CLASSES) + 15


def statistics(text: str | None) -> np.ndarray:
    """Statistics of a whole text, none of them larger than a few dozen; zeros for an empty one."""
    out = np.zeros(N_STATISTICS)
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return out
    n, bytes_of = len(words), np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = bytes_of / len(raw)
    out[: len(CLASSES)] = [shares[list(c)].sum() for c in CLASSES]
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = Counter(zip(words, words[1:]))
    seen = shares[shares > 0]
    top = counts.most_common(5)
    out[len(CLASSES) :] = [
        np.log1p(n), np.log1p(len(raw)), lengths.mean() / 8, lengths.std() / 8, np.log1p(lengths.max()) / 4,
        len(counts) / n, np.log1p(len(counts)) / np.log1p(n), top[0][1] / n, sum(c for _, c in top) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n, len(pairs) / max(1, n - 1), np.log1p(len(lines)),
        np.log1p(len(raw) / len(lines)), 1 - len(set(lines)) / len(lines), -(seen * np.log2(seen)).sum() / 4,
    ]
    return out


def statistics_of(texts: pd.Series) -> np.ndarray:
    return np.stack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, N_STATISTICS))


@dataclass
class Model:
    """Plain arrays, a few hundred KB whatever the data."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1) if len(x) else np.zeros(0)


def isotonic(score: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted bins; the blocks' mean scores and mean labels."""
    blocks: list[list[float]] = []
    for s, t, w in zip(score, total, weight):
        blocks.append([s * w, t, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 60_000, n_features: int = 300, width: float = 4.0, ridge: float = 1e-4, bins: int = 4096, seed: int = 11) -> Model:
    """Learn from about `max_rows` labelled rows at most (a bound on the sample of labels, taken by hash of doc_id).

    Rows whose crc32(doc_id) mod 5 is 0 are never seen, nor rows without a doc_id (held_out is null for these); those with 1 only calibrate; the rest fit the weights. Every
    partition sums its normal equations and sends one matrix; calibration sees bins of scores. Labels other than 0 and
    1 are left out; without any label of both kinds the model scores all texts with the share of ones (0.5 if none).
    """
    known = labels.filter(F.col("quality").isin(0, 1) & (fold(F.col("doc_id"), 5) != 0)).select("doc_id", F.col("quality").cast("double").alias("y"))
    n = known.count()
    share = min(1.0, max_rows / max(n, 1))
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))) if share < 1 else known
    picked = picked.groupBy("doc_id").agg(F.max("y").alias("y"))

    def measure(parts):
        for p in parts:
            yield pd.DataFrame({"y": p["y"], "calibrates": p["fold"] == 1, "x": list(statistics_of(p["text"]))})

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # max_rows labels of 16 bytes
    measured = materialize(rows.select("text", "y", fold(F.col("doc_id"), 5).alias("fold")).mapInPandas(measure, "y double, calibrates boolean, x array<double>")).coalesce(16)
    rng = np.random.default_rng(seed)
    model = Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), rng.standard_normal((N_STATISTICS, n_features)) / width, rng.uniform(0, 2 * np.pi, n_features), np.zeros(n_features + 1), np.array([0.0]), np.array([0.5]))

    def moments(parts):
        for p in parts:
            x = np.stack(p["x"]) if len(p) else np.zeros((0, N_STATISTICS))
            yield pd.DataFrame({"n": [float(len(x))], "y": [p["y"].sum()], "s": [x.sum(0)], "q": [(x * x).sum(0)]})

    got = measured.mapInPandas(moments, "n double, y double, s array<double>, q array<double>").collect()  # a row for each batch of a bounded sample
    count, ones = sum(r["n"] for r in got), sum(r["y"] for r in got)
    if not 0 < ones < count:
        model.levels = np.array([ones / count if count else 0.5])
        return model
    model.mean = sum(np.array(r["s"]) for r in got) / count
    model.scale = np.sqrt(np.maximum(sum(np.array(r["q"]) for r in got) / count - model.mean**2, 1e-6))

    def equations(parts):
        a, b = np.zeros((n_features + 1, n_features + 1)), np.zeros(n_features + 1)
        for p in parts:
            p = p[~p["calibrates"]]
            if len(p):
                z = model.features(np.stack(p["x"]))
                a, b = a + z.T @ z, b + z.T @ p["y"].to_numpy()
        yield pd.DataFrame({"a": [a.ravel()], "b": [b]})

    sums = measured.mapInPandas(equations, "a array<double>, b array<double>").collect()  # 16 rows
    a = sum(np.array(r["a"]) for r in sums).reshape(n_features + 1, -1)
    penalty = np.full(n_features + 1, ridge * count)
    penalty[-1] = 1e-9
    model.weights = np.linalg.solve(a + np.diag(penalty), sum(np.array(r["b"]) for r in sums))

    def placed(parts):
        for p in parts:
            p = p[p["calibrates"]]
            raw = model.raw(np.stack(p["x"])) if len(p) else np.zeros(0)
            yield pd.DataFrame({"bin": np.floor(np.clip(raw, -1, 2) * (bins / 3)).astype(np.int64), "raw": raw, "y": p["y"].to_numpy()})

    binned = measured.mapInPandas(placed, "bin long, raw double, y double").groupBy("bin").agg(F.avg("raw").alias("raw"), F.sum("y").alias("y"), F.count(F.lit(1)).alias("w")).toPandas()  # at most `bins` rows
    if len(binned):
        binned = binned.sort_values("raw")
        model.knots, model.levels = isotonic(binned["raw"].to_numpy(), binned["y"].to_numpy(), binned["w"].to_numpy(float))
    else:
        model.knots, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def classify(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """docs with `score` (calibrated probability of label 1) and `predicted` (1 if score >= threshold).

    Scores come from the text alone. Null and empty texts have the statistics 0 and a score like any other; equal texts
    have equal scores. The other columns of docs stay; columns named `score` or `predicted` are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # some hundred KB

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.score(statistics_of(texts)))

    return docs.withColumn("score", score("text")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
