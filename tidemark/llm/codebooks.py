"""Compact codes of vectors: four parts, each named by the nearest of 256 integer entries, found through grid cells.

A part lies in a cell of a coarse grid. For all points of a cell, an entry whose least distance to the cell exceeds the
largest distance of some other entry can't be nearest; what is left is kept for the cell, and only that is evaluated,
exactly, for the parts that fall into it. All numbers are integers, so neither the order of rows nor the number of tasks
changes a result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finite, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components are held to this in size, so that squared distances of a thousand of them fit in 64 bits.
LARGEST = 1 << 25
#: Cells of a part position that a task remembers at most; then it forgets all and goes on.
CELLS = 1 << 15
#: Numbers that a task handles at once in evaluating.
AT_ONCE = 1 << 20


class Grid:
    """Nearest entries of one part position, with the entries left for each cell remembered."""

    def __init__(self, entries: np.ndarray, fineness: int = 2):
        self.entries, self.known = entries, {}
        self.width = self.cell_width(fineness)

    def cell_width(self, fineness: int) -> int:
        """A cell's diagonal is a `fineness`-th of the usual distance between an entry and the one next to it."""
        e = self.entries.astype(np.float64)
        squares = (e * e).sum(1)
        apart = np.maximum(squares[:, None] + squares[None] - 2 * e @ e.T, 0)
        apart[apart < 1] = np.inf
        nearest = apart.min(1)
        nearest = nearest[np.isfinite(nearest)]
        return max(1, int(np.median(np.sqrt(nearest)) / np.sqrt(e.shape[1]) / fineness)) if len(nearest) else 1

    def left(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries that no other dominates across it, by least and largest distance."""
        low, out = cells * self.width, []
        step = max(1, AT_ONCE // self.entries.size)
        for at in range(0, len(low), step):
            below = self.entries[None] - low[at : at + step, None]  # from the cell's low corner to the entry
            above = below - (self.width - 1)
            least = np.maximum(np.maximum(-below, above), 0)
            most = np.maximum(np.abs(below), np.abs(above))
            least, most = (least * least).sum(2), (most * most).sum(2)
            out += [np.flatnonzero(row).astype(np.int16) for row in least <= most.min(1)[:, None]]
        return out

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties to the lower one) and squared distance of each point."""
        if len(self.known) > CELLS:
            self.known.clear()
        cells, cell = np.unique(np.floor_divide(points, self.width), axis=0, return_inverse=True)
        keys = [c.tobytes() for c in cells]
        fresh = [i for i, key in enumerate(keys) if key not in self.known]
        self.known.update(zip([keys[i] for i in fresh], self.left(cells[fresh])))
        held = [self.known[key] for key in keys]
        index, distance = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
        step = max(1, AT_ONCE // self.entries.size)
        for at in range(0, len(points), step):
            lists = [held[c] for c in cell[at : at + step].ravel()]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            starts, entry = np.cumsum(lengths) - lengths, np.concatenate(lists)
            apart = np.repeat(points[at : at + step], lengths, axis=0) - self.entries[entry]
            apart = np.einsum("ij,ij->i", apart, apart)
            least = np.minimum.reduceat(apart, starts)
            index[at : at + step] = np.minimum.reduceat(np.where(apart == np.repeat(least, lengths), entry, ENTRIES), starts)
            distance[at : at + step] = least
        return index, distance


def whole(vectors: pd.Series) -> list[bytes]:
    """Vectors as integers floor(1024 x), as many zeros behind as make the length a multiple of PARTS."""
    out = []
    for v in vectors:
        x = np.clip(np.floor(np.asarray(v, np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int32)
        out.append(np.pad(x, (0, -len(x) % PARTS)).tobytes())
    return out


def parts_of(packed: list[bytes]) -> np.ndarray:
    """(vector, part position, place in the part)."""
    return np.frombuffer(b"".join(packed), np.int32).reshape(len(packed), PARTS, -1).astype(np.int64)


def sums(batches, codebooks: np.ndarray):
    """part, entry, n, sums: what the parts of a task add to each entry."""
    grids = [Grid(c) for c in codebooks]
    n = np.zeros(codebooks.shape[:2], np.int64)
    total = np.zeros(codebooks.shape, np.int64)
    for p in batches:
        points = parts_of(list(p["packed"])) if len(p) else np.zeros((0, *codebooks.shape[::2]), np.int64)
        for part, grid in enumerate(grids):
            index, _ = grid.nearest(points[:, part])
            np.add.at(n[part], index, 1)
            np.add.at(total[part], index, points[:, part])
    part, entry = np.nonzero(n)
    yield pd.DataFrame({"part": part, "entry": entry, "n": n[part, entry], "sums": list(total[part, entry])})


def codes(batches, codebooks: np.ndarray):
    grids = [Grid(c) for c in codebooks]
    for p in batches:
        found = [grid.nearest(parts) for grid, parts in zip(grids, parts_of(list(p["packed"])).transpose(1, 0, 2))] if len(p) else []
        named = ["".join("%02x" % i for i in row) for row in np.array([i for i, _ in found]).T]
        yield p[["vec_id", "label"]].assign(code=named, error=sum(d for _, d in found) if found else np.zeros(0, np.int64))


def encode(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row for each row whose vector is finite.

    `code` has two hex digits for each of four parts, `error` the squared distances of the parts to their entries,
    `label_error` the errors of all rows with that label (null is a label). The codebooks start from the 256 smallest
    vec_ids (of equal ones, the smaller vectors; nulls last) and take `rounds` rounds of nearest entries and floored
    means over all rows; between rounds the driver holds the entries and nothing else, 1,024 rows whatever the input.

    Null vectors, and those with null or non-finite components, are left out. With fewer than 256 rows there are as many
    entries. A vector of another length than the first has a null code and error and moves no entry; a length that four
    doesn't divide is filled up with zeros. Components are held to 32768 in size. Repeated rows count each, an empty
    table gives an empty result, other columns are ignored.
    """
    kept = vectors.select("vec_id", "label", F.col("embedding").alias("v")).filter(finite("v") & (F.size("v") > 0))
    first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    size = len(first[0]["v"]) if first else 0
    start = parts_of(whole(pd.Series([r["v"] for r in first if len(r["v"]) == size]))) if first else np.zeros((0, PARTS, 1), np.int64)
    codebooks = start.transpose(1, 0, 2).copy()

    def shrink(batches):
        for p in batches:
            yield p[["vec_id", "label"]].assign(packed=whole(p["v"]))

    kinds = dict(kept.dtypes)
    ids = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    held = materialize(kept.filter(F.size("v") == size).mapInPandas(shrink, f"{ids}, packed binary"))
    for _ in range(rounds if first else 0):
        found = held.select("packed").mapInPandas(lambda b, c=codebooks: sums(b, c), "part int, entry int, n long, sums array<long>")
        added = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(codebooks.shape[2])]).alias("sums"))
        codebooks = codebooks.copy()
        for r in added.collect():  # a row for each entry
            codebooks[r["part"], r["entry"]] = np.floor_divide(np.array(r["sums"], np.int64), r["n"])
    coded = held.mapInPandas(lambda b: codes(b, codebooks), f"{ids}, code string, error long") if first else held.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    other = kept.filter(F.size("v") != size).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = materialize(coded.unionByName(other))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel())).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
