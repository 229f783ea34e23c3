"""Nearest vectors by multiprobe p-stable hashing.

Each table projects vectors onto random Gaussian directions and cuts the projections into steps; a vector's bucket is
the steps that it falls into. A query visits its own bucket and those one step away in some directions, in the order in
which they are expected to hold near vectors: by how close the query stands to the borders that they lie behind. What
the tables give is measured exactly and merged.

How many buckets are visited is not guessed: some trial queries are held against all rows, and the number that finds
the wanted share of their true neighbours is used for all.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import finite, materialize

TABLES = 8
SEED = 20_240_501
#: Queries that are held against all rows; with their neighbours all that the driver holds.
TRIALS = 128
#: Share of the trial queries' true neighbours that the visited buckets must hold.
RECALL = 0.95
#: Buckets of a table that a query visits at most; if they don't reach RECALL, buckets are made larger.
PROBES = 1_500
#: Vectors of a table that meet in a task, about; fuller slots are split.
SLOT_ROWS = 8_192


@dataclass(frozen=True)
class Plan:
    """Directions a table, width of a step, buckets to visit, directions that name a slot, and slots a table."""

    directions: int
    width: float
    probes: int = 1
    leading: int = 1
    slots: int = 1

    def hashed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, table, direction): the step, and how far into it."""
        rng = np.random.default_rng([SEED, x.shape[1], self.directions])
        shape = (x.shape[1], TABLES * self.directions)
        at = np.clip((x @ rng.standard_normal(shape)) / self.width + rng.uniform(0, 1, shape[1]), -(2.0**40), 2.0**40)
        step = np.floor(at)
        return step.astype(np.int64).reshape(len(x), TABLES, -1), (at - step).reshape(len(x), TABLES, -1)

    def named(self, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bucket's name and its slot, of steps (..., direction)."""
        odd = np.random.default_rng(SEED).integers(1, 1 << 62, self.directions) | 1
        mixed = steps * odd
        lead = mixed[..., : self.leading].sum(-1)
        return mixed.sum(-1), np.mod(lead ^ (lead >> 29), self.slots)

    def visits(self) -> list[tuple[int, ...]]:
        """Sets of places in the order of a query's 2 M distances to borders, by expected score: what to step over."""
        m = self.directions
        j = np.arange(1, 2 * m + 1)
        score = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)))
        out, queue = [()], [(score[0], (0,))]
        while queue and len(out) < self.probes:
            total, places = heapq.heappop(queue)
            if all(2 * m - 1 - k not in places for k in places):  # never both borders of one direction
                out.append(places)
            last = places[-1]
            if last + 1 < 2 * m:
                heapq.heappush(queue, (total - score[last] + score[last + 1], (*places[:-1], last + 1)))
                heapq.heappush(queue, (total + score[last + 1], (*places, last + 1)))
        return out

    def borders(self, into: np.ndarray) -> np.ndarray:
        """(..., place): which of the 2 M borders stand at each place in order of distance; those below come first."""
        return np.argsort(np.concatenate([into, 1 - into], axis=-1), axis=-1, kind="stable")


def bucket_probes(plan: Plan, steps: np.ndarray, into: np.ndarray, visits: np.ndarray) -> np.ndarray:
    """(visit, direction): the buckets that one query visits in one table. visits: (visit, place) as 0 and 1."""
    m = plan.directions
    change = np.zeros((len(visits), 2 * m), np.int64)
    change[:, plan.borders(into)] = visits
    return steps + change[:, m:] - change[:, :m]


def as_matrix(visits: list[tuple[int, ...]], m: int) -> np.ndarray:
    out = np.zeros((len(visits), 2 * m), np.int64)
    for i, places in enumerate(visits):
        out[i, list(places)] = 1
    return out


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = x - q
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def nearest(x: np.ndarray, first: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the k nearest, ties to the smaller `first`."""
    d = distances(x, q)
    best = np.lexsort((first, d))[:k]
    return best, d[best]


def vectors_of(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def packed_vectors(batches):
    for p in batches:
        packed = [(np.asarray(v, np.float64) + 0.0).tobytes() for v in p["v"]]  # no negative zeros
        yield p[["vec_id", "wanted"]].assign(length=[len(x) // 8 for x in packed], packed=packed)


def distinct_vectors(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (rep, ids, first, length, packed, asked), and the queries (vec_id, rep).

    `ids` are the k + 1 smallest vec_ids that have the vector, more can't be among the k nearest of any query; `first`
    is the smallest. `rep` numbers the vectors. `asked` tells whether a query has the vector.
    """
    packed = rows.mapInPandas(packed_vectors, "vec_id long, wanted boolean, length int, packed binary")
    once = packed.groupBy("vec_id", "packed", "length").agg(F.max("wanted").alias("wanted"))
    least = once.withColumn("n", F.row_number().over(Window.partitionBy("packed", "length").orderBy("vec_id"))).filter(F.col("n") <= k + 1)
    kept = least.groupBy("packed", "length").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    queries = once.filter("wanted").select("vec_id", "packed", "length")
    asked = queries.select("packed", "length").distinct().withColumn("asked", F.lit(True))
    told = kept.join(asked, ["packed", "length"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    known = materialize(told.withColumn("first", F.col("ids")[0]).withColumn("rep", F.monotonically_increasing_id()))
    return known, materialize(queries.join(known.select("packed", "length", "rep"), ["packed", "length"]).select("vec_id", "rep"))


def fitted(vectors: DataFrame, k: int) -> Plan:
    """The plan for these vectors: a width by the distance of true neighbours, buckets by their number, visits by trial.

    The driver holds TRIALS queries and their k nearest; they are compared with every vector, in tasks.
    """
    n = vectors.count()
    drawn = vectors.filter("asked").select("rep", "packed").orderBy(F.xxhash64("packed"), "packed").limit(TRIALS).collect()
    trials = [(r["rep"], np.frombuffer(r["packed"])) for r in drawn]

    def compare(batches):
        for p in batches:
            for length, group in p.groupby("length"):
                x = vectors_of(group["packed"])
                first, near, raw = (group[c].to_numpy() for c in ("first", "rep", "packed"))
                for rep, q in trials:
                    if len(q) == length:
                        best, d = nearest(x, first, q, k + 1)
                        yield pd.DataFrame({"rep": rep, "d": d, "first": first[best], "near": near[best], "packed": raw[best]})

    met = vectors.select("rep", "first", "length", "packed").mapInPandas(compare, "rep long, d double, first long, near long, packed binary").filter("rep <> near")
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("d", "first"))
    true = met.withColumn("rank", rank).filter(F.col("rank") <= k).collect()  # TRIALS * k rows
    far = [r["d"] for r in true if np.isfinite(r["d"])]
    width = 2.25 * float(np.quantile(far, 0.9)) if far and max(far) > 0 else 1.0
    leading = max(1, round(np.log2(max(n, 1) / SLOT_ROWS)))
    slots = max(1, -(-2 * n // SLOT_ROWS))
    trial = dict(trials)
    for m in range(max(4, round(np.log2(max(n, 2))) - 1), 0, -1):
        plan = Plan(m, width, PROBES, min(leading, m), slots)
        visits = plan.visits()
        place = {v: i for i, v in enumerate(visits)}
        seen = np.array([least_visit(plan, place, trial[r["rep"]], np.frombuffer(r["packed"])) for r in true])
        enough = int(np.ceil(RECALL * len(seen)))
        if not enough:
            return Plan(m, width, 1, min(leading, m), slots)
        need = np.sort(seen)[enough - 1]
        if need < len(visits):
            return Plan(m, width, int(need) + 1, min(leading, m), slots)
    return plan


def least_visit(plan: Plan, place: dict, q: np.ndarray, x: np.ndarray) -> float:
    """The visit at which some table shows x to q; infinite if none of them does."""
    steps, into = plan.hashed(np.stack([q, x]))
    borders = plan.borders(into[0])
    best = np.inf
    for t in range(TABLES):
        change = steps[1, t] - steps[0, t]
        if np.abs(change).max() <= 1:
            crossed = np.concatenate([change < 0, change > 0])
            best = min(best, place.get(tuple(np.flatnonzero(crossed[borders[t]]).tolist()), np.inf))
    return best


def index_rows(batches, plan: Plan):
    """rep, first, length, packed, and for each table the slot and the bucket."""
    for p in batches:
        for _, group in p.groupby("length"):
            bucket, slot = plan.named(plan.hashed(vectors_of(group["packed"]))[0])
            yield group[["rep", "first", "length", "packed"]].assign(slots=list(slot.astype(np.int32)), buckets=list(bucket))


def probe_rows(batches, plan: Plan):
    """rep, length, packed, table, slot, buckets: what a query visits in each slot."""
    visits = as_matrix(plan.visits(), plan.directions)
    for p in batches:
        out = []
        for length, group in p.groupby("length"):
            steps, into = plan.hashed(vectors_of(group["packed"]))
            for i, (rep, raw) in enumerate(zip(group["rep"], group["packed"])):
                for t in range(TABLES):
                    bucket, slot = plan.named(bucket_probes(plan, steps[i, t], into[i, t], visits))
                    out += [(rep, length, raw, t, s, bucket[slot == s]) for s in np.unique(slot)]
        yield pd.DataFrame(out, columns=["rep", "length", "packed", "table", "slot", "buckets"])


NONE_FOUND = pd.DataFrame({"rep": np.zeros(0, np.int64), "d": np.zeros(0), "first": np.zeros(0, np.int64), "near": np.zeros(0, np.int64)})


def meet(asked: pd.DataFrame, there: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of the vectors in a part of a slot, for each query that visits it."""
    there = there.sort_values("bucket", kind="stable")
    keys, ids, first = (there[c].to_numpy(np.int64) for c in ("bucket", "rep", "first"))
    x = vectors_of(there["packed"]) if len(there) else None
    found = [NONE_FOUND]
    for rep, raw, buckets in zip(asked["rep"], asked["packed"], asked["buckets"]):
        start, end = np.searchsorted(keys, buckets), np.searchsorted(keys, buckets, side="right")
        lengths = end - start
        if total := int(lengths.sum()):
            at = np.repeat(start - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
            best, d = nearest(x[at], first[at], np.frombuffer(raw), k)
            found.append(pd.DataFrame({"rep": rep, "d": d, "first": first[at][best], "near": ids[at][best]}))
    return pd.concat(found)


def candidates(vectors: DataFrame, plan: Plan, k: int) -> DataFrame:
    """rep, d, near: of each queried vector the k + 1 nearest distinct ones that its visits show, itself included.

    Tables are dealt out by slots, the leading steps of a bucket, so that most visits of a query stay in a few of them. A
    slot of more than SLOT_ROWS vectors is split, whatever buckets fill it, and its visitors go to all parts.
    """
    slot = ["length", "table", "slot"]
    hashed = materialize(vectors.select("rep", "first", "length", "packed").mapInPandas(lambda b: index_rows(b, plan), "rep long, first long, length int, packed binary, slots array<int>, buckets array<long>"))
    entries = hashed.select("rep", "first", "length", "packed", F.posexplode(F.arrays_zip("slots", "buckets")).alias("table", "e"))
    entries = entries.select("rep", "first", "length", "packed", "table", F.col("e.slots").alias("slot"), F.col("e.buckets").alias("bucket"))
    sizes = materialize(entries.groupBy(*slot).agg(F.ceil(F.count(F.lit(1)) / SLOT_ROWS).cast("int").alias("parts")))
    entries = entries.join(sizes, slot).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).drop("parts")
    probes = vectors.filter("asked").select("rep", "length", "packed").mapInPandas(lambda b: probe_rows(b, plan), "rep long, length int, packed binary, table int, slot int, buckets array<long>")
    probes = probes.join(sizes, slot).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    by = [*slot, "part"]
    found = probes.groupBy(*by).cogroup(entries.groupBy(*by)).applyInPandas(lambda a, b: meet(a, b, k + 1), "rep long, d double, first long, near long")
    return found.distinct().withColumn("n", F.row_number().over(Window.partitionBy("rep").orderBy("d", "first", "near"))).filter(F.col("n") <= k + 1).drop("n")


def search(vectors: DataFrame, wanted: Column, k: int) -> DataFrame:
    """vec_id, rank, near_id, distance: of each row that `wanted` names the k nearest other rows found, ties to the
    smaller id; all others, if there are fewer. Distances are Euclidean, in double precision.

    Approximate: the visited buckets hold RECALL of the true neighbours of TRIALS trial queries. Rows without vec_id and
    vectors that are null, empty, zero or hold null or non-finite components take no part; vectors of unlike lengths
    never meet. Equal rows count once; of rows with one vec_id and different vectors each is asked, and none is its own
    neighbour. Equal vectors are searched once, whatever their number. An empty table gives an empty result, other
    columns are ignored.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & finite("embedding") & F.exists("embedding", lambda x: x != 0)).select("vec_id", F.coalesce(wanted, F.lit(False)).alias("wanted"), F.col("embedding").alias("v"))
    known, queries = distinct_vectors(rows, k)
    found = candidates(known, fitted(known, k), k)
    named = found.join(known.select(F.col("rep").alias("near"), "ids"), "near").select("rep", "d", F.explode("ids").alias("id"))
    lists = named.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("d", "id"))).alias("list"))  # (k + 1) ** 2 at most
    out = queries.join(lists, "rep").select("vec_id", F.posexplode(F.slice(F.filter("list", lambda x: x["id"] != F.col("vec_id")), 1, k)).alias("rank", "e"))
    return out.select("vec_id", (F.col("rank") + 1).alias("rank"), F.col("e.id").alias("near_id"), F.col("e.d").alias("distance"))
