"""The mixture by brute force, through the slots of its schedule."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(["w"] * (i * 37 % 211)), None if i % 11 == 0 else "abcde"[i % 5 if i % 3 else 0]) for i in range(400)]
    rows += [(None, "x y z", "a"), (None, "x y z", "a"), (7, "one two", "f"), (8, "w " * 90_000, "e"), (9, None, "g"), (10, " ", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).persist()


def brute(docs, target, block):
    """taken of every document: slots walk the sources' blocks word by word."""
    rows = docs.select("doc_id", "text", "source", F.xxhash64("doc_id", F.lit(17)).alias("h")).collect()
    streams = defaultdict(list)
    for r in rows:
        n = len((r["text"] or "").split())
        streams[r["source"]].append((r["h"], r["doc_id"] is not None, r["doc_id"] or 0, n))
    order = sorted(streams, key=lambda s: (s is None, s or ""))
    size = {s: sum(x[3] for x in streams[s]) for s in order}
    n_blocks = {s: -(-size[s] // block) for s in order}
    need = {s: round(target[s] * n_blocks[s] / size[s] * 1024) if size[s] else 0 for s in order}
    total, counts = sum(need.values()), dict.fromkeys(order, 0)
    for slot in range(-(-total // 1024)):
        u = slot // mixing.SPLIT * mixing.GOLDEN_HIGH + slot % mixing.SPLIT * mixing.GOLDEN
        u, low = u % 1.0, 0
        for s in order:
            if low / total <= u < (low + need[s]) / total:
                counts[s] += 1
            low += need[s]
    out = []
    for s in order:
        times = [0] * n_blocks[s]
        for rank in range(min(counts[s], 3 * n_blocks[s])):
            times[rank % n_blocks[s]] += 1
        length, longer = divmod(size[s], n_blocks[s]) if size[s] else (0, 0)
        of_word = [t for b, t in enumerate(times) for _ in range(length + (b < longer))]
        at = 0
        for _, has_id, doc_id, n in sorted(streams[s]):
            out.append((doc_id if has_id else None, n, sum(of_word[at : at + n])))
            at += n
    return sorted(out, key=str)


def taken(docs, **more):
    rows = mixing.mix(docs, **more).collect()
    return sorted(((r["doc_id"], r["size"], r["taken"]) for r in rows), key=str), rows


@pytest.mark.parametrize("block", [1, 32])
def test_equals_brute_force(docs, block):
    got, rows = taken(docs, block_words=block)
    target = {r["source"]: r["target"] for r in mixing.targets(docs.groupBy("source").agg(F.sum(mixing.n_words(F.col("text"))).alias("source_size"))).collect()}
    assert got == brute(docs, target, block) and all(t <= 3 * n for _, n, t in got) and len(rows) == docs.count()


def test_the_points_decide(docs, monkeypatch):
    want, rows = taken(docs)
    monkeypatch.setattr(mixing, "GOLDEN", 0.5)  # two points in turn
    assert taken(docs)[0] != want


def test_slots_are_even(spark):
    parts = spark.createDataFrame([(0, 500.0), (1, 0.0), (2, 1.0), (3, 299.5)], "idx long, need double")
    rows = sorted(map(tuple, mixing.schedule(parts).collect()))
    assert [r[0] for r in rows] == list(range(801)) and {r[1] for r in rows} == {0, 2, 3}
    for idx, share in ((0, 500 / 800.5), (3, 299.5 / 800.5)):
        own = [slot for slot, i, _ in rows if i == idx]
        assert [r for _, i, r in rows if i == idx] == list(range(len(own)))
        assert all(abs((b - a) * share - (own.index(b) - own.index(a))) <= 4 for a in own[::50] for b in own[::50] if a < b)


def test_points_keep_their_digits(spark):
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    ratio, slots = (Decimal(5).sqrt() - 1) / 2, [0, 1, 2**25, 2**40 + 12345, 2**49 + 7]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in slots], "i long").select(mixing.point(F.col("i"))).collect()]
    assert all(abs(Decimal(g) - i * ratio % 1) < Decimal("1e-7") for g, i in zip(got, slots))
