"""Shards by brute force: the curve, groups of equal texts, the cut."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, shard long"


def brute(spark, df, n_shards, whole_group):
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    rows = df.select("doc_id", "text", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"), F.xxhash64("text").alias("h"), sharding.hilbert_index(sharding.metadata_cells(df, size)).alias("at")).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["h"], r["crc"], r["size"]].append(r)
    total, before, out, slots = sum(r["size"] for r in rows), 0, [], defaultdict(int)
    part = lambda at, own: min((2 * at + own) * n_shards // (2 * total), n_shards - 1)
    for key, own in sorted(groups.items(), key=lambda g: (min(r["at"] for r in g[1]), g[0])):
        whole = len(own) * key[2]
        shard = part(before, whole) if whole <= int(total * whole_group / n_shards) else None
        for r in sorted(own, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
            mine = shard if shard is not None else part(before, r["size"])
            out.append((r["doc_id"], r["size"], r["crc"], mine, slots[mine]))
            slots[mine] += 1
            before += r["size"]
    return sorted(out, key=str)


@pytest.mark.parametrize(("n_shards", "whole_group"), [(40, 0.05), (7, 0.5), (3, 0.0)])
def test_equals_brute_force(spark, n_shards, whole_group):
    rng = random.Random(6)
    texts = [" ".join("x" * rng.randrange(1, 9) for _ in range(rng.randrange(1, 60))) for _ in range(120)] + [None, ""]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None]), rng.choice("abc"), i) for i in range(500)]
    rows += [(1000 + i, texts[0], "en", "a", 0) for i in range(250)] + [(None, "no id", "en", "a", 0)] * 3 + [(5, "y" * 3000, None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard(df, n_shards, whole_group).collect()), key=str)
    assert got == brute(spark, df, n_shards, whole_group)


def test_copies_meet_and_sizes_stay_near_equal(spark, corpus):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard(df).collect()
    sizes, places, own = defaultdict(int), defaultdict(set), defaultdict(int)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        places[r["text_crc32"], r["size"]].add(r["shard"])
        own[r["text_crc32"], r["size"]] += r["size"]
    mean = sum(sizes.values()) / 40
    assert all(len(s) == 1 for g, s in places.items() if own[g] <= mean * 0.05)
    assert all(abs(n - mean) <= max(mean * 0.05, max(r["size"] for r in rows)) for n in sizes.values()) and len(sizes) == 40
