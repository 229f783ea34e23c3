"""Benchmark windows in long, repetitive and many equal texts, against brute force."""

import hashlib
import random
import re

from tidemark.llm import decontamination


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def brute(docs, items):
    windows = {}
    for k, t in items:
        w = words(t)
        for i in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(k))
    sizes, out = {len(x) for x in windows}, []
    for k, t in docs:
        w, hit, met = words(t), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if own := windows.get(tuple(w[i : i + m])):
                    hit.update(range(i, i + m))
                    met |= own
        out.append((k, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, decontamination.decontaminate(docs, items).collect()), key=str)


def test_equals_brute_force_on_few_words(spark):
    rng = random.Random(4)
    text = lambda n, k: " ".join(rng.choice("abcdefgh"[:k]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 120), rng.choice([1, 2, 3, 8]))) for i in range(80)] + [(None, "a " * 30), (None, "a " * 30), (None, None), (7, ""), (7, "x y")]
    items = [(i, text(rng.randrange(1, 30), rng.choice([1, 2, 3, 8]))) for i in range(40)] + [(90, "a " * 15), (91, "a " * 15), (92, None), (93, "?")]
    assert run(spark, docs, items) == brute(docs, items)


def test_shuffled_tables_give_what_broadcast_ones_do(spark, monkeypatch):
    docs = [(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(30)]
    items = [(i, " ".join(f"w{j}" for j in range(i, i + 12))) for i in (3, 20, 100)]
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    assert run(spark, docs, items) == brute(docs, items)


def test_long_and_repetitive_texts_cost_their_length(spark):
    n = 100_000
    long = " ".join(f"w{i * 7919 % 50021}" for i in range(n))
    docs = [(1, "a " * n), (2, f"{long} " * 10), (3, "b c " * n), (4, long[:40])]
    items = [(1, "a " * n), (2, long), (3, long), (4, "b c b")]
    got = {r[0]: r[1:4] for r in run(spark, docs, items)}
    assert got == {1: (n, n, 1), 2: (10 * n, 10 * n, 2), 3: (2 * n, 2 * n - 1, 1), 4: (len(words(long[:40])), 0, 0)}
