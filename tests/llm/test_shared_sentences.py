"""The Jaccard join on texts made of the same sentences, which meet in many lists and are hardly ever linked."""

import random

import numpy as np

from tests.llm.test_results import brute_components
from tidemark.llm import jaccard


def sentences(rng, n):
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(n)]


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 5, 60, 300, 5_000):
        a = np.unique(rng.integers(-(2**62), 2**62, n))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(-(2**62), 2**62, n // 8)]))
        bits = sum(int(x).bit_count() for x in (jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_parity_maps_leave_hardly_a_pair_of_shared_sentences():
    rng = random.Random(6)
    pool = sentences(rng, 40)
    sets = list(jaccard.shingle_sets([" ".join(rng.sample(pool, 6)).encode() for _ in range(400)], jaccard.WORDS))
    maps = np.array([jaccard.parities(s) for s in sets]).view(np.uint64)
    pairs = close = 0
    for i in range(len(sets)):
        left = [len(s) + len(sets[i]) - 2 * jaccard.needed(len(s), len(sets[i])) for s in sets[i + 1 :]]
        close += int((np.bitwise_count(maps[i + 1 :] ^ maps[i]).sum(axis=1) <= left).sum())
        pairs += len(left)
    assert close * 1_000 < pairs


def test_links_between_texts_of_shared_sentences(spark):
    rng = random.Random(12)
    pool = sentences(rng, 12)
    docs = [(i, rng.sample(pool, 6)) for i in range(250)]
    for i in range(0, 250, 5):  # the same sentences with one more or one less, or in another order
        picked = list(docs[i][1])
        docs.append((1_000 + i, [picked[:5], [*picked, rng.choice(pool)], picked[::-1]][i % 3]))
    texts = [(i, " ".join(s)) for i, s in docs]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute_components(texts)
    assert sum(k != c for k, (_, c) in got.items()) > 30
