"""The Jaccard join hashes and orders the sets of a batch together, not one by one."""

import random

import numpy as np
import pandas as pd
import zstandard

from tidemark.llm import jaccard, words


def texts(rng, n):
    return [" ".join(f"w{rng.randrange(rng.choice([2, 9, 400]))}" for _ in range(rng.choice([0, 1, 2, 4, 5, 6, 60]))) for _ in range(n)]


def test_a_batch_is_hashed_at_once(monkeypatch):
    mix, calls = jaccard.mix, []
    monkeypatch.setattr(jaccard, "mix", lambda h: calls.append(1) or mix(h))
    some = texts(random.Random(1), 500)
    batch = pd.DataFrame({"doc_id": range(500), "nameless": False, "said": 0, "text": some})
    rows = pd.concat(jaccard.survey([batch]))
    assert len(calls) < 20
    n = rows[rows["shingle"].isna()]["n"].tolist()
    assert n == [len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0 for w in map(str.split, some)]
    calls.clear()
    squeezer = zstandard.ZstdCompressor(level=1)
    maps = pd.concat(jaccard.parity_maps([pd.DataFrame({"s1": range(500), "packed": [squeezer.compress(t.encode()) for t in some]})]))
    assert len(calls) < 20 and len(maps) == 500


def test_shingles_of_a_batch_are_those_of_its_texts():
    rng = random.Random(2)
    for _ in range(50):
        raws = [t.encode() for t in texts(rng, rng.randrange(12))]
        flat, sizes = words.shingle_lists(raws, 5)
        alone = [s for raw in raws for s in words.shingle_sets([raw], 5)]
        assert sizes.tolist() == [len(s) for s in alone]
        assert flat.tolist() == [x for s in alone for x in s.tolist()]
        assert all((s[1:] > s[:-1]).all() for s in alone)


def test_prefixes_follow_the_common_order():
    rng = np.random.default_rng(3)
    for _ in range(100):
        sets = [np.unique(rng.integers(-40, 40, rng.integers(1, 60))) * 2**56 + 7 for _ in range(rng.integers(1, 9))]
        heavy = np.unique(rng.integers(-40, 40, rng.integers(0, 30))) * 2**56 + 7
        rank = rng.permutation(len(heavy))
        order = dict(zip(heavy.tolist(), rank.tolist()))
        want = []
        for i, s in enumerate(sets):
            row = sorted(s.tolist(), key=lambda x: (x in order, order.get(x, x)))
            want += [(x, i, k, x in order) for k, x in enumerate(row[: len(row) - (3 * len(row) + 3) // 4 + 1])]
        got = jaccard.prefixes(np.concatenate(sets), np.array([len(s) for s in sets]), heavy, rank, jaccard.sieve_of(heavy))
        assert sorted(zip(*(x.tolist() for x in got))) == sorted(want)


def test_words_of_all_lengths_are_told_apart(monkeypatch):
    monkeypatch.setattr(words, "BLOCK_BYTES", 64)
    sizes = [*range(1, 40), *range(words.LONG_WORD - 9, words.LONG_WORD + 90)]
    all_words = [w for n in sizes for w in {b"a" * n, b"b" + b"a" * (n - 1), b"a" * (n - 1) + b"b"}]
    one, lengths = words.word_hashes([b" ".join(all_words)])
    other, _ = words.word_hashes([b"\n\n".join(reversed(all_words)), b"a"])
    assert lengths.tolist() == [len(all_words)] and len(set(one.tolist())) == len(all_words)
    assert other[:-1][::-1].tolist() == one.tolist()
