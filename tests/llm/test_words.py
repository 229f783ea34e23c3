"""Hashes of words against the words themselves."""

import random

import numpy as np

from tidemark.llm import words


def test_word_hashes_tell_words_apart(monkeypatch):
    monkeypatch.setattr(words, "BLOCK_BYTES", 64)
    rng = random.Random(4)
    parts = [b"", b" ", b"\t\n\x0b\x0c\r", b"\x00", b"\x00\x00", b"ab", b"ba", "é　x\u0085".encode(), b"q" * 900, b"q" * 901, b" " * 700]
    texts = [b"", b"   ", b"one"] + [rng.choice([b" ", b"\n"]).join(rng.choice([*parts, b"w%d" % rng.randrange(10**6)]) for _ in range(rng.randrange(60))) for _ in range(200)] + [b""]
    hashes, lengths = words.word_hashes(texts)
    want = [t.split() for t in texts]
    assert lengths.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    named = dict(zip(flat, hashes.tolist()))
    assert [named[w] for w in flat] == hashes.tolist()
    assert len(set(named.values())) == len(named)


def test_no_texts_and_no_words():
    for texts in ([], [b""], [b" ", b"\n"]):
        hashes, lengths = words.word_hashes(texts)
        assert len(hashes) == 0 and hashes.dtype == np.uint64 and lengths.tolist() == [0] * len(texts)
