"""Alignments of two tokenizers against a plain walk over the bytes of every text."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


def plainly(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_letters()
    spell_a = {i: bytes(letters[c] for c in t) for t, i in first.get_vocab().items() if t != "<|endoftext|>"}

    def spell_b(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    told, number = [], Counter()
    for key, text in rows:
        a, b, groups = first.encode(" " + (text or ""), add_special_tokens=False).ids, second.encode(text or ""), []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(map(spell_a.get, a)) != raw or b"".join(map(spell_b, b)) != raw:
            told.append((key, [], [], []))
            continue
        x, y, left, right = [], [], 0, 0
        todo = list(b)
        for i in a:
            x.append(i)
            left += len(spell_a[i])
            while todo and right < left:
                y.append(todo.pop(0))
                right += len(spell_b(y[-1]))
            if left == right:
                groups.append((x, y))
                x, y = [], []
        told.append((key, a, b, groups))
        number.update((x[-1], y[-1]) for x, y in groups)
    most = defaultdict(int)
    for (_, b), n in number.items():
        most[b] = max(most[b], n)
    out = []
    for key, a, b, groups in told:
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((key, len(a), len(b), len(groups), len(links), sum(number[p] == most[p[1]] for p in links), sum(number[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def results(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


AWKWARD = [
    (1, None), (2, ""), (3, " "), (4, "plain words here"), (4, "plain words here"), (5, "<|endoftext|> <s> </s> <unk> <0x41>"), (6, "tabs\tand\n\n\nlines  two   spaces "), (7, "中文和日本語のテキスト한국어"), (8, "naïve café ﬁ ① ½ 　 x"),
    (9, "🙂🙃 👩‍👩‍👧 ​ zero"), (10, "a" * 3_000), (11, " " * 5_000 + "x"), (12, "▁marked ▁▁"), (None, "no id at all"), (13, "Привет, мир! Ελληνικά 12345 67,89"), (14, "\x00nul\x07bell"), (15, "\r\nends \r\n"), (9_007_199_254_740_993, "a large id"),
]


def test_awkward_texts(spark):
    df = spark.createDataFrame([(k, t, 1.0) for k, t in AWKWARD], "doc_id long, text string, n_a double")
    order = lambda r: (r[0] is None, r[0] or 0)
    got, want = sorted(results(alignment.align(df)), key=order), sorted(plainly(AWKWARD), key=order)
    assert got == want
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in got if r[0] in (1, 2))
    assert alignment.align(df.limit(0)).count() == 0


def test_a_corpus_in_small_groups(spark, corpus, monkeypatch):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(alignment, "GROUP", 20_000)
    monkeypatch.setattr(alignment, "CHUNK", 5_000)
    want = sorted(plainly(rows))
    assert sorted(results(alignment.align(df))) == want


def test_both_files_of_the_vocabulary_agree():
    """The rank encoder gives the ids of the JSON encoder for every code point beside letters, digits, spaces, marks."""
    tokens = alignment.Pair(*alignment.public_paths())
    points = [c for c in range(1, 0x110000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}b 1{chr(c)}2 .{chr(c)}, {chr(c)}{chr(c)} x" for c in points]
    slow = [e.ids for e in tokens.slow.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert [tokens.first.encode_ordinary(" " + t) for t in texts] == slow


def test_windows_are_aligned_once(spark):
    tokens = alignment.Pair(*alignment.public_paths())
    group = alignment.Group()
    (both,) = tokens.encode([b"the cat saw the cat and the cat"])
    a, b = (np.array(x) for x in both)
    starts, at_a, at_b = tokens.windows(a, b)
    found = group.numbered(tokens, alignment.window_keys(a, b, at_a, at_b))
    assert len(starts) == 8 and len(set(found.tolist())) == 4 and group.times.tolist() == [3, 3, 1, 1]


@pytest.mark.parametrize("times", [1, 400])
def test_one_very_long_text(spark, times):
    rows = [(1, "some words, 中文, again " * 50 * times)]
    assert results(alignment.align(spark.createDataFrame(rows, "doc_id long, text string"))) == plainly(rows) if times == 1 else alignment.align(spark.createDataFrame(rows, "doc_id long, text string")).first().n_groups > 50_000
