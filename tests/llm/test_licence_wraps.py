"""Known licences keep their digests however their paragraphs are wrapped, and lose only real copyright lines."""

import hashlib
import os
import re
import textwrap

import pytest

from tidemark.llm import licenses

PUBLISHED = "/usr/share/common-licenses"


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(block, width, break_long_words=False, break_on_hyphens=False) for block in re.split(r"\n[ \t]*\n", text))


def digest(text):
    return hashlib.sha256(licenses.canonical_text(text).encode()).hexdigest()


def test_every_known_text_at_every_width(spark):
    names = licenses.listed_digests(licenses.KNOWN, licenses.DIGESTS)
    texts = [(name, text) for name, text in licenses.KNOWN if len(text) > 120]
    assert len(texts) >= 3
    for name, text in texts:
        assert {names.get(digest(wrapped(text, w))) for w in range(40, 121)} == {name}
    rows = [(w, wrapped(text, w).replace("<year> <copyright holders>", "2019 Some Body")) for name, text in texts if name == "MIT" for w in (40, 72, 79, 80, 100, 120)]
    assert {r["licence"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {"MIT"}


LINES = {
    "Copyright (c) 2019 Some Body": True, "  * Copyright 1999-2004 The Body": True, "(c) 2020 Body": True, "© Body": True, "Copyright © Body": True, "Copyright [yyyy] [name of copyright owner]": True, "# COPYRIGHT (C) BODY": True,
    "copyright notice and this permission notice shall be included in all": False, "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM": False, "(c) You must retain, in the Source form": False, "copyrighted in 2004 by nobody": False, "All copyright 2004": False,
}


def test_lines_that_state_a_copyright(spark):
    texts = {n: f"one\n{line}\ntwo" for n, line in enumerate(LINES)}
    without = hashlib.sha256(b"one two").hexdigest()
    assert [digest(t) == without for t in texts.values()] == list(LINES.values())
    got = {r["doc_id"]: r["digest"] for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {n: digest(t) for n, t in texts.items()}


@pytest.mark.skipif(not os.path.isdir(PUBLISHED), reason="no published texts here")
def test_published_texts_are_named():
    names = licenses.listed_digests(licenses.KNOWN, licenses.DIGESTS)
    found = {f: names.get(digest(open(f"{PUBLISHED}/{f}", encoding="utf-8").read())) for f in os.listdir(PUBLISHED)}
    assert all(found.values()), found
