"""Licence texts in blocks and lines that are long only by what their canonical form leaves out."""

import os
import re
import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, queries


def test_licences_in_long_blocks_and_lines(spark):
    holders = "\n".join(f" * Copyright (c) {1990 + i % 30} Somebody with a rather long name, number {i} of those who hold it" for i in range(90))
    wrapped = "\n".join(f" * {line}".rstrip() for part in licenses.KNOWN[2][1].split("\n\n")[2:] for line in [*textwrap.wrap(part, 76), ""])
    block = f"/*\n * MIT License\n *\n{holders}\n *\n{wrapped}\n */"
    rule = "=" * 6_000
    longest = 4 * max(len(t) for _, t in licenses.KNOWN)
    assert len(block) > longest and len(rule) > longest and "\n\n" not in block
    docs = [
        (1, f"Some code\n\n{block}\n\nmore code"), (2, block), (3, f"one\n{rule} All rights reserved. {rule}\ntwo"), (4, f"{rule} Licensed under CC BY 4.0."),
        (5, f"{rule}\n{rule}"), (6, "All rights reserved."), (7, "All rights\n \nreserved."), (8, ""), (9, None),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = licenses.scan(df).select("doc_id", "digest", "licence", "notices", "n_notices").collect()
    got = {r["doc_id"]: (r["licence"], r["notices"], r["n_notices"]) for r in rows}
    assert got == {
        1: (None, "MIT", 1), 2: ("MIT", "MIT", 1), 3: (None, "all-rights-reserved", 1), 4: ("CC-BY-4.0", "CC-BY-4.0", 1), 5: (None, "", 0),
        6: ("all-rights-reserved", "all-rights-reserved", 1), 7: ("all-rights-reserved", "", 0), 8: (None, "", 0), 9: (None, "", 0),
    }
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar)")
    db.executemany("insert into documents values (?, ?)", docs)
    want = db.sql(queries.op7_sql()).fetchall()
    assert sorted(map(tuple, rows)) == sorted(want)


def test_whole_licence_texts(spark):
    """The texts that Debian ships, with copyright lines, other case and wrapping around."""
    folder = "/usr/share/common-licenses"
    names = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
    docs = []
    for i, name in enumerate(names):
        path = os.path.join(folder, name)
        if not os.path.exists(path):
            pytest.skip("no licence texts here")
        with open(path) as f:
            text = f.read()
        docs += [(10 * i, text), (10 * i + 1, "\n".join(f"// {line.upper()}" for line in ["Copyright (c) 2020 Some Body", *text.split("\n")])), (10 * i + 2, text + " And more.")]
    rows = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r["doc_id"]: r["licence"] for r in rows}
    for i, name in enumerate(names.values()):
        assert got[10 * i] == got[10 * i + 1] == name and got[10 * i + 2] is None


def test_canonical_forms_agree(spark):
    texts = ["", "\n\n", "A licence,\nfor SUB\nlicence\n\n\nmerchantibility", "© 2020 X\r\nsub\n\nlicence\r\n \t\r\nend. ", "a\n\n(c) b\n\nÀB\xa0c Copyright d\ne"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", licenses.canonical_units(F.col("t")).alias("c")).collect()
    for r in rows:
        blocks = re.split(r"\n[ \t\r]*\n", r["t"])
        assert r["c"]["whole"] == licenses.canonical_text(r["t"])
        assert set(r["c"]["units"]) == {licenses.canonical_text(u) for u in [*blocks, *r["t"].split("\n")]} - {""}
