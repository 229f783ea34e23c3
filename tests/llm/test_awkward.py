"""Every operator over nulls, empty and long texts, repeated rows, clashing columns, and an empty table."""

import pytest

from tidemark.llm import decontamination, extraction, fingerprints, jaccard, language_model, licenses, mixing, quality, sharding, substrings


def items(spark):
    return spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven twelve"), (2, "gamma"), (3, None), (4, "!!")], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (4, 0), (8, 1), (99, 0), (3, None)], "doc_id long, quality int")


def operators(spark):
    return {
        "quality": lambda d: quality.classify(d, quality.fit(d, labels(spark))).select("doc_id", "score", "predicted"),
        "fingerprints": fingerprints.fingerprint, "sharding": sharding.shard, "mixing": mixing.mix, "substrings": substrings.deduplicate, "licenses": licenses.scan,
        "language_model": language_model.score, "jaccard": jaccard.link_documents, "decontamination": lambda d: decontamination.decontaminate(d, items(spark)),
    }


NAMES = ["quality", "fingerprints", "sharding", "mixing", "substrings", "licenses", "language_model", "jaccard", "decontamination"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_row(spark, awkward, nothing, name):
    run = operators(spark)[name]
    rows = run(awkward).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 1, 2, 3, 4, 5, 6, 7, 8]
    same = [r.asDict() for r in rows if r["doc_id"] == 1]
    assert name in ("sharding", "mixing", "fingerprints") or same[0] == same[1]
    assert run(nothing).count() == 0
    if name == "jaccard":
        comp = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
        assert comp[2] == (0, 2) and comp[3] == (0, 3) and comp[1] == (1, 1) and comp[5][1] == comp[4][1] == 4
    if name == "substrings":
        gone = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in rows}
        assert gone[5] == (3000, 3000) and gone[4] == (3000, 0) and gone[3] == (0, 0) and gone[8] == (11, 0)
    if name == "decontamination":
        hit = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in rows}
        assert hit[8] == (10, 1) and hit[1] == (1, 1) and hit[2] == hit[3] == hit[6] == (0, 0)
    if name == "mixing":
        assert all(r["taken"] <= 3 * r["size"] for r in rows) and {r["size"] for r in rows if r["doc_id"] in (2, 3, 6)} == {0}
    if name == "sharding":
        assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {16}
    if name == "fingerprints":
        assert {r["doc_id"]: r["n_chars"] for r in rows}[7] == 50 and len({r["fingerprint"] for r in rows if r["doc_id"] in (4, 5)}) == 1


def test_null_ids_are_rows_like_others(spark, awkward):
    df = spark.createDataFrame([(None, "a b c", "en", "s", 5), (1, "a b d", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, run in operators(spark).items():
        assert run(df).count() == 2, name


def test_substrings_without_an_id_come_last(spark):
    w = [f"w{i}" for i in range(60)]
    docs = [(None, ["a", *w]), (None, [*w, "b"]), (4, [*w, "c"]), (None, [f"v{i}" for i in range(30)]), (None, [f"v{i}" for i in range(30)])]
    got = substrings.deduplicate(spark.createDataFrame([(k, " ".join(t)) for k, t in docs], "doc_id long, text string")).collect()
    assert sorted((r["text"], r["n_removed"]) for r in got if r["n_words"] == 61) == [("a", 60), ("b", 60), (" ".join([*w, "c"]), 0)]
    assert [(r["doc_id"], r["n_removed"]) for r in got if r["n_words"] == 30] == [(None, 0)] * 2  # equal rows are one document
    assert all(f[1] == 60 and f[2] in (4, None) for r in got for f in r["factors"])


def test_pages(spark):
    html = "<html><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>T &amp; U</h1><p>One\n two<p>Three<br>four</article><footer>f</footer></body></html>"
    df = spark.createDataFrame([(1, "http://a/x", html, 1), (1, "http://a/x", html, 1), (2, None, None, 2), (3, "nonsense", "", 3), (4, "http://b/", "plain & simple", 4)], "page_id long, url string, html string, text int")
    rows = extraction.extract(df).collect()
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in rows)
    want = "T & U\n\nOne two\n\nThree four"
    assert got == [(1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, "", 0), (4, "plain & simple", 14)]
    assert extraction.extract(df.limit(0)).count() == 0
