"""The Jaccard join on lists that very many sets share, and on rows without an id."""

import random

from pyspark.sql import functions as F

from tests.llm.test_results import brute_components
from tidemark.llm import jaccard


def test_a_hot_list_without_links(spark):
    n = 32_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("concat('a b c d e f g h i j x', id, ' y', id)").alias("text"))
    rows = jaccard.link_documents(docs).filter("doc_id != component_id or n_shingles != 8").count()
    assert rows == 0


def test_two_groups_of_copies_in_one_list(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage, groups, docs = [word() for _ in range(12)], [[word() for _ in range(30)] for _ in range(3)], []
    for i in range(150):
        w = [*passage, *groups[i % 3]]
        for _ in range(rng.randrange(4)):
            w[12 + rng.randrange(30)] = word()
        docs.append((i, " ".join(w[: rng.randrange(36, 43)])))
    docs += [(500 + i, " ".join([*passage, *(word() for _ in range(rng.randrange(1, 9)))])) for i in range(60)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_components(docs)


def test_many_groups_of_near_copies_in_one_list(spark):
    rng = random.Random(31)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage, groups, docs = [word() for _ in range(8)], [[word() for _ in range(34)] for _ in range(12)], []
    for i in range(240):
        w = [*passage, *groups[i % 12]]
        for _ in range(rng.randrange(3)):
            w[8 + rng.randrange(34)] = word()
        docs.append((i, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_components(docs)


def test_rows_without_an_id_link_others(spark):
    w = [f"w{i}" for i in range(60)]
    chain = [(None, w), (5, [*w[:52]]), (3, [*w, *(f"v{i}" for i in range(8))]), (None, w), (9, w[30:]), (None, [f"u{i}" for i in range(40)]), (None, [f"u{i}" for i in range(38)])]
    df = spark.createDataFrame([(k, " ".join(x)) for k, x in chain], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_copies"]) for r in jaccard.link_documents(df).collect()), key=str)
    assert got == sorted([(None, 56, 3, 2), (None, 56, 3, 2), (5, 48, 3, 1), (3, 64, 3, 1), (9, 26, 9, 1), (None, 36, None, 1), (None, 34, None, 1)], key=str)


def test_texts_that_share_an_id(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(7, w), (7, [f"u{i}" for i in range(40)]), (5, [*w[:58]]), (9, [f"u{i}" for i in range(42)]), (7, w)]
    df = spark.createDataFrame([(k, " ".join(x)) for k, x in rows], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(df).collect())
    assert got == sorted([(7, 56, 5), (7, 56, 5), (5, 54, 5), (7, 36, 7), (9, 38, 7)])
