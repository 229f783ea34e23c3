"""The pipeline's stages on rows without an id, with the same id, repeated, empty, long or with more columns."""

import random
from collections import Counter

import pytest

import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double"


def rows_of(df):
    assert df.columns == pipeline.COLUMNS
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with labels and a benchmark."""
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"leak{i}" for i in range(12))), (2, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(9)
    return lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark, prose):
    near = prose(60)
    leak = prose(5) + " " + " ".join(f"leak{i}" for i in range(11))
    rows = [
        (7, prose(30), "en", "a"), (7, prose(30), "en", "a"), (None, prose(30), None, None), (None, None, None, None), (8, "", "en", "b"), (9, None, "en", "b"),
        (4, near, "en", "a"), (3, near + " x", "de", "b"), (None, near, "en", "c"), (5, leak, "en", "a"), (5, prose(40), "en", "a"), (None, leak, "en", "b"), (None, prose(9), "en", "b"),
        (6, prose(20_000), "fr", "c"),
    ]
    rows += [rows[-1]] * 2 + [(None, "same row", "en", "c")] * 3
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 0.5) for r in rows], SCHEMA).repartition(3).persist()


def test_quality_keeps_rows_as_they_are(spark, docs, folder):
    kept, given = rows_of(pipeline.keep_quality(spark, docs, folder)), rows_of(docs.select(pipeline.COLUMNS))
    assert kept and all(given[r] == n for r, n in kept.items())


def test_one_of_each_group(spark, docs, folder):
    given = rows_of(docs.select(pipeline.COLUMNS))
    near = {r for r in given if (r[1] or "").startswith(next(x[1] for x in given if x[0] == 4))}
    leaks = {r for r in given if "leak" in (r[1] or "")}
    gone = {r for r in near if r[0] != 3} | {r for r in leaks if r[0] is None}
    assert len(near) == 3 and len(leaks) == 2
    assert rows_of(pipeline.keep_one_of_each_group(spark, docs, folder)) == Counter(set(given) - gone)


def test_only_texts_with_a_hit_go(spark, docs, folder):
    given = rows_of(docs.select(pipeline.COLUMNS))
    want = Counter({r: n for r, n in given.items() if "leak" not in (r[1] or "")})
    assert rows_of(pipeline.drop_contaminated(spark, docs, folder)) == want


def test_the_mix_repeats_rows_as_often_as_it_takes_them(spark, docs, folder, prose):
    got, given = rows_of(pipeline.mix_sources(spark, docs, folder)), rows_of(docs.select(pipeline.COLUMNS))
    assert set(got) <= set(given) and all((r[1] or "").strip() and n <= 3 * given[r] for r, n in got.items())
    row = (1, prose(40), "en", "a", 5, "x", 0.5)
    assert rows_of(pipeline.mix_sources(spark, spark.createDataFrame([row] * 3, SCHEMA), folder)) == {row[:5]: 3}


def test_shards_have_all_rows(spark, docs, folder):
    out = pipeline.cut_shards(spark, docs, folder)
    assert out.count() == docs.count() and out.filter("shard is null or slot is null").count() == 0


def test_empty_tables_run_through(spark, docs, folder):
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
