import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """documents and labels of the smallest scale, as the operators get them."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, more columns with clashing names."""
    prose = " ".join(f"w{i % 997}x{i % 13}" for i in range(3_000))
    rows = [
        (1, "alpha beta gamma", "en", "a"), (1, "alpha beta gamma", "en", "a"), (2, "", None, None), (3, None, "en", "b"), (4, prose, "de", "a"), (5, prose, "de", None), (6, " \n\t ", "fr", "b"), (7, "é" * 50, "fr", "c"),
        (8, "one two three four five six seven eight nine ten eleven", "en", "c"),
    ]
    df = spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 0.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, shard string, size int, score double")
    return df


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
