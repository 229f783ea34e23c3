"""What a batch packs at once doesn't decide what is linked."""

from tidemark.llm import jaccard


def test_postings_are_packed_in_parts(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = sorted(map(tuple, jaccard.link_documents(docs).collect()))
    monkeypatch.setattr(jaccard, "POSTS", 300)
    assert sorted(map(tuple, jaccard.link_documents(docs).collect())) == whole
