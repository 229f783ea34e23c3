"""The corpus pipeline: quality, near duplicates, contamination, mixture, shards."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, jaccard, mixing, quality, sharding
from tidemark.llm.common import shared_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def row_name() -> Column:
    """Name of a row by all that it holds: equal for equal rows, and there where a doc_id is null or stands twice."""
    return F.xxhash64(*COLUMNS, *[F.isnull(c) for c in COLUMNS])


def named(docs: DataFrame) -> DataFrame:
    """docs with the row's name in place of doc_id, for operators that give results by doc_id."""
    return docs.select(row_name().alias("doc_id"), "text", "source")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject.

    Every row is judged by its text; null and empty texts have a score as well, null ids and repeated rows change
    nothing. Without labels of both kinds all texts have one score. An empty table stays empty, more columns go.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs.select(COLUMNS), model).filter("predicted = 1").select(COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row with the smallest doc_id.

    A row without a doc_id stays only if none of its component has one; of several with the same doc_id one stays.
    Unlike texts stay, whatever their ids. Texts without words, null ones too, are near nothing and stay. Rows equal in
    all columns count as one. An empty table stays empty, more columns go.
    """
    names = docs.select(row_name().alias("row"), "doc_id").distinct()
    linked = jaccard.link_documents(named(docs)).select(F.col("doc_id").alias("row"), "component_id").distinct()
    first = linked.join(names, "row").groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("first"))
    kept = docs.select(COLUMNS).withColumn("row", row_name()).join(first.select(F.col("first.row").alias("row")), "row", "left_semi")
    return kept.dropDuplicates(["row"]).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    A hit drops the rows with that text, not others that share the doc_id or have none. Null and empty texts stay,
    repeated rows stay or go together; without items all stay. An empty table stays empty, more columns go.
    """
    found = decontamination.decontaminate(named(docs), table(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("doc_id").alias("row")).distinct()
    return docs.select(COLUMNS).withColumn("row", row_name()).join(found, "row", "left_anti").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: whole passes, and once more if it takes half or more of the next.

    Documents without words, null texts too, aren't taken. Rows equal in all columns are taken as often as all of them
    together. A null source is a source, null ids change nothing. An empty table stays empty, more columns go.
    """
    times = F.expr("case when size = 0 then 0 else (2 * taken + size) div (2 * size) end")
    taken = mixing.mix(named(docs)).groupBy(F.col("doc_id").alias("row")).agg(F.sum(times).cast("int").alias("times"), F.count(F.lit(1)).alias("rows")).filter("times > 0")
    met = docs.select(COLUMNS).withColumn("row", row_name()).join(taken, "row")
    once = met.filter("rows = 1").unionByName(met.filter("rows > 1").dropDuplicates(["row"]))
    return once.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select(COLUMNS)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every row in 40 shards of near equal bytes.

    A row for each row, whatever its id or text; null texts have the size 16. An empty table stays empty.
    """
    return sharding.shard(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot")


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("sharding", cut_shards),
]

#: The classifier and the components can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
