"""The join that broadcasts the rows of hot keys."""

from pyspark.sql import functions as F

from tidemark.llm.common import join_counted, materialize


def counted(left):
    return materialize(left.groupBy("k", "m").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("rows")))


def test_equals_the_plain_join(spark):
    left = materialize(spark.range(6_000).selectExpr("id", "if(id % 3 = 0, 0, id % 700) k", "cast(id % 3 = 0 as string) m"))
    right = counted(left)
    got = join_counted(left, right, ["k", "m"], "rows")
    want = left.join(right.drop("rows"), ["k", "m"])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 6_000


def test_only_a_bounded_number_of_keys_is_broadcast(spark):
    """A key with nine tenths of the rows stays dealt out over the tasks that read it."""
    left = materialize(spark.range(40_000).selectExpr("id", "if(id % 10 > 0, -1, id) k", "'x' m"))
    right = counted(left)
    bound = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    threshold = 40_000 / bound
    assert right.filter(F.col("rows") > threshold).count() == 1
    joined = join_counted(left, right, ["k", "m"], "rows").withColumn("task", F.spark_partition_id())
    assert joined.filter("k >= 0").count() == 4_000
    tasks = [r["count"] for r in joined.filter("k = -1").groupBy("task").count().collect()]
    assert sum(tasks) == 36_000 and max(tasks) <= 36_000 / 4


def test_no_rows(spark):
    left = spark.range(0).selectExpr("id", "id k", "'x' m")
    assert join_counted(left, counted(left), ["k", "m"], "rows").collect() == []
