"""What the training-data operators share: tables, hand-over files, distributed ranks, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: White space of the word contracts: U+0020 and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def within_bytes(df: DataFrame, limit: int) -> bool:
    """Whether the rows, written out, have `limit` bytes at most: how what may be broadcast is measured."""
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0) <= limit


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """left joined with right, which has every key of left once and in `count` how many rows of left have it.

    Keys with over a quarter of an even partition's rows get their row of right by broadcast: they are fewer than four
    times the shuffle partitions, whatever the data. All others are shuffled, so a key with a third of all rows stays
    dealt out as it was. No key is null. `count` goes.
    """
    hot = F.col(count) > (right.agg(F.sum(count)).first()[0] or 0) / (4 * partitions(left.sparkSession))
    few = right.filter(hot).drop(count)
    rest = left.join(F.broadcast(few.select(keys)), keys, "left_anti").join(right.filter(~hot).drop(count), keys)
    return left.join(F.broadcast(few), keys).unionByName(rest)


def with_global_rank(df: DataFrame, order: list[Column], size: Column | None = None) -> DataFrame:
    """df with `rank` (0-based place in the global order) and `before` (sum of `size` over the rows ahead).

    Rows are dealt out by range, numbered inside each range, and shifted by the totals of the ranges ahead. The totals
    are one row for each range, so that no task sees more than its own range. `order` must tell all rows apart for
    equal reruns; rows equal in every key are interchangeable.
    """
    spark = df.sparkSession
    size = F.lit(0).cast("long") if size is None else size
    keys = [f"__k{i}" for i in range(len(order))]
    placed = materialize(
        df.select("*", size.alias("__size"), *[c.alias(k) for c, k in zip(order, keys)])
        .repartitionByRange(partitions(spark), *keys)
        .withColumn("__part", F.spark_partition_id())
    )
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("s"))
        .select(
            "__part",
            F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__n0"),
            F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("__s0"),
        )
    )
    inside = Window.partitionBy("__part").orderBy(*keys)
    return (
        placed.withColumn("__n", F.row_number().over(inside))
        .withColumn("__s", F.sum("__size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(F.broadcast(shifts), "__part")  # a row for each shuffle partition
        .select(*df.columns, (F.col("__n0") + F.col("__n") - 1).alias("rank"), (F.col("__s0") + F.col("__s") - F.col("__size")).alias("before"))
    )


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers; never null."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def n_words(text: Column) -> Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, use) -> Column:
    """use(value) with `value` worked out once, however often and however deep in lambdas `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def most_frequent(counted: DataFrame, count: str, limit: int, least: int) -> DataFrame:
    """The rows with the largest `count`, at most `limit` of them and none under `least`.

    A histogram over the counts (a row for each sixteenth of an octave) tells from where on all rows are taken, so no
    task orders all of them.
    """
    step = F.floor(F.log2(F.col(count).cast("double")) * 16)
    bins = counted.filter(F.col(count) >= least).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min(count).alias("from")).collect()  # a thousand rows at most
    start, room = None, limit
    for b in sorted(bins, key=lambda b: -b["step"]):
        room -= b["n"]
        if room < 0:
            break
        start = b["from"]
    return counted.filter(F.col(count) >= start) if start is not None else counted.limit(0)
