"""Percentiles from sketches that merge: kept by batch, put together over batches and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items that a sketch keeps in its lowest level; its size grows with the logarithm of the rows.
SIZE = 400


def rank_error(size: int = SIZE) -> float:
    """By how much a share may be off, at 99 % confidence: the quantile of 0.95 stands within 0.95 +- this."""
    return 2.296 / size**0.9723


def sketched(values: DataFrame, by: list[str], value: str, size: int = SIZE) -> DataFrame:
    """A row for each group with the sketch of a numeric column, nulls left out; groups without values have none.

    Rows of a task are sketched before the shuffle, so a group of any size is a sketch for each task.
    """
    return values.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of batches, or of finer groups, as one for each group."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def told(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Number of values and a column for each of `shares` in place of the sketch."""
    found: list[Column] = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias(name) for name, s in shares.items()]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.kll_sketch_get_n_double("sketch").alias("events"), *found)


class SketchLog:
    """Sketches of a stream by batch. A batch overwrites only its own folder, so a retry leaves one copy."""

    def __init__(self, spark, path: str, by: list[str], value: str, size: int = SIZE) -> None:
        self.spark, self.path, self.by, self.value, self.size = spark, path.rstrip("/"), by, value, size

    def write_batch(self, batch: DataFrame, number: int) -> None:
        sketched(batch, self.by, self.value, self.size).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def read(self, by: list[str] | None = None) -> DataFrame:
        """The sketches of all batches together, by the log's groups or by fewer columns."""
        return merged(self.spark.read.parquet(self.path), self.by if by is None else by)
