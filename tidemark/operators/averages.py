"""Exponential averages over the whole history of a series, as a scan of affine maps.

A bar turns the average y into a y + (1 - a) close. Maps of that form compose, so they are put together inside blocks of
rows, over the blocks of a range and over the ranges of a series; what stands at the beginning of a block is then known
without any task having seen the series.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import timeline
from .features import SERIES
from .timeline import RANGE, TIE


def _fold(maps: Column, start: Column) -> Column:
    """What the maps (a, b), one after another, make of a number."""
    return F.aggregate(maps, start, lambda y, m: m["a"] * y + m["b"])


def _starts(maps: str, start: Column) -> Column:
    """The number that stands before each of the maps."""
    return F.transform(F.sequence(F.lit(0), F.size(maps) - 1), lambda i: _fold(F.slice(maps, 1, i), start))


def whole_averages(bars: DataFrame, lengths: dict[str, int], value: str = "close", ranges: int | None = None) -> DataFrame:
    """bars with a column for each of `lengths`: the exponential average of weight 2 / (n + 1) since the first bar of
    the series, which it starts from. The same as the recurrence, up to rounding."""
    columns = bars.columns
    placed = timeline.in_ranges(bars, SERIES, ["bar_start"], ranges)
    own = Window.partitionBy(RANGE, *SERIES).orderBy("bar_start", TIE)
    placed = placed.withColumn("__x", F.col(value).cast("double")).withColumn("__pos", F.row_number().over(own) - 1)
    for name, n in lengths.items():
        placed = _averaged(placed, name, n)
    return placed.select(*columns, *lengths)


def _averaged(rows: DataFrame, name: str, n: int) -> DataFrame:
    a = 1 - 2.0 / (n + 1)
    if a <= 0:
        return rows.withColumn(name, F.col("__x"))
    block = max(1, min(1024, int(600 / -math.log2(a))))  # powers of a stay within a double's reach
    key = [RANGE, *SERIES]
    at, j = F.floor(F.col("__pos") / block), F.col("__pos") % block
    rows = rows.withColumn("__block", at).withColumn("__j", j.cast("double"))
    inside = Window.partitionBy(*key, "__block").orderBy("__j").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__z", (1 - a) * F.pow(F.lit(a), F.col("__j")) * F.sum(F.col("__x") * F.pow(F.lit(a), -F.col("__j"))).over(inside))
    step = F.struct(F.pow(F.lit(a), F.max("__j") + 1).alias("a"), F.max_by("__z", "__j").alias("b"))
    blocks = rows.groupBy(*key, "__block").agg(step.alias("map"), F.min_by("__x", "__j").alias("first"))
    listed = F.sort_array(F.collect_list(F.struct("__block", "map")))  # a block for each 1,024 rows of a range, or somewhat more
    per_range = blocks.groupBy(*key).agg(F.transform(listed, lambda x: x["map"]).alias("maps"), F.min_by("first", "__block").alias("first"))
    whole = F.struct(F.aggregate("maps", F.lit(1.0), lambda y, m: m["a"] * y).alias("a"), _fold(F.col("maps"), F.lit(0.0)).alias("b"))
    per_series = per_range.groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct(RANGE, whole.alias("map"), "first"))).alias("ranges"))  # a row for each range
    per_series = per_series.withColumn("maps", F.transform("ranges", lambda x: x["map"])).withColumn("starts", _starts("maps", F.col("ranges")[0]["first"]))
    began = per_series.select(*SERIES, F.explode(F.arrays_zip(F.col(f"ranges.{RANGE}").alias(RANGE), F.col("starts"))).alias("r")).select(*SERIES, F.col(f"r.{RANGE}").alias(RANGE), F.col("r.starts").alias("start"))
    starts = per_range.join(began, key).select(*key, F.posexplode(_starts("maps", F.col("start"))).alias("__block", "__start"))
    return rows.join(starts, [*key, "__block"]).withColumn(name, F.pow(F.lit(a), F.col("__j") + 1) * F.col("__start") + F.col("__z")).drop("__block", "__j", "__z", "__start")
