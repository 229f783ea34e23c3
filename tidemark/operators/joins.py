"""Joins on time: as-of and interval, both by way of equality so that Spark can shuffle and split them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import timeline


def as_of(points: DataFrame, facts: DataFrame, by: list[str], point_time: str, fact_time: str, columns: list[str], ranges: int | None = None) -> DataFrame:
    """points with the `columns` of the latest fact of the same key at or before their time; null if there is none.

    Both sides are put on one time line, which is cut into ranges; the last fact of each range is carried over to those
    behind it. Of facts at one time the largest by `columns` counts; facts without a time are never known, points without
    one know none. Null keys are equal. The keys' names must not clash otherwise.
    """
    kind = facts.select(F.struct(*columns).alias("x")).schema["x"].dataType
    fact = facts.filter(F.col(fact_time).isNotNull()).select(*by, F.col(fact_time).alias("__time"), F.lit(0).alias("__side"), F.struct(*columns).alias("__fact"), F.lit(None).cast(points.schema.simpleString()).alias("__point"))
    point = points.select(*by, F.col(point_time).alias("__time"), F.lit(1).alias("__side"), F.lit(None).cast(kind).alias("__fact"), F.struct(*points.columns).alias("__point"))
    order = ["__time", "__side", "__fact"]
    line = timeline.running(timeline.in_ranges(fact.unionByName(point), by, order, ranges), by, order, lasts=["__fact"])
    return line.filter("__side = 1").select("__point.*", *[F.col(f"last___fact.{c}").alias(c) for c in columns])


def within(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, before: int, after: int, cell: int | None = None) -> DataFrame:
    """Pairs of equal keys with left_time - before <= right_time < left_time + after, in seconds.

    Time is cut into cells as wide as the interval; a left row is asked of the two or three cells that it reaches, so
    the join is on equality and no key is compared over all time.
    """
    cell = cell or max(1, before + after)
    start, end = (F.unix_micros(left_time) - before * 1_000_000), (F.unix_micros(left_time) + after * 1_000_000)
    width = cell * 1_000_000
    asked = left.withColumn("__start", start).withColumn("__end", end).withColumn("__cell", F.explode(F.sequence(F.floor(F.col("__start") / width), F.floor((F.col("__end") - 1) / width))))
    there = right.withColumn("__at", F.unix_micros(right_time)).withColumn("__cell", F.floor(F.col("__at") / width))
    return asked.join(there, [*by, "__cell"]).filter((F.col("__at") >= F.col("__start")) & (F.col("__at") < F.col("__end"))).drop("__cell", "__start", "__end", "__at")


def without_near(df: DataFrame, events: DataFrame, by: list[str], time: str, event_time: str, before: int, after: int) -> DataFrame:
    """Rows of df that no event of their key is near: those outside [event - before, event + after).

    Events near a row lie behind its time - after and not behind its time + before. Time is cut into cells as wide as
    that; it begins in one cell and ends in the next, so one lies there if the last event of the first cell does or the
    first event of the next one. A cell is a row, however many events it has, and a row of df meets one.
    """
    width = (before + after) * 1_000_000
    if width <= 0:
        return df
    cell = lambda at: at - F.pmod(at, F.lit(width))
    at, none = F.unix_micros(event_time), F.lit(None).cast("long")
    roles = F.array(F.struct(cell(at).alias("cell"), at.alias("last"), none.alias("first")), F.struct((cell(at) - width).alias("cell"), none.alias("last"), at.alias("first")))
    told = events.select(*by, F.explode(roles).alias("r")).groupBy(*by, F.col("r.cell").alias("__cell")).agg(F.max("r.last").alias("__last"), F.min("r.first").alias("__first"))
    start = F.unix_micros(time) - after * 1_000_000
    near = (F.col("__last") > start) | (F.col("__first") <= start + width)
    return df.withColumn("__cell", cell(start)).join(told, [*by, "__cell"], "left").filter(~F.coalesce(near, F.lit(False))).select(*df.columns)


def seconds(time: str) -> Column:
    return F.unix_micros(time) / 1_000_000
