"""Checks, summaries and digests of bar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.schemas import BAR_COLUMNS, BAR_CSV, BAR_KEY, PRICE

from . import timeline

NULLABLE = {"vwap"}


def constraints(columns: list[str]) -> list[tuple[str, Column]]:
    """(name, broken) of the row constraints of the bar table, for the columns at hand."""
    c = F.col
    prices = ["open", "high", "low", "close"]
    return [
        *[(f"{name.upper()}_NULL", c(name).isNull()) for name in columns if name not in NULLABLE],
        *[(f"{name.upper()}_NOT_POSITIVE", c(name) <= 0) for name in prices],
        ("VOLUME_NEGATIVE", c("volume") < 0), ("TRADE_COUNT_NEGATIVE", c("trade_count") < 0), ("NOT_FINAL", ~c("is_final")),
        ("HIGH_BELOW_OTHERS", c("high") < F.greatest("open", "low", "close")), ("LOW_ABOVE_OTHERS", c("low") > F.least("open", "high", "close")),
        *[(f"{name.upper()}_PRECISION", c(name).isNotNull() & c(name).try_cast(PRICE).isNull()) for name in [*prices, "vwap"]],
    ]


def constraint_violations(bars: DataFrame) -> DataFrame:
    """Bars that break a constraint, with the names of all that they break."""
    columns = [x for x in [*BAR_COLUMNS, "spark_batch_id"] if x in bars.columns]
    named = F.filter(F.array(*[F.when(broken, F.lit(name)) for name, broken in constraints(columns)]), lambda x: x.isNotNull())
    return bars.withColumn("violations", named).filter(F.size("violations") > 0)


def duplicate_keys(bars: DataFrame) -> DataFrame:
    return bars.groupBy(*BAR_KEY).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def key_counts(bars: DataFrame) -> DataFrame:
    return bars.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(*BAR_KEY)).alias("distinct_keys"))


def summary(bars: DataFrame) -> DataFrame:
    """Rows, distinct keys, first and last bar, volume and trades of a bar table."""
    return bars.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(*BAR_KEY)).alias("distinct_keys"), F.min("bar_start").alias("first_bar"), F.max("bar_start").alias("last_bar"),
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trades"),
    )


def canonical_line(columns: list[str] | None = None) -> Column:
    """A bar as one line: fields joined by commas, booleans in lower case, times as ISO text with +00:00."""

    def said(name: str) -> Column:
        if name == "bar_start":
            return F.concat(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return F.concat_ws(",", *[said(name) for name in columns or BAR_CSV.fieldNames()])


def digest(bars: DataFrame, *by: str) -> DataFrame:
    """Rows and SHA-256 over the ordered canonical lines of each group: for result sets that fit in memory, such as a
    day of one series. For large tables use `unordered_digest`."""
    lines = bars.select(*by, F.struct("bar_start", "symbol", "source", "feed", canonical_line().alias("line")).alias("x"))
    ordered = F.transform(F.sort_array(F.collect_list("x")), lambda x: x["line"])
    return lines.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.array_join(ordered, "\n").cast("binary"), 256).alias("sha256"))


def tree_digest(bars: DataFrame, *by: str, block: int = 4096) -> DataFrame:
    """Rows and a SHA-256 over the ordered canonical lines of each group, of any size.

    Lines are cut into runs of `block` by their place in the order; each run has a digest over its lines, and runs of
    digests have digests in turn until one is left. No string is longer than `block` lines, and the digest doesn't depend
    on how rows are dealt out. Groups of one run have the digest of `digest`.
    """
    order = ["bar_start", "symbol", "source", "feed", "line"]
    lines = bars.select(*[F.col(c).alias(f"by_{c}") for c in by], *order[:4], canonical_line().alias("line"), F.lit(1).cast("long").alias("one"))
    key = [f"by_{c}" for c in by]
    ranked = timeline.running(timeline.in_ranges(lines, key, order), key, order, sums=["one"])
    level = ranked.select(*key, (F.col("sum_one") - 1).alias("place"), "line", "one")
    most, rows = None, "one"
    while most is None or most > 0:
        run = F.floor(F.col("place") / block)
        listed = F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"])
        told = level.groupBy(*key, run.alias("run")).agg(F.sha2(F.array_join(listed, "\n").cast("binary"), 256).alias("line"), F.sum(rows).alias("rows"))
        level, rows = timeline.written(told.withColumnRenamed("run", "place")), "rows"
        most = level.agg(F.max("place")).first()[0] or 0
    return level.select(*[F.col(k).alias(c) for k, c in zip(key, by)], "rows", F.col("line").alias("sha256"))


def digest_matches(bars: DataFrame, expected_sha256: str | None, *by: str) -> DataFrame:
    """digest() with `matches`: whether it is the expected one; null if none is expected."""
    return digest(bars, *by).withColumn("matches", F.col("sha256") == F.lit(expected_sha256).cast("string"))


def unordered_digest(bars: DataFrame) -> DataFrame:
    """Rows and an order-free checksum, in one pass over any size."""
    return bars.select(F.xxhash64(canonical_line()).cast("decimal(20,0)").alias("h")).agg(F.count(F.lit(1)).alias("rows"), F.sum("h").cast("string").alias("checksum"))


def export_manifest(bars: DataFrame) -> DataFrame:
    """What an ordered export holds: rows, first and last bar, fields."""
    return bars.agg(F.count(F.lit(1)).alias("rows"), F.min("bar_start").alias("first_bar"), F.max("bar_start").alias("last_bar")).withColumn("fields", F.lit(",".join(BAR_CSV.fieldNames())))
