"""Running values along time lines of any length.

Rows are dealt out by ranges of (key, order), so a key of nine tenths of all rows lies in nine tenths of the ranges. A
running value is worked out inside each range; what the ranges ahead come to is a row for each range and key, and is
added afterwards. No task sees a whole key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

RANGE, TIE = "__range", "__tie"


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what depends on how rows were dealt out must not be worked out twice."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_ranges(rows: DataFrame, by: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """rows as a written table with their range; rows alike in key and order are told apart by a hash of the row, so
    that a moment of many rows is split as well."""
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = rows.withColumn(TIE, F.xxhash64(*rows.columns))
    return written(tie.repartitionByRange(n, *by, *order, TIE).withColumn(RANGE, F.spark_partition_id()))


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & left[c].eqNullSafe(right[f"__of_{c}"])
    return same


def running(placed: DataFrame, by: list[str], order: list[str], sums: list[str] = (), lasts: list[str] = (), nexts: list[str] = (), maxima: list[str] = ()) -> DataFrame:
    """Rows of in_ranges() with sum_<c>, last_<c>, max_<c> over the rows of the key up to each row, itself included,
    and next_<c> over those from it on; last and next pass over nulls."""
    place = F.struct(*order, TIE)
    ahead, back = [*order, TIE], [F.col(c).desc() for c in (*order, TIE)]
    own = Window.partitionBy(RANGE, *by)
    upto = own.orderBy(*ahead).rowsBetween(Window.unboundedPreceding, 0)
    # turned round, since a frame that ends at the end of its partition is worked out anew for each row
    onward = own.orderBy(*back).rowsBetween(Window.unboundedPreceding, 0)

    inside = {f"sum_{c}": F.sum(c).over(upto) for c in sums} | {f"max_{c}": F.max(c).over(upto) for c in maxima}
    inside |= {f"last_{c}": F.last(c, ignorenulls=True).over(upto) for c in lasts} | {f"next_{c}": F.last(c, ignorenulls=True).over(onward) for c in nexts}
    known = {c: F.when(F.col(c).isNotNull(), place) for c in (*lasts, *nexts)}
    whole = [F.sum(c).alias(f"sum_{c}") for c in sums] + [F.max(c).alias(f"max_{c}") for c in maxima]
    whole += [F.max_by(c, known[c]).alias(f"last_{c}") for c in lasts] + [F.min_by(c, known[c]).alias(f"next_{c}") for c in nexts]
    per_range = placed.groupBy(RANGE, *by).agg(*whole)

    key = Window.partitionBy(*by)
    before = key.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range and key
    behind = key.orderBy(F.col(RANGE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"sum_{c}": F.sum(f"sum_{c}").over(before) for c in sums} | {f"max_{c}": F.max(f"max_{c}").over(before) for c in maxima}
    carried |= {f"last_{c}": F.last(f"last_{c}", ignorenulls=True).over(before) for c in lasts} | {f"next_{c}": F.last(f"next_{c}", ignorenulls=True).over(behind) for c in nexts}
    others = per_range.select(*[F.col(c).alias(f"__of_{c}") for c in (RANGE, *by)], *[v.alias(f"__{n}") for n, v in carried.items()])

    def both(name: str) -> Column:
        if name.startswith("sum_"):
            return F.when(F.col(name).isNull(), F.col(f"__{name}")).otherwise(F.col(name) + F.coalesce(f"__{name}", F.lit(0)))
        return F.greatest(name, f"__{name}") if name.startswith("max_") else F.coalesce(name, f"__{name}")

    met = placed.withColumns(inside)
    met = met.join(others, _same(met, others, [RANGE, *by]), "left")
    return met.select(*[c for c in placed.columns if c not in (RANGE, TIE)], *[both(n).alias(n) for n in inside])
