"""Mixing sources to target weights along a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, n_words, with_global_rank

#: Fractional part of the golden ratio: its multiples fill the unit interval evenly.
GOLDEN = 0.6180339887498949
#: A slot's number is split at 2^25 and both parts are multiplied on their own, so that points keep nine digits at any
#: number of slots; this is the fractional part of 2^25 times the golden ratio.
SPLIT, GOLDEN_HIGH = 1 << 25, (((isqrt(5 << 200) - (1 << 100)) << 24) % (1 << 100)) / (1 << 100)
#: Words of a block at most.
BLOCK = 32
#: Cells of the unit interval by which points find their source.
CELLS = 1024


def targets(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeat: float = 3.0) -> DataFrame:
    """source, source_size -> with `idx` (place by code point, null last) and `target`.

    Targets share the sum of all sizes by weight; a target stops at `max_repeat` times its source's size and the excess
    is shared again by weight among the rest. That ends at the level where target = min(cap, weight * level), which
    the loop reaches from below; each turn is one aggregate over the sources, and a turn without a new cap ends it.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranked = with_global_rank(sources, order).drop("before").withColumnRenamed("rank", "idx")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeat))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        stopped = F.col("cap") <= F.col("weight") * level
        got = ranked.agg(F.sum(F.when(stopped, F.col("cap")).otherwise(0.0)).alias("fixed"), F.sum(F.when(~stopped, F.col("weight"))).alias("free")).first()
        before, level = level, (total - got["fixed"]) / got["free"] if got["free"] else level
    return ranked.withColumn("target", F.least("cap", F.col("weight") * level)).drop("weight", "cap")


def point(slot: Column) -> Column:
    """frac(slot * golden ratio)."""
    u = F.floor(slot / SPLIT) * GOLDEN_HIGH + (slot % SPLIT) * GOLDEN
    return u - F.floor(u)


def schedule(parts: DataFrame) -> DataFrame:
    """idx, need (blocks that a source should give; any real number) -> slot, idx, rank: the slots of each source.

    There are as many slots as all needs together. A slot goes to the source in whose part of the cumulative needs its
    point falls; `rank` numbers a source's slots in their order, from 0. Golden-ratio points leave every part, and every
    run of slots of a source, within a few slots of its share.
    """
    spark = parts.sparkSession
    parts = parts.select("idx", F.round(F.col("need") * 1024).cast("long").alias("need")).filter("need > 0")  # sums of whole numbers are equal in every run
    laid = materialize(with_global_rank(parts, [F.col("idx")], F.col("need")).select("idx", F.col("before").alias("low"), (F.col("before") + F.col("need")).alias("high")))
    total = laid.agg(F.max("high")).first()[0] or 0
    bounds = laid.select("idx", (F.col("low") / total).alias("low"), (F.col("high") / total).alias("high"))
    cells = bounds.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))))
    points = spark.range(-(-total // 1024)).select(F.col("id").alias("slot"), point(F.col("id")).alias("u")).withColumn("cell", F.floor(F.col("u") * CELLS))
    slots = points.join(cells, "cell").filter("u >= low and u < high").select("idx", "slot")
    ranked = materialize(with_global_rank(slots, [F.col("idx"), F.col("slot")]).select("idx", "slot", "rank"))
    first = ranked.groupBy("idx").agg(F.min("rank").alias("first"))  # a row for each source
    return ranked.join(first, "idx").select("slot", "idx", (F.col("rank") - F.col("first")).alias("rank"))


def block_of(word: Column) -> Column:
    """The block in which a word of a source's stream lies: the first `longer` blocks have a word more than `length`."""
    long_part = F.col("longer") * (F.col("length") + 1)
    return F.when(word < long_part, F.floor(word / (F.col("length") + 1))).otherwise(F.col("longer") + F.floor((word - long_part) / F.greatest("length", F.lit(1))))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeat: int = 3, block_words: int = BLOCK, seed: int = 17) -> DataFrame:
    """A row for each row of docs: doc_id, size, source_size, target, taken (words that the mix takes of it).

    Each source's documents are shuffled by a hash of doc_id and laid end to end, and the stream is cut into equal
    blocks of at most `block_words` words (lengths differ by one). A source needs its target over its block length; the
    slots that the schedule gives it take its blocks in turn, so that a document is taken whole once before any part is
    taken twice, and none more than `max_repeat` times. What a source gives is what its slots take: it differs from the
    target by the schedule's discrepancy, a few blocks, whatever the sizes. No source or document needs to fit into a
    task. Null texts and documents without words have size 0 and are taken 0 times; a null source is a source; rows
    with equal ids, or none, are rows of their own; an empty table gives an empty result; other columns are ignored.
    """
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    sources = targets(sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), weights, float(max_repeat))
    plan = sources.withColumn("n_blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}"))
    plan = plan.withColumn("length", F.expr("case when n_blocks > 0 then source_size div n_blocks else 0L end")).withColumn("longer", F.expr("source_size - length * n_blocks"))
    plan = materialize(plan)
    slots = schedule(plan.select("idx", F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0).alias("need")))
    taken = slots.join(plan.select("idx", "n_blocks"), "idx").filter(F.col("rank") < F.col("n_blocks") * max_repeat)
    taken = taken.groupBy("idx", F.expr("rank % n_blocks").alias("block")).agg(F.count(F.lit(1)).alias("times"))

    named = sized.join(F.broadcast(plan) if plan.count() <= 10_000 else plan, sized["source"].eqNullSafe(plan["source"])).select("doc_id", "size", "idx", "source_size", "target", "length", "longer")
    streams = with_global_rank(named, [F.col("idx"), F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id"), F.col("size")], F.col("size"))
    starts = with_global_rank(plan.select("idx", "source_size"), [F.col("idx")], F.col("source_size")).select("idx", F.col("before").alias("base"))
    laid = materialize(streams.join(starts, "idx").withColumn("start", F.col("before") - F.col("base")).withColumn("end", F.col("start") + F.col("size")))
    pieces = laid.filter("size > 0").withColumn("block", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("end") - 1))))
    at = F.col("block") * F.col("length") + F.least("block", "longer")
    after = at + F.col("length") + F.when(F.col("block") < F.col("longer"), 1).otherwise(0)
    pieces = pieces.select("rank", "idx", "block", (F.least("end", after) - F.greatest("start", at)).alias("words"))
    sums = pieces.join(taken, ["idx", "block"]).groupBy("rank").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return laid.join(sums, "rank", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
