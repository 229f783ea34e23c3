"""Merkle-tree fingerprints: roots tell whether texts are equal, differing branches where they differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, partitions

#: Code points of a leaf at most, and hex digits of a leaf's digest in the fingerprint.
LEAF, DIGITS = 40, 8


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def tree(text: Column) -> Column:
    """The tree of a text: sections (ended by blank lines) of paragraphs (lines) of leaves (runs of 40 code points).

    As a string: the root in 64 hex digits, then for each section `/`, for each paragraph `.` and its leaves' shortened
    digests. An inner node is the digest of its children's digests in order; leaves enter whole, so that roots of
    different texts differ. A text without leaves has one empty section.
    """

    def paragraph(line: Column) -> Column:
        leaves = F.transform(F.regexp_extract_all(line, F.lit(f"(?s).{{1,{LEAF}}}"), F.lit(0)), digest)
        return let(leaves, lambda d: F.struct(digest(F.array_join(d, "")).alias("node"), F.array_join(F.transform(d, lambda x: F.substring(x, 1, DIGITS)), "").alias("said")))

    def section(block: Column) -> Column:
        return let(F.transform(F.split(block, "\n"), paragraph), lambda ps: F.struct(digest(F.array_join(F.transform(ps, lambda p: p["node"]), ".")).alias("node"), F.concat(F.lit("."), F.array_join(F.transform(ps, lambda p: p["said"]), ".")).alias("said")))

    sections = F.transform(F.split(text, "\n\n"), section)
    return let(sections, lambda ss: F.concat(digest(F.array_join(F.transform(ss, lambda s: s["node"]), "/")), F.lit("/"), F.array_join(F.transform(ss, lambda s: s["said"]), "/")))


def leaves(fingerprint: Column) -> Column:
    """The leaves' shortened digests in order."""
    said = F.translate(F.substring(fingerprint, 65, 1 << 30), "/.", "")
    return F.regexp_extract_all(said, F.lit(f".{{{DIGITS}}}"), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots; else twice the distinct leaves that both have over the sum of both counts, under 1."""

    def dice(x: Column, y: Column) -> Column:
        return 2 * F.array_size(F.array_intersect(x, y)) / F.greatest(F.array_size(x) + F.array_size(y), F.lit(1))

    shared = let(F.array_distinct(leaves(a)), lambda x: let(F.array_distinct(leaves(b)), lambda y: dice(x, y)))
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), F.lit(1.0)).otherwise(F.least(shared, F.lit(0.999999)))


def differing_leaves(a: Column, b: Column) -> Column:
    """Places (section, paragraph, both from 0) of b whose branch a doesn't have at the same place: where the edit is.

    Sections whose text of digests agrees are skipped whole, as the tree allows.
    """
    def parts(f: Column) -> Column:
        return F.split(F.substring(f, 66, 1 << 30), "/")

    def inside(s: Column, i: Column, other: Column) -> Column:
        return let(F.split(s, r"\."), lambda ps: let(F.split(F.coalesce(F.get(other, i), F.lit("")), r"\."), lambda qs: F.filter(F.transform(ps, lambda p, j: F.when(F.get(qs, j).eqNullSafe(p), None).otherwise(F.struct(i.alias("section"), (j - 1).alias("paragraph")))), lambda x: x.isNotNull())))

    return let(parts(a), lambda xs: F.flatten(F.transform(parts(b), lambda s, i: F.when(F.get(xs, i).eqNullSafe(s), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(inside(s, i, xs)))))


def with_next(docs: DataFrame, columns: list[str], per_partition: int = 4) -> DataFrame:
    """docs with `next_<c>` for each column: the row that follows in descending doc_id, after the last the first.

    The ids are cut into ranges at quantiles; a range also gets a copy of the row that follows its last one, so that
    one shuffle brings all neighbours together and no task orders more than a range. Rows that repeat a doc_id are
    ordered by their text; null ids come last.
    """
    spark = docs.sparkSession
    n = partitions(spark) * per_partition
    ids = docs.select("doc_id").filter("doc_id is not null")
    cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000)).first()[0] or []))
    edge = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    # how many cuts are at or below the id, by halving steps
    steps = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length(), -1, -1)])
    at_or_below = F.aggregate(steps, F.lit(0), lambda low, step: F.when((low + step <= len(cuts)) & (F.get(edge, low + step - 1) <= F.col("doc_id")), low + step).otherwise(low))
    keyed = docs.withColumn("__range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at_or_below))
    # the first row of each range in the order asked for; a row for each range
    tops = keyed.groupBy("__range").agg(F.max("doc_id").alias("__top"))
    at_top = keyed.join(F.broadcast(tops.withColumnRenamed("__range", "__at")), (F.col("__range") == F.col("__at")) & F.col("doc_id").eqNullSafe(F.col("__top")))
    firsts = at_top.groupBy("__range").agg(F.max(F.struct(*[F.col(c) for c in columns])).alias("first"))
    down = Window.orderBy(F.desc("__range"))
    whole = Window.orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = firsts.select("__range", F.coalesce(F.lead("first").over(down), F.first("first").over(whole)).alias("follow"))
    inside = Window.partitionBy("__range").orderBy(F.desc_nulls_last("doc_id"), *[F.desc_nulls_last(c) for c in columns])
    led = keyed.withColumn("__lead", F.lead(F.struct(F.lit(True).alias("here"), *[F.col(c) for c in columns])).over(inside))
    joined = led.join(F.broadcast(follow), "__range")
    return joined.select(*docs.columns, *[F.when(F.col("__lead").isNotNull(), F.col(f"__lead.{c}")).otherwise(F.col(f"follow.{c}")).alias(f"next_{c}") for c in columns])


def fingerprint(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many (or all) of
    the next document's. Likeness is the share of leaves in common. Null texts count as empty; an empty text
    has a fingerprint too; a table of one row is followed by itself; other columns are ignored.
    """
    own = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pairs = with_next(own, ["text"])
    half = F.expr("char_length(text) div 2").cast("int")
    edited = F.concat(F.substring("text", 1, F.char_length("text") - half), F.substring("next_text", 1, half))
    marked = pairs.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), tree(F.col("text")).alias("fingerprint"), edited.alias("edited"), tree(F.col("next_text")).alias("next_fingerprint"))
    marked = marked.withColumn("edited_fingerprint", tree(F.col("edited")))
    return marked.select(
        "doc_id", "n_chars", digest(F.col("edited")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
