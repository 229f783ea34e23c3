"""Hilbert-curve sharding: documents that are alike in source, language and size lie in few shards, copies in one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, with_global_rank

#: Bits for each metadata dimension.
BITS = 5


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a cell whose integer coordinates have `bits` bits each.

    The transposition works bit by bit from the top: where a coordinate has the bit, the lower bits of the first one
    flip; else they trade places with its own. A Gray code then joins the coordinates, whose bits interleave.
    """
    n = len(axes)
    steps = F.sequence(F.lit(0), F.lit(n * (bits - 1) - 1))
    start = F.array(*[a.cast("int") for a in axes])

    def turn(x: Column, k: Column) -> Column:
        i = (k % n).cast("int")
        q = F.element_at(F.array(*[F.lit(1 << (bits - 1 - level)) for level in range(bits - 1)]), (F.floor(k / n) + 1).cast("int"))
        p = q - F.lit(1)
        own = F.get(x, i)
        trade = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(p)
        flipped = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(p)).otherwise(v))
        traded = F.transform(x, lambda v, j: F.when((j == 0) | (j == i), v.bitwiseXOR(trade)).otherwise(v))
        return F.when(own.bitwiseAND(q) != 0, flipped).otherwise(F.when(i == 0, x).otherwise(traded))

    def gray(x: Column) -> Column:
        cells = [F.get(x, F.lit(0))]
        for i in range(1, n):
            cells.append(F.get(x, F.lit(i)).bitwiseXOR(cells[-1]))
        flips = [F.when(cells[-1].bitwiseAND(1 << b) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)) for b in range(bits - 1, 0, -1)]
        t = reduce(lambda a, c: a.bitwiseXOR(c), flips)
        return F.array(*[c.bitwiseXOR(t) for c in cells])

    def interleave(x: Column) -> Column:
        places = [F.shiftleft(F.shiftright(F.get(x, F.lit(i)), b).bitwiseAND(1).cast("long"), b * n + n - 1 - i) for i in range(n) for b in range(bits)]
        return reduce(lambda a, c: a.bitwiseOR(c), places)

    return F.aggregate(steps, start, turn, lambda x: F.element_at(F.transform(F.array(gray(x)), interleave), 1))


def metadata_cells(docs: DataFrame, size: Column) -> list[Column]:
    """Source and language by hash, size on a scale of half octaves: equal values share a cell, whatever the data.

    With more than 32 sources some share a cell; that costs pruning, not results.
    """
    top = (1 << BITS) - 1

    def name(c: str) -> Column:
        value = docs[c] if c in docs.columns else F.lit(None)
        return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(top + 1)).cast("int")

    return [name("source"), name("lang"), F.least(F.greatest(F.floor(F.log2(size.cast("double")) * 2).cast("int") - 8, F.lit(0)), F.lit(top))]


def shard(docs: DataFrame, n_shards: int = 40, whole_group: float = 0.05) -> DataFrame:
    """A row for each row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert.

    Size is the UTF-8 length of the text plus 16 (null texts: 16). Equal texts are a group; it stands at the smallest
    Hilbert index of its rows (`hilbert`). Groups follow the curve, rows of a group the doc_id, and the run of bytes is
    cut into `n_shards` equal parts (law `bytes`). A group of at most `whole_group` of a part goes whole where its
    middle lies, so that copies meet in one shard; larger ones, null texts among them, are cut like the rest, row by row
    where the row's middle lies, into as few shards as their bytes need. Sizes so differ from the mean by less than one
    such group or document at each end. Slots count the rows of a shard in curve order. Rows without a doc_id come
    first in their group; repeated rows keep their own slots, an empty table gives an empty result, other columns of
    docs are ignored.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = materialize(docs.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("text_hash"), hilbert_index(metadata_cells(docs, size)).alias("hilbert")))
    total = base.agg(F.sum("size")).first()[0] or 1
    group = ["text_hash", "text_crc32", "size"]
    groups = base.groupBy(group).agg(F.min("hilbert").alias("at"), (F.count(F.lit(1)) * F.col("size")).alias("bytes"))
    groups = with_global_rank(groups, [F.col("at"), *map(F.col, group)], F.col("bytes")).select(*group, "at", "bytes", F.col("before").alias("group_before"))
    placed = base.drop("hilbert").join(groups, group)
    ranked = with_global_rank(placed, [F.col("at"), *map(F.col, group), F.col("doc_id")], F.col("size"))

    def part(before: str, own: str) -> Column:
        return F.expr(f"cast(least(((2 * {before} + {own}) * {n_shards}) div (2 * {total}), {n_shards - 1}) as int)")

    whole = F.col("bytes") <= int(total * whole_group / n_shards)
    ranked = ranked.withColumn("shard", F.when(whole, part("group_before", "bytes")).otherwise(part("before", "size")))
    starts = ranked.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return ranked.join(F.broadcast(starts), "shard").select(  # a row for each shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("at").alias("hilbert")
    )
