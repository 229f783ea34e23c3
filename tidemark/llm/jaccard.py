"""Jaccard join on word shingles: T-occurrence search over inverted lists in the manner of DivideSkip.

Two sets of a and b shingles reach the similarity 3/4 if they share T = ceil(3 (a + b) / 7) of them. All shingles are
put in one order, rare ones (short lists) first and the most frequent ones (long lists) last. Of a set's a lists the
L = ceil(3 a / 4) - 1 last ones are set aside, so that a partner must occur in at least one of the others: only these
enter the inverted lists, which Spark's shuffle merges. Of a pair the merged lists give the number of occurrences and
the place of the last one; if that number and all lists behind that place together don't reach T, the pair goes. For
those that remain the rest is merged on whole sets, and long lists are probed by binary search as long as T is in reach.
Before they are counted, pairs whose 256-bit parity maps differ too much are left out, which is exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize, most_frequent, partitions, with_global_rank
from .components import connected_components
from .words import CHUNK_BYTES, chunks, mix, pack, pack_numbers, shingle_lists, shingle_sets, unpack_numbers, utf8

WORDS = 5
#: So many of the most frequent shingles count as long lists. It bounds what is broadcast; the result doesn't depend on it.
LONG_LISTS = 100_000
#: Sets that a task keeps while it decides pairs.
KEPT_SETS = 2_000
#: Pairs, or those with CHUNK_BYTES of new texts, that a task decides at once.
DECIDED = 200
#: Columns of a set's parity map.
MAPS = ["m0", "m1", "m2", "m3"]
#: Postings of a bucket of lists, about: what a task merges at once.
BUCKET = 1_000_000
#: Postings that a task packs at once, beyond them those of so many bytes of text, or of one text: bounds what a batch of long texts takes.
POSTS, POSTED_BYTES = 200_000, 1 << 20


def needed(a, b):
    """How many shingles sets of a and b must share for a Jaccard similarity of 3/4."""
    return (3 * (a + b) + 6) // 7


def starts_of(sizes: np.ndarray) -> np.ndarray:
    """Where each of some sets, none of them empty, starts if they lie one after another."""
    return np.cumsum(sizes) - sizes


def signatures(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent sums over each set: 128 bits that tell sets apart. No set is empty."""
    if not len(sizes):
        return (np.zeros(0, np.int64),) * 2
    u, starts = flat.view(np.uint64), starts_of(sizes)
    return tuple(np.add.reduceat(mix(x), starts).view(np.int64) for x in (u, u ^ np.uint64(0xA5A5A5A5DEADBEEF)))


def least_hashes(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32 bits of two independent min-hashes of each set: similar sets have an equal one with their similarity's odds.

    No set is empty. They only choose pivots, so that a few sets with other min-hashes share a number changes no result.
    """
    u, starts = flat.view(np.uint64), starts_of(sizes)
    least = (np.minimum.reduceat(mix(u ^ np.uint64(x)), starts) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
    return tuple((x & np.uint64(0xFFFFFFFF)).astype(np.int64) for x in least)


def parities(s: np.ndarray) -> np.ndarray:
    """Whether a set has an odd number of the shingles of each of 256 groups, as four 64-bit numbers.

    A shingle that only one of two sets has changes one bit, so two maps differ in no more bits than their sets in
    shingles. Sets of n shingles that reach 3/4 differ in a seventh of both sizes at most.
    """
    return all_parities(s, np.array([len(s)]))[0]


def all_parities(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The parity map of each of some sets that lie one after another."""
    group = (mix(flat.view(np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(255)).astype(np.int64)
    counts = np.bincount(np.repeat(256 * np.arange(len(sizes)), sizes) + group, minlength=256 * len(sizes))
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64).reshape(-1, 4)


def parity_maps(parts):
    """Rows (s1, m0 to m3) for rows (s1, packed)."""
    for p in parts:
        maps = [all_parities(*shingle_lists(raws, WORDS)) for _, raws in chunks(list(p["packed"]))]
        yield pd.DataFrame(np.concatenate([np.zeros((0, 4), np.int64), *maps]), columns=MAPS).assign(s1=p["s1"].to_numpy())[["s1", *MAPS]]


def survey(parts):
    """A row for each document (doc_id, hash of the text, n, s1, s2), and (shingle, seen) for shingles
    that a batch has more than once."""
    for p in parts:
        rows, sets, known = [], [], set()
        for _, raws in chunks(list(p["text"])):
            flat, sizes = shingle_lists(raws, WORDS)
            told = np.zeros((len(sizes), 3), np.int64)
            told[:, 0] = sizes
            told[sizes > 0, 1], told[sizes > 0, 2] = signatures(flat, sizes[sizes > 0])
            rows.append(told)
            new = np.array([not (name in known or known.add(name)) for name in map(tuple, told[:, 1:].tolist())], bool)
            sets.append(flat[np.repeat(new, sizes)])
        n, s1, s2 = np.concatenate(rows).T if rows else (np.zeros(0, np.int64),) * 3
        yield pd.DataFrame({"doc_id": p["doc_id"].to_numpy(), "nameless": p["nameless"].to_numpy(), "said": p["said"].to_numpy(), "n": n, "s1": s1, "s2": s2, "shingle": pd.array([pd.NA] * len(n), "Int64"), "seen": 0})
        u, c = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.int64),) * 2
        u, c = u[c > 1], c[c > 1]
        yield pd.DataFrame({"doc_id": 0, "nameless": False, "said": 0, "n": 0, "s1": 0, "s2": 0, "shingle": u, "seen": c})


#: Values of the highest 21 bits of a shingle: which of them long lists have tells most other shingles from them.
SIEVE = 1 << 21


def sieve_of(heavy: np.ndarray) -> np.ndarray:
    sieve = np.zeros(SIEVE, bool)
    sieve[heavy.view(np.uint64) >> np.uint64(43)] = True
    return sieve


def prefixes(flat: np.ndarray, sizes: np.ndarray, heavy: np.ndarray, rank: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle, set, place and whether it is a long list, for all but the L last lists of each set in the common order.

    No set is empty. heavy: the long lists, sorted; rank: their order; sieve: of heavy.
    """
    wanted, owner = sizes - (3 * sizes + 3) // 4 + 1, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    is_long, maybe = np.zeros(len(flat), bool), np.flatnonzero(sieve[flat.view(np.uint64) >> np.uint64(43)])
    at = np.searchsorted(heavy, flat[maybe])
    at[at == len(heavy)] = 0
    sure = heavy[at] == flat[maybe] if len(heavy) else np.zeros(0, bool)
    maybe, at = maybe[sure], at[sure]
    is_long[maybe] = True
    n_long = np.bincount(owner[maybe], minlength=len(sizes))
    n_short = sizes - n_long
    short = np.flatnonzero(~is_long)
    short = short[np.arange(len(short)) - np.repeat(starts_of(n_short), n_short) < np.repeat(wanted, n_short)]
    n_short = np.minimum(n_short, wanted)
    place = np.arange(len(short)) - np.repeat(starts_of(n_short), n_short)
    order = np.lexsort((rank[at], owner[maybe]))
    long = maybe[order]
    behind = np.arange(len(long)) + np.repeat(sizes - n_long - starts_of(n_long), n_long)
    near = behind < np.repeat(wanted, n_long)
    long, behind = long[near], behind[near]
    both = np.concatenate([short, long])
    return flat[both], owner[both].astype(np.int64), np.concatenate([place, behind]), is_long[both]


def similar(a: np.ndarray, b: np.ndarray, heavy: np.ndarray) -> bool:
    """Whether sorted sets reach T: short lists merged first, long ones probed while T is still in reach."""
    t = int(needed(len(a), len(b)))
    if min(len(a), len(b)) < t:
        return False
    if len(a) > len(b):
        a, b = b, a

    def found(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of x are in y, which is sorted."""
        if not len(y):
            return np.zeros(len(x), bool)
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        return y[at] == x

    long_a = found(a, heavy)
    short, probes = a[~long_a], a[long_a]
    merged = np.concatenate([short, b])
    merged.sort()
    got = int(np.count_nonzero(merged[1:] == merged[:-1]))
    if got + len(probes) < t:
        return False
    return got + int(np.count_nonzero(found(probes, b))) >= t


def decided(pairs: list[tuple[int, int]], raws: dict[int, bytes], sets: dict[int, np.ndarray], heavy: np.ndarray) -> list[bool]:
    """Which pairs are similar. raws: the texts whose sets aren't in `sets` yet; of these the last ones are kept."""
    sets |= {name: s.copy() for name, s in zip(raws, shingle_sets(list(raws.values()), WORDS))}
    keep = [similar(sets[a], sets[b], heavy) for a, b in pairs]
    for name in list(sets)[:-KEPT_SETS]:
        del sets[name]
    return keep


def link_documents(docs: DataFrame, long_lists: int = LONG_LISTS) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id, n_copies.

    component_id is the smallest doc_id that links (Jaccard similarity of at least 3/4) reach; n_copies counts the rows
    with an equal set. Equal sets are one class and compared once. Every list has a pivot, the member with the least
    ahead of the shared shingle; members are first compared with the pivot that most of their lists name. Those that stay
    outside its component are compared with pivots of their own, one for each value of a min-hash, so that many groups
    of near copies in a list come together by one comparison for each member and min-hash. Then members of a list that
    leave room for T meet if their components differ, so no link that joins components is lost, and members of one
    component never meet. Texts of fewer than five words have one shingle; those without words, and null texts, are linked with nothing. Repeated rows are copies
    of each other; rows with a null doc_id take part with a null id. Class numbers of 64 bits name the sets in lists.
    """
    spark = docs.sparkSession
    nameless = F.col("doc_id").isNull()
    said = F.xxhash64("text").alias("said")
    marked = docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), nameless.alias("nameless"), said, "text")  # pandas would make floats of longs with nulls
    both = materialize(marked.mapInPandas(survey, "doc_id long, nameless boolean, said long, n long, s1 long, s2 long, shingle long, seen long"))
    known = both.filter("shingle is null").select(F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id"), "said", "n", "s1", "s2")
    classes = materialize(known.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("first_id"), F.coalesce(F.min_by("said", "doc_id"), F.min("said")).alias("said"), F.count(F.lit(1)).alias("n_copies")))
    seen = materialize(both.filter("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen")).filter("seen >= 8"))
    top = most_frequent(seen, "seen", long_lists, 8).toPandas()  # long_lists rows at most
    top = top.sort_values("shingle")
    heavy = top["shingle"].to_numpy(np.int64)
    rank = np.argsort(np.lexsort((heavy, top["seen"].to_numpy(np.int64)))) if len(top) else np.zeros(0, np.int64)
    held = spark.sparkContext.broadcast((heavy, rank))

    postings = known.agg(F.sum(F.expr("n - (3 * n + 3) div 4 + 1"))).first()[0] or 0
    buckets = max(partitions(spark), -(-postings // BUCKET))

    def packed_lists(sets, posts) -> pd.DataFrame:
        """Rows of post() for some sets (s1, n, min-hashes) and their postings."""
        s1, n, near, near_2 = map(np.concatenate, zip(*sets))
        shingle, owner, pos, is_long = map(np.concatenate, zip(*posts))
        # a short list meets in the bucket of its shingle; rows of long lists pass through in any bucket
        bucket = (np.where(is_long, s1[owner].view(np.uint64), shingle.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(shingle)
        order = order[np.argsort((2 * bucket + is_long)[order].astype(np.min_scalar_type(2 * buckets)), kind="stable")]
        shingle, owner, pos, is_long, bucket = (x[order] for x in (shingle, owner, pos, is_long, bucket))
        edges = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (is_long[1:] != is_long[:-1]), True])
        rows, place = [], np.empty(len(s1), np.int64)
        for a, b in zip(edges, edges[1:]):
            met = np.zeros(len(s1), bool)
            met[owner[a:b]] = True
            own = np.flatnonzero(met)
            place[own] = np.arange(len(own))
            rows.append((int(bucket[a]), bool(is_long[a]), b - a, len(own), pack_numbers(np.diff(shingle[a:b], prepend=0), place[owner[a:b]], pos[a:b], s1[own], n[own], near[own], near_2[own])))
        return pd.DataFrame(rows, columns=["bucket", "long", "n_posts", "n_sets", "packed"])

    def post(parts):
        """Rows (bucket, long, n_posts, n_sets, packed) for the prefixes of the distinct sets of a batch."""
        heavy, rank = held.value
        sieve = sieve_of(heavy)
        for p in parts:
            done, sets, posts, held_sets, held_posts = set(), [], [], 0, 0
            for _, raws in chunks(list(p["text"]), POSTED_BYTES):
                flat, sizes = shingle_lists(raws, WORDS)
                sizes = sizes[sizes > 0]
                s1, s2 = signatures(flat, sizes)
                new = np.array([not (name in done or done.add(name)) for name in zip(s1.tolist(), s2.tolist())], bool)
                if not new.any():
                    continue
                flat, sizes, s1 = flat[np.repeat(new, sizes)], sizes[new], s1[new]
                shingle, owner, pos, is_long = prefixes(flat, sizes, heavy, rank, sieve)
                posts.append((shingle, owner + held_sets, pos, is_long))
                sets.append((s1, sizes, *least_hashes(flat, sizes)))
                held_sets, held_posts = held_sets + len(sizes), held_posts + len(shingle)
                if held_posts >= POSTS:
                    yield packed_lists(sets, posts)
                    sets, posts, held_sets, held_posts = [], [], 0, 0
            if sets:
                yield packed_lists(sets, posts)

    def meet(p: pd.DataFrame) -> pd.DataFrame:
        """The lists of a bucket that hold different sets, each row with its list's pivot; long lists without."""
        got = []
        for is_long, n_posts, n_sets, packed in zip(p["long"], p["n_posts"], p["n_sets"], p["packed"]):
            step, place, pos, s1, n, near, near_2 = unpack_numbers(packed, [n_posts] * 3 + [n_sets] * 4)
            got.append((np.cumsum(step), s1[place], n[place], pos, near[place], near_2[place], np.full(n_posts, is_long)))
        shingle, s1, n, pos, near, near_2, is_long = map(np.concatenate, zip(*got))
        # most shingles of a bucket are alone and are left out before the rest is put in order
        order = np.argsort(shingle)
        equal = shingle[order[1:]] == shingle[order[:-1]]
        kept = order[is_long[order] | np.r_[False, equal] | np.r_[equal, False]]
        shingle, s1, n, pos, near, near_2, is_long = (x[kept] for x in (shingle, s1, n, pos, near, near_2, is_long))
        order = np.lexsort((s1, pos, shingle, is_long))
        shingle, s1, n, pos, near, near_2, is_long = (x[order] for x in (shingle, s1, n, pos, near, near_2, is_long))
        starts = np.flatnonzero(np.r_[True, (shingle[1:] != shingle[:-1]) | (is_long[1:] != is_long[:-1])][: len(shingle)])
        lists = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(shingle)]))
        differ = (np.minimum.reduceat(s1, starts) < np.maximum.reduceat(s1, starts))[lists] | is_long
        differ[1:] &= (shingle[1:] != shingle[:-1]) | (s1[1:] != s1[:-1]) | (is_long[1:] != is_long[:-1])  # a set is in a list once
        first = starts[lists[differ]]
        pivots = {"pivot": s1[first], "pivot_n": n[first], "pivot_pos": pos[first]}
        return pd.DataFrame({"shingle": shingle[differ], "s1": s1[differ], "n": n[differ], "pos": pos[differ], "near": near[differ], "near_2": near_2[differ], **pivots, "long": is_long[differ]})

    posted = docs.select("text").mapInPandas(post, "bucket long, long boolean, n_posts long, n_sets long, packed binary")
    met = materialize(posted.groupBy("bucket").applyInPandas(meet, "shingle long, s1 long, n long, pos long, near long, near_2 long, pivot long, pivot_n long, pivot_pos long, long boolean"))
    long = met.filter("long")
    pivots = long.groupBy("shingle").agg(F.min(F.struct("pos", "s1", "n")).alias("p")).select("shingle", F.col("p.s1").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.pos").alias("pivot_pos"))
    long = long.drop("pivot", "pivot_n", "pivot_pos").join(F.broadcast(pivots), "shingle")  # long_lists rows at most
    lists = met.filter("not long").unionByName(long)

    def room(a: str, a_pos: str, b: str, b_pos: str):
        return F.expr(f"least({a} - {a_pos}, {b} - {b_pos}) >= (3 * ({a} + {b}) + 6) div 7")

    def pivots_of(own: DataFrame) -> DataFrame:
        """a, b: for each member outside its lists' pivots the pivot that most of its lists name."""
        star = own.filter("s1 != pivot").filter(room("n", "pos", "pivot_n", "pivot_pos")).groupBy("s1", "pivot").agg(F.count(F.lit(1)).alias("lists"))
        return star.groupBy("s1").agg(F.max(F.struct("lists", "pivot")).alias("best")).select(F.col("s1").alias("a"), F.col("best.pivot").alias("b"))

    wanted = lists.select("s1").union(lists.select("pivot")).distinct().join(classes, "s1").select("s1", F.col("first_id").alias("doc_id"), "said")
    told = docs.select("doc_id", said, "text")  # an id may repeat with other texts, so the text's hash is asked for too
    texts = pack(told.filter("doc_id is not null"), ["doc_id", "said"]).join(wanted, ["doc_id", "said"]).select("s1", "packed")
    nameless = pack(told.filter("doc_id is null"), ["said"]).join(wanted.filter("doc_id is null").select("s1", "said"), "said").select("s1", "packed").dropDuplicates(["s1"])
    texts = materialize(texts.unionByName(nameless))

    def decide(parts):
        heavy, _ = held.value
        sets: dict[int, np.ndarray] = {}  # the last ones are kept, as pairs of a pivot follow each other
        for p in parts:
            keep, pairs, raws = [], [], {}
            for a, b, x, y in zip(p["a"].tolist(), p["b"].tolist(), p["packed_a"], p["packed_b"]):
                pairs.append((a, b))
                raws |= {name: utf8(packed) for name, packed in ((a, x), (b, y)) if name not in sets and name not in raws}
                if sum(map(len, raws.values())) > CHUNK_BYTES or len(pairs) == DECIDED:
                    keep += decided(pairs, raws, sets, heavy)
                    pairs, raws = [], {}
            keep += decided(pairs, raws, sets, heavy)
            yield p.loc[keep, ["a", "b"]]

    def verified(pairs: DataFrame) -> DataFrame:
        one = pairs.join(texts.select(F.col("s1").alias("a"), F.col("packed").alias("packed_a")), "a")
        two = one.join(texts.select(F.col("s1").alias("b"), F.col("packed").alias("packed_b")), "b")
        return two.select("a", "b", "packed_a", "packed_b").mapInPandas(decide, "a long, b long").distinct()

    links = materialize(verified(pivots_of(lists)))
    labels = connected_components(links)

    def labelled(own: DataFrame) -> DataFrame:
        told = own.join(labels.withColumnRenamed("node", "s1"), "s1", "left")
        return told.withColumn("label", F.coalesce("label", "s1"))

    pivot_labels = labels.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label"))
    outside = labelled(lists).join(pivot_labels, "pivot", "left").filter(F.col("label") != F.coalesce("pivot_label", "pivot"))
    outside = materialize(outside.select("shingle", "s1", "n", "pos", "near", "near_2"))
    for near in ("near", "near_2"):
        own = outside.select("shingle", "s1", "n", "pos", near)
        pivots = own.groupBy("shingle", near).agg(F.min(F.struct("pos", "s1", "n")).alias("p")).select("shingle", near, F.col("p.s1").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.pos").alias("pivot_pos"))
        links = links.unionByName(materialize(verified(pivots_of(own.join(pivots, ["shingle", near])))))
    labels = connected_components(links)
    joined = materialize(labelled(lists.select("shingle", "s1", "n", "pos")))

    # Of a pair the larger set (or the later of equal ones) asks, the other one stands in the list. Among sets no smaller
    # T is at least 6/7 of the one that stands; so either role has a prefix of its own, few of a hot list have the second
    # role, and sizes that can't meet never do: a set of n asks in the classes of sizes from 3 n / 4 to n.
    def size_class(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / float(np.log(4 / 3)))

    asks = joined.filter("n - pos >= (3 * n + 3) div 4").withColumn("sizes", F.explode(F.sequence(size_class(F.expr("(3 * n + 3) div 4")), size_class(F.col("n")))))
    stands = joined.filter("n - pos >= (6 * n + 6) div 7").withColumn("sizes", size_class(F.col("n")))

    # Only lists with both roles and two components or more go on. Their components get consecutive numbers, and sets
    # meet at the highest bit in which the numbers differ: once if the components differ, never if they are the same.
    def ends(own: DataFrame, who: str) -> DataFrame:
        return own.groupBy("shingle", "sizes").agg(F.min("label").alias(f"{who}_min"), F.max("label").alias(f"{who}_max"))

    mixed = materialize(ends(asks, "a").join(ends(stands, "s"), ["shingle", "sizes"]).filter("least(a_min, s_min) < greatest(a_max, s_max)").select("shingle", "sizes"))
    asks, stands = (materialize(own.join(mixed, ["shingle", "sizes"])) for own in (asks, stands))
    present = asks.select("shingle", "sizes", "label").union(stands.select("shingle", "sizes", "label")).distinct()
    numbers = materialize(with_global_rank(present, [F.col("shingle"), F.col("sizes"), F.col("label")]).drop("before"))
    spans = numbers.groupBy("shingle", "sizes").agg(F.min("rank").alias("base"), F.max("rank").alias("top"))
    numbers = numbers.join(spans, ["shingle", "sizes"]).select("shingle", "sizes", "label", (F.col("rank") - F.col("base")).alias("number"), F.length(F.bin(F.col("top") - F.col("base"))).alias("bits"))

    def at_bits(own: DataFrame, flipped: int) -> DataFrame:
        """own once for each bit of its component's number, with the bits above (`node`) and the bit as it is asked for."""
        told = own.join(numbers, ["shingle", "sizes", "label"]).withColumn("bit", F.explode(F.expr("sequence(0, bits - 1)")))
        return told.withColumn("node", F.expr("shiftright(number, bit + 1)")).withColumn("side", F.expr(f"(shiftright(number, bit) & 1L) ^ {flipped}L")).drop("number", "bits", "label")

    # Sets whose parity maps differ in more bits than T leaves room for don't meet: of texts that share a few sentences,
    # which any two of a list may be, hardly a pair is written or verified.
    members = asks.select("s1").union(stands.select("s1")).distinct()
    maps = materialize(texts.join(members, "s1", "left_semi").mapInPandas(parity_maps, "s1 long, m0 long, m1 long, m2 long, m3 long"))
    asks = at_bits(asks.join(maps, "s1"), 1).withColumnsRenamed({c: f"u_{c}" for c in ("s1", "n", "pos", *MAPS)})
    near_enough = F.expr(" + ".join(f"bit_count(u_{m} ^ {m})" for m in MAPS) + " + 2 * ((3 * (u_n + n) + 6) div 7) <= u_n + n")
    met = asks.join(at_bits(stands.join(maps, "s1"), 0), ["shingle", "sizes", "bit", "node", "side"]).filter("u_n > n or u_n = n and u_s1 > s1").filter(room("u_n", "u_pos", "n", "pos")).filter(near_enough)
    merged = met.groupBy("u_s1", "s1", "u_n", "n").agg(F.count(F.lit(1)).alias("shared"), F.max("u_pos").alias("u_pos"), F.max("pos").alias("pos"))
    more = merged.filter("shared + least(u_n - u_pos, n - pos) - 1 >= (3 * (u_n + n) + 6) div 7").select(F.col("u_s1").alias("a"), F.col("s1").alias("b"))
    links = links.unionByName(materialize(verified(more)))
    labels = connected_components(links)
    named = classes.join(labels.withColumnRenamed("node", "s1"), "s1", "left").withColumn("label", F.coalesce("label", "s1"))
    named = materialize(named)
    smallest = materialize(named.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("members")))
    named = materialize(join_counted(named, smallest, ["label"], "members").select("s1", "s2", "n", "component_id", "n_copies", F.col("n_copies").alias("rows")))
    found = join_counted(known.filter("n > 0"), named, ["s1", "s2", "n"], "rows").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_copies")
    return found.unionByName(known.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies")))
