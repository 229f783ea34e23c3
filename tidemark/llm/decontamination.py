"""Benchmark decontamination by winnowing: fingerprints that any long enough shared span must share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, materialize

#: What separates words: ASCII other than digits and lower-case letters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window, and of the grams that are hashed.
WINDOW, GRAM = 10, 5
#: Tables of fingerprints, windows or places that take up to so many bytes are sent to every executor; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), lambda w: w != "")


def grams(words: Column, k: int) -> Column:
    """Hashes of all runs of k words, in order; none for fewer words."""

    def runs(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.array_size(h) - k)
        joined = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])) if k > 1 else h
        return F.when(F.array_size(h) >= k, joined).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def winnowed(words: Column, k: int = GRAM, span: int = WINDOW) -> Column:
    """Pairs (at, hash): the smallest gram hash of every run of span - k + 1 grams, each place once.

    What is kept from a run depends on nothing outside it, so two equal spans of `span` words keep the same gram at the
    same place in the span. Of equal hashes the last one is kept.
    """
    w = span - k + 1

    def least(numbered: Column) -> Column:
        at = F.sequence(F.lit(0), F.array_size(numbered) - w)
        if w == 1:
            picked = numbered
        else:
            picked = F.transform(at, lambda i: F.least(*[F.get(numbered, i + j) for j in range(w)]))
        return F.when(F.array_size(numbered) >= w, picked).otherwise(F.array().cast("array<struct<hash:bigint,back:int>>"))

    numbered = F.transform(grams(words, k), lambda h, i: F.struct(h.alias("hash"), (-i).alias("back")))
    once = let(let(numbered, least), lambda all_: F.filter(all_, lambda p, i: (i == 0) | (p["back"] != F.get(all_, i - 1)["back"])))  # places never fall back
    return F.transform(once, lambda p: F.struct((-p["back"]).alias("at"), p["hash"].alias("hash")))


def item_windows(words: Column) -> Column:
    """The distinct windows of an item as texts: runs of `WINDOW` words, of a shorter item all its words."""
    at = F.sequence(F.lit(0), F.greatest(F.array_size(words) - WINDOW, F.lit(0)))
    return F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(words, i + 1, WINDOW), " ")))


def small_enough(df: DataFrame, size: Column) -> bool:
    """Whether a table in the shared folder, measured in full, may be sent to every executor."""
    return (df.agg(F.sum(size + 64)).first()[0] or 0) <= BROADCAST_BYTES


def find_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """key, place, win: where windows of items (key, text: docs; words, span: items) begin in documents.

    `place` is 16 * first word + words of the window. Fingerprints of documents and items meet by hash; each that meets
    is extended to the windows around it, and those are joined with the items' windows as texts. A row of fingerprints
    or windows holds a key and a place but no words, and equal hashes and windows of items stand once, so that the work
    grows with the length of texts, however often a gram repeats.
    """
    spans = sorted(r[0] for r in items.select("span").distinct().collect())  # ten numbers at most
    k_of = {m: GRAM if m == WINDOW else m for m in spans}
    none = docs.select("key", F.lit(0).cast("long").alias("place"), F.lit("").alias("win")).limit(0)
    if not spans:
        return none
    prints = [items.filter(F.col("span") == m).select(F.lit(m).alias("span"), F.explode(F.transform(winnowed(F.col("words"), k, m), lambda p: p["hash"])).alias("hash")) for m, k in k_of.items()]
    prints = materialize(reduce(DataFrame.unionByName, prints).distinct())

    def prints_of(words: Column) -> Column:
        def marked(m: int) -> Column:
            return F.transform(winnowed(words, k_of[m], m), lambda p: F.struct((p["at"].cast("long") * 16 + m).alias("place"), F.lit(m).alias("span"), p["hash"].alias("hash")))

        return F.concat(*map(marked, spans))

    spread = docs.select("key", F.explode(let(words_of(F.col("text")), prints_of)).alias("p")).select("key", "p.place", "p.span", "p.hash")
    met = spread.join(F.broadcast(prints) if small_enough(prints, F.lit(16)) else prints, ["span", "hash"])
    met = materialize(met.groupBy("key").agg(F.collect_set("place").alias("places")))

    def windows_at(words: Column) -> Column:
        """The windows around the fingerprints' places, each once."""

        def around(p: Column) -> Column:
            at, m = F.floor(p / 16), p % 16
            first = F.greatest(at - F.when(m == WINDOW, WINDOW - GRAM).otherwise(0), F.lit(0))
            return F.transform(F.sequence(first, F.least(at, F.array_size(words) - m)), lambda s: s * 16 + m)

        once = F.array_distinct(F.flatten(F.transform("places", around)))
        return F.transform(once, lambda p: F.struct(p.alias("place"), F.array_join(F.slice(words, (F.floor(p / 16) + 1).cast("int"), (p % 16).cast("int")), " ").alias("win")))

    asked = docs.join(F.broadcast(met) if small_enough(met, 8 * F.array_size("places")) else met, "key")
    asked = asked.select("key", F.explode(let(words_of(F.col("text")), windows_at)).alias("w")).select("key", "w.place", "w.win")
    known = materialize(items.select(F.explode(item_windows(F.col("words"))).alias("win")).distinct())
    return asked.join(F.broadcast(known) if small_enough(known, F.octet_length("win")) else known, "win").select("key", "place", "win")


def covered(places: Column) -> Column:
    """How many words lie in windows, from their sorted places."""

    def step(so_far: Column, p: Column) -> Column:
        first, end = F.floor(p / 16), F.floor(p / 16) + p % 16
        fresh = F.greatest(end - F.greatest(first, so_far["reach"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(end, so_far["reach"]).alias("reach"), (so_far["words"] + fresh).alias("words"))

    zero = F.lit(0).cast("long")
    return F.aggregate(places, F.struct(zero.alias("reach"), zero.alias("words")), step)["words"]


def named_items(hits: DataFrame, items: DataFrame, sayings: DataFrame) -> DataFrame:
    """key, n_items, items_sha256: the items whose windows occur in a document.

    Documents with the same windows have the same items, so items are looked up once for each set of windows: a window
    that many documents and many items share, such as a standing phrase, meets its items once for each set.
    """
    name = F.sha2(F.col("win").cast("binary"), 256)
    sets = hits.groupBy("key").agg(F.sort_array(F.collect_set(name)).alias("wins"))
    sets = materialize(sets.withColumn("set", F.sha2(F.array_join("wins", "").cast("binary"), 256)))
    said = sayings.select("said", F.explode(item_windows(F.col("words"))).alias("win")).select("said", name.alias("name"))
    named = sets.dropDuplicates(["set"]).select("set", F.explode("wins").alias("name")).join(said, "name").select("set", "said").distinct().join(items.select("said", "item_id"), "said")
    named = named.groupBy("set").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    named = named.select("set", F.array_size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    return sets.select("key", "set").join(named, "set").drop("set")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in an occurrence of a window: ten consecutive words of an item, or all words of a shorter
    one. Texts may have any length and repeat any gram. Each distinct (doc_id, text) is judged once and repeated rows,
    those without a doc_id too, get the same result. Null or empty texts have no words and are clean; null or wordless
    items have no windows, items of equal words are all named; an empty benchmark leaves all clean; other columns are
    ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.array_size("words") > 0)
    items = materialize(items.select(F.col("item_id").cast("string").alias("item_id"), "words", F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("said")))
    sayings = items.select("said", "words", F.least(F.array_size("words"), F.lit(WINDOW)).alias("span")).dropDuplicates(["said"])
    sayings = materialize(sayings)
    hits = materialize(find_windows(base.select("key", "text"), sayings))
    places = hits.groupBy("key").agg(F.sort_array(F.collect_set("place")).alias("places")).select("key", covered(F.col("places")).alias("n_hit"))
    per_doc = places.join(named_items(hits, items, sayings), "key")
    counted = base.select("doc_id", "key", F.regexp_count(ascii_lower(F.col("text")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).cast("long").alias("n_words"))
    return counted.join(per_doc, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
