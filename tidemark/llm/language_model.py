"""Language-model scores by prediction by partial matching (PPM) over bytes, learned from the corpus itself.

The byte-context trie is a relation: one row for each context of up to ORDER bytes and byte after it, with its count in
the training texts. A byte is predicted in its longest context; if it wasn't seen there the model escapes (method C:
in proportion to the number of different bytes seen) to the next shorter one, in which bytes seen in the longer one are
excluded. The code length of a (context, byte) pair depends on the counts alone, so Spark works it out once for each
pair that the corpus has and hands every group of documents only the pairs that occur in it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions
from .quality import fold
from .words import chunks, pack, pack_numbers, unpack_numbers

ORDER = 5
#: Bytes of text of a group of documents at most, about: what a task holds at once.
GROUP_BYTES = 24 << 20
#: Bytes of text whose grams are numbered at once: they take some fifty times as much.
CHUNK = 1 << 19
#: Chunks after which the counts of a part are added up.
MERGE_EVERY = 6
#: Bytes of text for a bucket of counts, about.
BUCKET_BYTES = 16 << 20
#: Never part of UTF-8: stands before the first byte and after the last one.
EDGE = 0xFF
#: Counts as the token after the last word; no word has white space.
END = b"\n"
GRAM, WORD = 0, 1


def byte_grams(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every predicted byte of the texts (the end included): its text, and the last ORDER + 1 bytes as a number."""
    pad = bytes([EDGE]) * ORDER
    joined = np.frombuffer(b"".join(pad + r + bytes([EDGE]) for r in raws), np.uint8)
    lengths = np.fromiter(map(len, raws), np.int64, len(raws)) + ORDER + 1
    grams = np.zeros(len(joined) - ORDER, np.int64)
    for j in range(ORDER + 1):
        grams = grams << 8 | joined[j : len(joined) - ORDER + j]
    starts = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(raws)), lengths - ORDER)
    within = np.arange(len(text)) - np.repeat(np.cumsum(lengths - ORDER) - (lengths - ORDER), lengths - ORDER)
    return text, grams[starts[text] + within]


def tokens(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every token of the texts: its text and its hash."""
    split = [[*r.split(), END] for r in raws]
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.empty(int(lengths.sum()), dtype=object)
    flat[:] = [w for ws in split for w in ws]
    return np.repeat(np.arange(len(raws)), lengths), pd.util.hash_array(flat, categorize=True).view(np.int64)


def dealt(kind: int, keys: np.ndarray, numbers: np.ndarray, buckets: int) -> list[tuple]:
    """(kind, bucket, m, packed): keys with a number each, dealt by key; in each packet sorted by key."""
    bucket = np.mod(keys, buckets)
    order = np.lexsort((keys, bucket))
    keys, numbers, bucket = keys[order], numbers[order], bucket[order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(keys) else []
    return [(kind, int(bucket[a]), b - a, packet(keys[a:b], numbers[a:b])) for a, b in zip(edges[:-1], edges[1:])]


def packet(keys: np.ndarray, numbers: np.ndarray) -> bytes:
    return pack_numbers(np.diff(keys, prepend=0), numbers.view(np.int64))


def opened(packed: bytes, m: int) -> tuple[np.ndarray, np.ndarray]:
    steps, numbers = unpack_numbers(packed, [m, m])
    return np.cumsum(steps), numbers


def count(parts, buckets: int):
    """Packets (part, kind, bucket, m, packed) of what the texts of a part have, and how often its training texts
    have it."""
    for p in parts:
        for part, q in p.groupby("part"):
            held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {GRAM: [], WORD: []}
            learn = ~q["held_out"].to_numpy(bool)
            for at, raws in chunks(list(q["text"]), CHUNK):
                raws = [r.lower() for r in raws]
                for kind, take in ((GRAM, byte_grams), (WORD, tokens)):
                    text, keys = take(raws)
                    held[kind].append(merged([(keys, learn[at + text])]))
                    if len(held[kind]) > MERGE_EVERY:
                        held[kind] = [merged(held[kind])]
            for kind, found in held.items():
                yield pd.DataFrame(dealt(kind, *merged(found), buckets), columns=["kind", "bucket", "m", "packed"]).assign(part=part)


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their numbers."""
    code, keys = pd.factorize(np.concatenate([k for k, _ in found]))
    return keys, np.bincount(code, weights=np.concatenate([n for _, n in found]), minlength=len(keys)).astype(np.int64)


def total(p: pd.DataFrame) -> pd.DataFrame:
    """The packets of a bucket together: of byte grams each key with its sum; of words each part's keys with their sums,
    and the sum and number of all."""
    kind = int(p["kind"].iloc[0])
    got = [opened(x, m) for x, m in zip(p["packed"], p["m"])]
    code, keys = pd.factorize(np.concatenate([k for k, _ in got]))
    sums = np.bincount(code, weights=np.concatenate([n for _, n in got]), minlength=len(keys)).astype(np.int64)
    if kind == GRAM:
        return pd.DataFrame({"kind": kind, "part": 0, "key": keys, "n": sums, "m": 0, "packed": None})
    ends = np.cumsum([len(k) for k, _ in got])
    told = [packet(k, sums[code[e - len(k) : e]].astype(np.float64)) for (k, _), e in zip(got, ends)]
    facts = pd.DataFrame({"kind": [kind], "part": [0], "key": [int((sums > 0).sum())], "n": [int(sums.sum())], "m": [0], "packed": [None]})
    return pd.concat([facts, pd.DataFrame({"kind": kind, "part": p["part"].to_numpy(), "key": 0, "n": 0, "m": p["m"].to_numpy(), "packed": told})])


def answer(asked: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
    """The packets of a bucket with the value of each key in place of its count."""
    order = np.argsort(values["key"].to_numpy(np.int64))
    keys, value = values["key"].to_numpy(np.int64)[order], values["value"].to_numpy()[order]
    told = []
    for x, m in zip(asked["packed"], asked["m"]):
        own, _ = opened(x, m)
        told.append(packet(own, value[np.searchsorted(keys, own)]))
    return pd.DataFrame({"kind": GRAM, "part": asked["part"].to_numpy(), "m": asked["m"].to_numpy(), "packed": told})


def code_lengths(grams: DataFrame) -> DataFrame:
    """(key, n) -> (key, value): log10 of the probability that PPM gives the last byte of each gram after the others."""

    def low(column, length: int):
        return column.bitwiseAND((1 << 8 * length) - 1)

    nodes = {ORDER: grams.filter("n > 0").select("key", "n")}
    for k in range(ORDER - 1, -1, -1):
        nodes[k] = materialize(nodes[k + 1].groupBy(low(F.col("key"), k + 1).alias("key")).agg(F.sum("n").alias("n")))
    out = grams.select("key")
    for k in range(ORDER, -1, -1):
        # of each context: all, different, and what the next shorter context counts for the same bytes
        shorter = nodes[k - 1].select(F.col("key").alias("short"), F.col("n").alias("less")) if k else None
        own = nodes[k].withColumn("short", low(F.col("key"), k))
        own = own.join(shorter, "short") if k else own.withColumn("less", F.lit(0).cast("long"))
        contexts = own.groupBy(F.shiftright("key", 8).alias(f"c{k}")).agg(F.sum("n").alias(f"all{k}"), F.count(F.lit(1)).alias(f"kinds{k}"), F.sum("less").alias(f"less{k}"))
        out = out.withColumn(f"c{k}", low(F.shiftright("key", 8), k)).withColumn(f"k{k}", low(F.col("key"), k + 1))
        out = out.join(contexts, f"c{k}", "left").join(nodes[k].select(F.col("key").alias(f"k{k}"), F.col("n").alias(f"n{k}")), f"k{k}", "left").drop(f"c{k}", f"k{k}")
    value = -F.log10(256 - F.coalesce("kinds0", F.lit(0)).cast("double"))
    for k in range(ORDER + 1):
        left_out = F.coalesce(f"less{k + 1}", F.lit(0)) if k < ORDER else F.lit(0)
        known_out = F.coalesce(f"kinds{k + 1}", F.lit(0)) if k < ORDER else F.lit(0)
        fresh = (F.col(f"kinds{k}") - known_out).cast("double")
        room = (F.col(f"all{k}") - left_out) + fresh
        value = F.when(F.col(f"n{k}").isNotNull(), F.log10(F.col(f"n{k}") / room)).when(F.col(f"all{k}").isNull() | (fresh <= 0), value).otherwise(F.log10(fresh / room) + value)
    return out.select("key", value.alias("value"))


def score(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """A row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    The model learns from all texts whose crc32(doc_id) mod 7 is not 2, A-Z as a-z. `score` is log10 of the probability
    of the bytes of the whole text and of its end; `base_score` that of its words and end under add-one unigrams.
    Documents are scored in groups of about `group_bytes`, cut by file split and hash of doc_id; a group is sent the
    counts of what occurs in it and nothing else. Null texts count as empty, and an empty text is scored by its end;
    repeated rows count each; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"), (fold(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 7) == 2).alias("held_out"), F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("split"))
    sizes = base.groupBy("split").agg(F.sum(F.octet_length("text")).alias("bytes")).agg(F.max("bytes").alias("largest"), F.sum("bytes").alias("all")).first()
    cuts = max(1, -(-(sizes["largest"] or 0) // group_bytes))
    buckets = max(partitions(docs.sparkSession), -(-(sizes["all"] or 0) // BUCKET_BYTES)) | 1
    base = base.withColumn("part", F.xxhash64("split", F.pmod(F.xxhash64("doc_id", "text"), F.lit(cuts)))).drop("split")
    counts = base.select("part", "held_out", "text").mapInPandas(lambda parts: count(parts, buckets), "kind int, bucket long, m long, packed binary, part long")
    counts = materialize(counts)
    totals = materialize(counts.groupBy("kind", "bucket").applyInPandas(total, "kind int, part long, key long, n long, m long, packed binary"))
    sums = totals.filter((F.col("kind") == WORD) & F.col("packed").isNull()).agg(F.sum("n").alias("all"), F.sum("key").alias("kinds")).first()
    train, kinds = sums["all"] or 0, sums["kinds"] or 0
    values = code_lengths(totals.filter(F.col("kind") == GRAM).select("key", "n")).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    grams = counts.filter(F.col("kind") == GRAM).groupBy("bucket").cogroup(values.groupBy("bucket")).applyInPandas(answer, "kind int, part long, m long, packed binary")
    words = totals.filter((F.col("kind") == WORD) & F.col("packed").isNotNull()).select("kind", "part", "m", "packed")

    def rate(own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        known = {}
        for kind in (GRAM, WORD):
            t = told[told["kind"] == kind]
            keys, value = (np.concatenate(x) for x in zip(*[opened(x, m) for x, m in zip(t["packed"], t["m"])]))
            keys, first = np.unique(keys, return_index=True)
            known[kind] = keys, value[first].view(np.float64)
        out = np.zeros((len(own), 5))
        for at, raws in chunks(list(own["packed"]), CHUNK):
            n_bytes, raws = [len(r) + 1 for r in raws], [r.lower() for r in raws]
            here = slice(at, at + len(raws))
            for kind, take in ((GRAM, byte_grams), (WORD, tokens)):
                text, keys = take(raws)
                code, distinct = pd.factorize(keys)
                got = known[kind][1][np.searchsorted(known[kind][0], distinct)][code]
                if kind == GRAM:
                    out[here, 0] = np.bincount(text, weights=got, minlength=len(raws))
                    out[here, 4] = n_bytes
                else:
                    out[here, 1] = np.bincount(text, weights=np.log10((got + 1) / (train + kinds + 1)), minlength=len(raws))
                    out[here, 2] = np.bincount(text, minlength=len(raws))
                    out[here, 3] = np.bincount(text, weights=got > 0, minlength=len(raws))
        return pd.DataFrame({"doc_id": own["doc_id"], "held_out": own["held_out"], "n_tokens": out[:, 2].astype(np.int64), "n_known": out[:, 3].astype(np.int64), "train_tokens": train, "base_score": out[:, 1], "score": out[:, 0], "bits_per_byte": -out[:, 0] / np.log10(2) / np.maximum(out[:, 4], 1)})

    told = grams.unionByName(words)
    texts = pack(base, ["part", "doc_id", "held_out"])
    return texts.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
