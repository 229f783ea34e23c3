"""Which tokens of two tokenizers stand for the same bytes, and how often each pair does over all documents.

Both tokenisations of a text spell the same bytes. Where tokens of both end together and the next token of both carries
a space, a text is cut into windows. A window is known by its ids alone, so it is aligned once and looked up from then
on. Groups of documents hold windows by number; the ids that end together in them are counted over all groups in
buckets of the second tokenizer's ids, and every group gets back the counts of its own pairs and nothing else.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions
from .words import chunks, pack_numbers, unpack_numbers

#: Bytes of text that are tokenised at once, and of a group of documents at most, about.
CHUNK, GROUP = 1 << 20, 16 << 20
#: Windows that a group knows at most, about; then the next group begins.
WINDOWS = 250_000
#: Bytes of text for a bucket of pair counts, about.
BUCKET_BYTES = 4 << 20
#: Stands between the ids of both sides in a window's key; no id is as large.
BETWEEN = 0xFFFF
#: What follows an id: more of its side, the other side, or the end of the group.
COMMA, BAR, END = 0, 1 << 16, 2 << 16
DOC, TABLE, PAIRS = 0, 1, 2
ROW = "kind int, part long, doc_id string, n_a long, n_b long, n_groups long, groups_sha256 string, bucket int, m long, packed binary"
COLUMNS = [c.split()[0] for c in ROW.split(", ")]
#: White space that the rank encoder can't take in one run; such texts go to the other encoder of the same vocabulary.
LONG_SPACE = re.compile(r"\s{2000}")


@lru_cache(maxsize=1)
def spellings() -> list[bytes]:
    """Every id with every mark."""
    return [b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in range(1 << 16)]


@lru_cache(maxsize=2)
class Pair:
    """The two tokenizers by path, the bytes of their tokens, and which of these begin with a space.

    `ranks` and `vocabulary` are two files of one byte-level BPE and give the same ids; the first is faster.
    """

    def __init__(self, ranks: str, vocabulary: str, pieces: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        self.vocabulary = vocabulary
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.first = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        bytes_a = [token for token, _ in sorted(known.items(), key=lambda x: x[1])]
        told = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(told)]
        self.length_a, self.length_b = (np.array([len(t) for t in side], np.int64) for side in (bytes_a, self.bytes_b))
        self.spaced_a, self.spaced_b = (np.array([t[:1] == b" " for t in side]) for side in (bytes_a, self.bytes_b))

    @property
    @lru_cache(maxsize=1)
    def slow(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.vocabulary)
        found.encode_special_tokens = True
        return found

    def encode(self, raws: list[bytes]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides of each text; none if a side doesn't spell a space and the text."""
        texts = [r.decode() for r in raws]
        a = [self.first.encode_ordinary(" " + t) if not LONG_SPACE.search(t) else self.slow.encode_batch_fast([" " + t], add_special_tokens=False)[0].ids for t in texts]
        b = self.second.encode(texts, num_threads=1)
        spell = self.bytes_b.__getitem__
        # the first side always spells its text: every byte is a token
        return [(x, y) if r and b"".join(map(spell, y)) == b" " + r else ([], []) for r, x, y in zip(raws, a, b)]

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of texts put together: the byte, the first place and the second place at which each window begins."""
        start_a, start_b = np.cumsum(self.length_a[a]) - self.length_a[a], np.cumsum(self.length_b[b]) - self.length_b[b]
        anchors = np.intersect1d(start_a[self.spaced_a[a]], start_b[self.spaced_b[b]], assume_unique=True)
        return anchors, np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)

    def aligned(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of windows by key: their ids in order of groups, each with the mark that follows it, and how many these are;
        the pairs that end together, as one number each, and how many these are."""
        size = np.fromiter(map(len, keys), np.int64, len(keys)) // 2
        ids = np.frombuffer(b"".join(keys), np.uint16).astype(np.int64)
        window, cut = np.repeat(np.arange(len(keys)), size), ids == BETWEEN
        second = (np.cumsum(cut) > window) & ~cut
        a, b = ids[~(second | cut)], ids[second]
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        last_a, last_b = end_b[np.searchsorted(end_b, end_a)] == end_a, end_a[np.searchsorted(end_a, end_b)] == end_b
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.append(0, np.flatnonzero(last_b)[:-1] + 1)  # ids of the second side ahead of each group
        upto_a = np.flatnonzero(last_a) + 1
        items = np.empty(len(a) + len(b), np.int64)
        items[np.arange(len(a)) + before_b[group_a]] = a | np.where(last_a, BAR, COMMA)
        items[np.arange(len(b)) + upto_a[group_b]] = b | np.where(last_b, END, COMMA)
        pairs = b[last_b] << 32 | a[last_a]
        return items, size - 1, pairs, np.bincount(window[second][last_b], minlength=len(keys))


def window_keys(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[bytes]:
    """The ids of each window, those of one side, BETWEEN and those of the other, as bytes: a tuple of ids in short."""
    n = len(at_a)
    end_a, end_b = np.append(at_a[1:], len(a)), np.append(at_b[1:], len(b))
    out = np.full(len(a) + len(b) + n, BETWEEN, np.uint16)
    out[np.arange(len(a)) + np.repeat(at_b + np.arange(n), end_a - at_a)] = a
    out[np.arange(len(b)) + np.repeat(end_a + np.arange(1, n + 1), end_b - at_b)] = b
    raw, cut = out.tobytes(), 2 * (end_a + end_b + np.arange(1, n + 1))
    return [raw[i:j] for i, j in zip([0, *cut[:-1].tolist()], cut.tolist())]


class Group:
    """Windows known so far, by key; their ids and marks, and their pairs; and how often each window came up."""

    def __init__(self):
        self.number = defaultdict()
        self.number.default_factory = self.number.__len__
        none = np.zeros(0, np.int64)
        self.items, self.n_items, self.pairs, self.n_pairs, self.times, self.size = none, none, none, none, none, 0

    def numbered(self, tokens: Pair, keys: list[bytes]) -> np.ndarray:
        """The numbers of windows; those that are new are aligned."""
        number, had = self.number, len(self.number)
        out = np.fromiter((number[k] for k in keys), np.int64, len(keys))
        if len(number) > had:
            fresh = tokens.aligned(list(islice(number, had, None)))
            self.items, self.n_items, self.pairs, self.n_pairs = (np.concatenate(x) for x in zip((self.items, self.n_items, self.pairs, self.n_pairs), fresh))
            self.times = np.append(self.times, np.zeros(len(number) - had, np.int64))
        self.times += np.bincount(out, minlength=len(number))
        return out

    def spelled(self, found: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The groups of windows as pieces of text, and where the pieces of each window end."""
        size = self.n_items[found]
        ends = np.cumsum(size)
        starts = np.cumsum(self.n_items) - self.n_items
        items = self.items[np.repeat(starts[found] - (ends - size), size) + np.arange(size.sum())]
        return list(map(spellings().__getitem__, items.tolist())), ends

    def rows(self, part: int, buckets: int) -> pd.DataFrame:
        """The group's table of pairs by window, and the number of times that it has each pair, dealt by second id."""
        lengths = self.n_pairs
        pairs, place = np.unique(self.pairs, return_inverse=True)
        n = np.bincount(place, weights=np.repeat(self.times, lengths), minlength=len(pairs)).astype(np.int64)
        out = [(TABLE, part, None, len(lengths), len(place), None, None, None, len(pairs), pack_numbers(np.diff(pairs, prepend=0), lengths, place))]
        bucket = (pairs >> 32) % buckets
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        for s, e in zip(edges[:-1], edges[1:]):
            own = order[s:e]
            out.append((PAIRS, part, None, None, None, None, None, int(bucket[own[0]]), e - s, pack_numbers(np.diff(pairs[own], prepend=0), n[own])))
        return pd.DataFrame(out, columns=COLUMNS, dtype=object)


def tokenised(batches, tokenizers: tuple[str, str, str], buckets: int):
    """Rows of documents with their windows, and after each group of them its rows()."""
    tokens, group = Pair(*tokenizers), Group()
    part = TaskContext.get().partitionId() << 32
    for p in batches:
        ids = p["doc_id"].tolist()
        for at, raws in chunks(list(p["text"]), CHUNK):
            if group.size > GROUP or len(group.number) > WINDOWS:
                yield group.rows(part, buckets)
                group, part = Group(), part + 1
            group.size += sum(map(len, raws))
            both = tokens.encode(raws)
            n_a, n_b = (np.array([len(x[side]) for x in both], np.int64) for side in (0, 1))
            a, b = (np.fromiter(chain.from_iterable(x[side] for x in both), np.int64, int(n.sum())) for side, n in ((0, n_a), (1, n_b)))
            starts, at_a, at_b = tokens.windows(a, b)
            found = group.numbered(tokens, window_keys(a, b, at_a, at_b))
            pieces, ends = group.spelled(found)
            upto = np.append(0, np.searchsorted(starts, np.cumsum([len(r) + 1 if n else 0 for r, n in zip(raws, n_a)]))).tolist()  # windows of the texts so far
            links, ends = np.append(0, np.cumsum(group.n_pairs[found])), np.append(0, ends)
            out = []
            for i, (s, e) in enumerate(zip(upto, upto[1:])):
                text = b"".join(pieces[ends[s] : ends[e]])[:-1]
                out.append((DOC, part, ids[at + i], n_a[i], n_b[i], links[e] - links[s], hashlib.sha256(text).hexdigest() if text else "", None, e - s, pack_numbers(found[s:e])))
            yield pd.DataFrame(out, columns=COLUMNS, dtype=object)
    yield group.rows(part, buckets)


def counted(p: pd.DataFrame) -> pd.DataFrame:
    """The packets of a bucket, each pair with its count over all groups and whether none of its second id has more."""
    got = [unpack_numbers(x, [m, m]) for x, m in zip(p["packed"], p["m"])]
    pairs, place = np.unique(np.concatenate([np.cumsum(d) for d, _ in got]), return_inverse=True)
    n = np.bincount(place, weights=np.concatenate([c for _, c in got]), minlength=len(pairs)).astype(np.int64)
    second = pairs >> 32
    first = np.flatnonzero(np.diff(second, prepend=-1))
    best = n == np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(n))))
    ends = np.cumsum(p["m"].to_numpy())
    told = [pack_numbers(np.diff(pairs[own], prepend=0), n[own], best[own].astype(np.int64)) for own in np.split(place, ends[:-1])]
    return pd.DataFrame({"part": p["part"].to_numpy(), "m": p["m"].to_numpy(), "packed": told})


def summed(own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
    """The documents of a group with the sums over their links."""
    table, docs = own[own["kind"] == TABLE], own[own["kind"] == DOC]
    m, n_windows = int(table["m"].iloc[0]), int(table["n_a"].iloc[0])
    out = docs[["doc_id", "n_a", "n_b", "n_groups"]].astype({"n_a": np.int64, "n_b": np.int64, "n_groups": np.int64})
    n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    if n_windows:
        steps, lengths, place = unpack_numbers(table["packed"].iloc[0], [m, n_windows, int(table["n_b"].iloc[0])])
        pairs = np.cumsum(steps)
        got = [unpack_numbers(x, [k, k, k]) for x, k in zip(told["packed"], told["m"])]
        at = np.searchsorted(pairs, np.concatenate([np.cumsum(d) for d, _, _ in got]))
        values = np.zeros((2, m), np.int64)
        values[:, at] = np.concatenate([b for _, _, b in got]), np.concatenate([n for _, n, _ in got])
        starts = np.cumsum(lengths) - lengths
        best, count = (np.add.reduceat(v[place], starts) for v in values)
        for i, (packed, k) in enumerate(zip(docs["packed"], docs["m"])):
            (windows,) = unpack_numbers(packed, [int(k)])
            n_best[i], count_sum[i] = best[windows].sum(), count[windows].sum()
    return out.assign(n_links=out["n_groups"], n_best=n_best, count_sum=count_sum, groups_sha256=docs["groups_sha256"])


def public_paths() -> tuple[str, str, str]:
    """Files of the public vocabularies, the same on all machines."""
    import public_tokenizers

    return tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def align(docs: DataFrame, tokenizers: tuple[str, str, str] | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A space and the text are encoded by a byte-level BPE (`tokenizers`: ranks, the same as JSON) and by a piece model.
    Groups lie between bytes at which tokens of both end; the last tokens of a group are linked. n_best counts the links
    whose pair no pair of that piece exceeds in number over all documents, count_sum adds up the pairs' numbers.

    Null and empty texts, and those that a side can't spell byte for byte, have zeros and an empty digest. Repeated rows
    count each, null ids are kept, an empty table gives an empty result, other columns are ignored.
    """
    tokenizers = tokenizers or public_paths()
    base = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # a null would turn ids into floating point
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), -(-size // BUCKET_BYTES))
    rows = materialize(base.mapInPandas(lambda b: tokenised(b, tokenizers, buckets), ROW))
    packets = rows.filter(F.col("kind") == PAIRS).select("part", "bucket", "m", "packed")
    told = packets.groupBy("bucket").applyInPandas(counted, "part long, m long, packed binary")
    own = rows.filter(F.col("kind") != PAIRS).select("kind", "part", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "m", "packed")
    result = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(summed, result).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
