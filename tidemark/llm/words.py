"""Hashing of words and word runs in numpy, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame

#: Bytes of text that are taken apart at once: bounds a task's memory.
CHUNK_BYTES = 3 << 20


def utf8(text: str | bytes | None) -> bytes:
    """A text, or what pack() made of one, as UTF-8; null is empty."""
    if isinstance(text, (bytes, bytearray)):
        return zstandard.ZstdDecompressor().decompress(bytes(text))
    return (text or "").encode("utf-8", "replace")


def pack(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` and `packed`, the text compressed: half of what a shuffle would write of it otherwise."""

    def squeeze(parts):
        squeezer = zstandard.ZstdCompressor(level=1)
        for p in parts:
            yield p[keep].assign(packed=[squeezer.compress(utf8(t)) for t in p["text"]])

    kept = docs.select(*keep, "text")
    return kept.mapInPandas(squeeze, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"] + ["packed binary"]))


def chunks(texts: list[str | bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, UTF-8 texts) for runs of texts of about `limit` bytes."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = utf8(text)
        if held and size + len(raw) > limit:
            yield at, held
            at, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield at, held


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Of so many bytes, 8 for each word, words are hashed at once; bounds what a long text takes beside its bytes.
BLOCK_BYTES = 1 << 19
#: Longer words are hashed one by one.
LONG_WORD = 256
IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: What of a number of 8 bytes its first 0 to 8 bytes are.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def weights(first: int, n: int) -> np.ndarray:
    """A random odd number for each of n places in a word from `first` on."""
    return mix(np.arange(first + 1, first + n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


WEIGHTS = weights(0, LONG_WORD // 8)


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts one after another, and each text's number of words.

    Words are what white space (U+0020, U+0009 to U+000D) leaves between. A word is read as numbers of 8 bytes, of which
    the last may be shorter. Its hash is made of its length and of the sum of these numbers, mixed with their places.
    """
    blob = b" ".join(raws) + b" " * 8
    b = np.frombuffer(blob, np.uint8)
    at = np.ndarray((len(b) - 7,), "<u8", blob, strides=(1,))  # the 8 bytes that start at a place
    space = IS_SPACE[b]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.r_[0, edges]
    starts, ends = edges[::2], edges[1::2]
    lengths = np.diff(np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raws)])))
    out, step = np.empty(len(starts), np.uint64), max(1, BLOCK_BYTES // 8)
    for i in range(0, len(starts), step):
        start = starts[i : i + step]
        n = ends[i : i + step] - start
        total = mix((at[start] & FIRST[np.minimum(n, 8)]) ^ WEIGHTS[0])
        more = np.flatnonzero((n > 8) & (n <= LONG_WORD))
        for k in range(1, LONG_WORD // 8):
            if not len(more):
                break
            total[more] += mix((at[start[more] + 8 * k] & FIRST[np.minimum(n[more] - 8 * k, 8)]) ^ WEIGHTS[k])
            more = more[n[more] > 8 * (k + 1)]
        for w in np.flatnonzero(n > LONG_WORD).tolist():
            total[w] = long_word(at, int(start[w]), int(n[w]))
        out[i : i + step] = mix(total + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out, lengths


def long_word(at: np.ndarray, start: int, n: int) -> np.uint64:
    """The sum over the numbers of 8 bytes of a word, as word_hashes() makes it."""
    total = np.zeros(1, np.uint64)
    for first in range(0, n, BLOCK_BYTES):
        here = min(n - first, BLOCK_BYTES)
        numbers = at[start + first : start + first + here : 8].copy()
        numbers[-1] &= FIRST[here - 8 * (len(numbers) - 1)]
        total += mix(numbers ^ weights(first // 8, len(numbers))).sum(dtype=np.uint64)
    return total[0]


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive numbers; place i holds the run that starts at i."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15 | 1) + h[j : j + n]
    return mix(out)


def shingle_lists(raws: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of shingle_sets() one after another, and the size of each."""
    h, lengths = word_hashes([r.lower() for r in raws])
    runs, first = run_hashes(h, k).view(np.int64), np.cumsum(lengths) - lengths
    n_runs = np.maximum(lengths - k + 1, 0)
    for a, n in zip(first[n_runs > 1].tolist(), n_runs[n_runs > 1].tolist()):
        runs[a : a + n].sort()
    new = np.ones(len(runs), bool)
    np.not_equal(runs[1:], runs[:-1], out=new[1:])
    new[first[n_runs > 0]] = True
    for j in range(1, k):  # runs that reach into another text
        over = (first + lengths - j)[lengths >= j]
        new[over[over < len(runs)]] = False
    upto = np.r_[0, np.cumsum(new)]
    sizes = upto[np.minimum(first + n_runs, len(runs))] - upto[np.minimum(first, len(runs))]
    flat, few = runs[new], np.flatnonzero((lengths > 0) & (n_runs == 0))
    if len(few):
        alone = np.concatenate([run_hashes(h[first[i] : first[i] + lengths[i]], int(lengths[i])) for i in few]).view(np.int64)
        flat = np.insert(flat, (np.cumsum(sizes) - sizes)[few], alone)
        sizes[few] = 1
    return flat, sizes


def shingle_sets(raws: list[bytes], k: int) -> Iterator[np.ndarray]:
    """For each text its distinct k-word shingles (A-Z as a-z), sorted signed hashes; of fewer words the run is one."""
    flat, sizes = shingle_lists(raws, k)
    ends = np.cumsum(sizes)
    for end, n in zip(ends.tolist(), sizes.tolist()):
        yield flat[end - n : end]


def pack_numbers(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as one compressed string; equal bytes of neighbours lie together."""
    planes = [np.ascontiguousarray(c.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack_numbers(packed: bytes, lengths: list[int]) -> list[np.ndarray]:
    """The columns again, of the given lengths."""
    raw, out, at = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(packed)), np.uint8), [], 0
    for n in lengths:
        out.append(np.ascontiguousarray(raw[at : at + 8 * n].reshape(8, n).T).reshape(-1).view(np.int64))
        at += 8 * n
    return out
