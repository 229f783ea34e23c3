"""Substring deduplication by relative Lempel-Ziv parsing against the whole corpus, block by block.

Every document is factored against all earlier text: a factor is a run of words that also stands earlier, and one of at
least WINDOW words is a duplicate span. The reference is indexed by winnowed grams: of the GRAM-word grams in a window
the smallest hash is its anchor, so equal windows have equal anchors. Anchors route windows to the block of the index
that holds all windows with that anchor; there each window finds its first place, and windows that follow each other
both here and there extend to a match. A document's matches from all blocks are then parsed greedily, longest first from
left to right, and windows over the seam of two factors are checked, so that a cut loses none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, materialize, most_frequent
from .words import CHUNK_BYTES, run_hashes, word_hashes

WINDOW, GRAM = 20, 8
#: So many of the most frequent anchors are split by window. It bounds what is broadcast; the result doesn't depend on it.
SPLIT_ANCHORS = 100_000


def in_chunks(p: pd.DataFrame):
    """Slices of a batch of about CHUNK_BYTES of text, each with its texts as UTF-8."""
    raws = [(t or "").encode("utf-8", "replace") for t in p["text"]]
    ends = np.cumsum([len(r) for r in raws]) // CHUNK_BYTES
    for part in np.unique(ends):
        rows = np.flatnonzero(ends == part)
        yield p.iloc[rows], [raws[i] for i in rows]


def windows(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the texts in order: text, first word, hash, anchor's place in all words, anchor's hash."""
    h, lengths = word_hashes(raws)
    if len(h) < WINDOW:
        return (np.zeros(0, np.int64),) * 5
    text = np.repeat(np.arange(len(raws)), lengths)
    n = len(h) - WINDOW + 1
    inside = text[:n] == text[WINDOW - 1 :]
    grams = run_hashes(h, GRAM)
    at = np.arange(n) + np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1).argmin(axis=1)
    first = np.cumsum(lengths) - lengths
    whole = run_hashes(h, WINDOW).view(np.int64)
    at = at[inside]
    return text[:n][inside], (np.arange(n) - first[text[:n]])[inside], whole[inside], at, grams.view(np.int64)[at]


def anchors(parts):
    """(spread, anchor, text_hash, known): anchors that another text may have, or that are known to repeat.

    Of the texts of a batch with the same anchor two tell the others; if there are several, or one repeats it, they are
    known already and need no partner elsewhere.
    """
    for p in parts:
        got = []
        for rows, raws in in_chunks(p):
            text, _, _, at, anchor = windows(raws)
            once = np.flatnonzero(np.diff(at, prepend=-1) != 0)
            got.append((anchor[once], rows["text_hash"].to_numpy(np.int64)[text[once]]))
        anchor, text_hash = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.int64),) * 2
        if not len(anchor):
            continue
        order = np.lexsort((text_hash, anchor))
        anchor, text_hash = anchor[order], text_hash[order]
        new_pair = np.r_[True, (anchor[1:] != anchor[:-1]) | (text_hash[1:] != text_hash[:-1])]
        first = np.r_[True, anchor[1:] != anchor[:-1]]
        group = np.cumsum(first) - 1
        repeats = np.bincount(group)[group] > 1
        last = np.r_[first[1:], True]
        known = new_pair & repeats
        ask = first | (last & (text_hash != text_hash[np.flatnonzero(first)][group]))
        yield pd.DataFrame({"anchor": np.r_[anchor[ask], anchor[known]], "text_hash": np.r_[text_hash[ask], text_hash[known]], "known": np.r_[np.zeros(ask.sum(), bool), np.ones(known.sum(), bool)]})


def first_of(x: np.ndarray) -> np.ndarray:
    """For each place the first place with the same number."""
    code, known = pd.factorize(x)
    origin = np.zeros(len(known), np.int64)
    origin[code[::-1]] = np.arange(len(x))[::-1]
    return origin[code]


def runs_of(doc: np.ndarray, text_hash: np.ndarray, at: np.ndarray, ref: np.ndarray, ref_at: np.ndarray) -> pd.DataFrame:
    """Windows that repeat earlier ones, joined where both sides go on by one word."""
    new = np.r_[True, (doc[1:] != doc[:-1]) | (text_hash[1:] != text_hash[:-1]) | (at[1:] != at[:-1] + 1) | (ref[1:] != ref[:-1]) | (ref_at[1:] != ref_at[:-1] + 1)][: len(doc)]
    starts = np.flatnonzero(new)
    return pd.DataFrame({"doc_id": doc[starts], "text_hash": text_hash[starts], "at": at[starts], "n": np.diff(np.r_[starts, len(doc)]), "ref": ref[starts], "ref_at": ref_at[starts]})


FOUND = "doc_id long, text_hash long, at long, n long, ref long, ref_at long"


def repeated_runs(docs: DataFrame, first: DataFrame, split_anchors: int = SPLIT_ANCHORS) -> DataFrame:
    """doc_id, text_hash, at, n, ref, ref_at: from word `at`, n windows repeat those from word `ref_at` of `ref`.

    docs: doc_id, text, text_hash; first: text_hash, first_id, the document that stands for equal texts. All windows of
    those documents that start earlier too (smaller doc_id, or the same document and an earlier word) are covered; one
    earlier place is named for each.
    """
    spark = docs.sparkSession
    asked = docs.select("text", "text_hash").mapInPandas(anchors, "anchor long, text_hash long, known boolean")
    asked = asked.withColumn("spread", F.when(F.col("known"), F.xxhash64("text_hash", "anchor")).otherwise(F.col("anchor")))
    group = Window.partitionBy("spread", "known")
    shared = asked.withColumn("low", F.min("text_hash").over(group)).withColumn("high", F.max("text_hash").over(group)).filter("known or low < high")
    shared = materialize(shared.select("anchor", "text_hash", "known"))
    hot = most_frequent(shared.groupBy("anchor").count(), "count", split_anchors, 256).toPandas()  # split_anchors rows at most
    held = spark.sparkContext.broadcast(np.sort(hot["anchor"].to_numpy(np.int64)))
    flagged = shared.groupBy("text_hash").agg(F.collect_set("anchor").alias("anchors"))
    flagged = flagged.join(first, "text_hash").withColumnRenamed("first_id", "doc_id")
    wanted = docs.join(flagged, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "anchors")

    def post(parts):
        """Rows (block, doc_id, text_hash, at, hashes, ref, ref_at): windows to look up, or, with ref, windows found."""
        split = held.value
        for p in parts:
            p = p.sort_values(["doc_id", "text_hash"])
            for rows, raws in in_chunks(p):
                text, first, whole, at, anchor = windows(raws)
                hits = np.zeros(len(text), bool)
                bounds = np.searchsorted(text, np.arange(len(raws) + 1))
                for i, own in enumerate(rows["anchors"]):
                    hits[bounds[i] : bounds[i + 1]] = np.isin(anchor[bounds[i] : bounds[i + 1]], own)
                text, first, whole, at, anchor = (x[hits] for x in (text, first, whole, at, anchor))
                doc, text_hash = rows["doc_id"].to_numpy(np.int64)[text], rows["text_hash"].to_numpy(np.int64)[text]
                origin = first_of(whole)
                ref, ref_at = doc[origin], first[origin]
                here = (ref != doc) | (text_hash[origin] != text_hash) | (ref_at != first)
                if here.any():
                    found = runs_of(doc[here], text_hash[here], first[here], ref[here], ref_at[here])
                    yield found.assign(block=found["text_hash"], hashes=None)
                doc, text_hash, first, whole, at, anchor = (x[~here] for x in (doc, text_hash, first, whole, at, anchor))
                if not len(doc):
                    continue
                alone = np.isin(anchor, split)
                new = np.r_[True, (doc[1:] != doc[:-1]) | (text_hash[1:] != text_hash[:-1]) | (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)] | alone
                starts = np.flatnonzero(new)
                ends = np.r_[starts[1:], len(doc)]
                raw = whole.tobytes()
                yield pd.DataFrame({"block": np.where(alone, whole, anchor)[starts], "doc_id": doc[starts], "text_hash": text_hash[starts], "at": first[starts], "n": 0, "hashes": [raw[8 * a : 8 * b] for a, b in zip(starts, ends)], "ref": 0, "ref_at": 0})

    posted = wanted.mapInPandas(post, f"block long, {FOUND}, hashes binary")
    blocks = posted.repartition("block").sortWithinPartitions("block", "doc_id", "text_hash", "at")

    def look_up(parts):
        """The index block by block: each window's first place, whatever batch of rows it comes in."""
        block, places = None, {}
        for p in parts:
            found = p[p["hashes"].isna()]
            if len(found):
                yield found[["doc_id", "text_hash", "at", "n", "ref", "ref_at"]]
            p = p[p["hashes"].notna()]
            if not len(p):
                continue
            sizes = np.fromiter((len(x) // 8 for x in p["hashes"]), np.int64, len(p))
            whole = np.frombuffer(b"".join(p["hashes"]), np.int64)
            row = np.repeat(np.arange(len(p)), sizes)
            step = np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            doc, text_hash = p["doc_id"].to_numpy(np.int64)[row], p["text_hash"].to_numpy(np.int64)[row]
            at, keys = p["at"].to_numpy(np.int64)[row] + step, p["block"].to_numpy(np.int64)
            origin = first_of(whole)
            ref, ref_at, ref_text = doc[origin], at[origin], text_hash[origin]
            if keys[0] == block:
                for i in np.flatnonzero(row < np.searchsorted(keys, block, side="right")).tolist() if places else []:
                    if (got := places.get(int(whole[i]))) is not None:
                        ref[i], ref_at[i], ref_text[i] = got
            else:
                places = {}
            if keys[-1] != block:
                places = {}
            block = int(keys[-1])
            dup = (ref != doc) | (ref_at != at) | (ref_text != text_hash)  # a repeated row meets itself
            for i in np.flatnonzero((row >= np.searchsorted(keys, block)) & ~dup).tolist():
                places[int(whole[i])] = (int(doc[i]), int(at[i]), int(text_hash[i]))
            if dup.any():
                yield runs_of(doc[dup], text_hash[dup], at[dup], ref[dup], ref_at[dup])

    return blocks.mapInPandas(look_up, FOUND)


def factors(runs: list) -> list[tuple[int, int, int, int]]:
    """Greedy parse: (first word, words, ref, first word there) for factors of at least WINDOW words, left to right.

    runs: (at, n, ref, ref_at) as of repeated_runs, in pieces by the block of the index that they were found in; pieces
    that go on both here and there are extended to one match. From where the last factor ends the longest one that begins there is
    taken. At a seam where none begins, windows across it are factors too: the one that reaches farthest is taken from
    the first of its windows that ends behind the seam. Words that no factor reaches stay literal. Factors so cover
    every window that repeats.
    """
    matches: list[list[int]] = []
    for ref, ahead, at, n in sorted((r["ref"], r["ref_at"] - r["at"], r["at"], r["n"]) for r in runs):
        last = matches[-1] if matches else None
        if last and last[2:] == [ref, ahead] and at <= last[0] + last[1]:
            last[1] = max(last[1], at + n - last[0])
        else:
            matches.append([at, n, ref, ahead])
    out: list[tuple[int, int, int, int]] = []
    end, best, reach = -1, None, -1
    for r in [*sorted((at, n, ref, at + ahead) for at, n, ref, ahead in matches), None]:
        while best is not None and reach > end and (r is None or r[0] > end):  # all that begin at or before the seam are known
            at, n, ref, ref_at = best
            start = end if at <= end < at + n else max(at, end - WINDOW + 1)
            out.append((start, reach - start, ref, ref_at + start - at))
            end = reach
        if r is not None:
            if r[0] > end:
                end = r[0]  # literals up to here
            if r[0] + r[1] + WINDOW - 1 > reach:
                best, reach = r, r[0] + r[1] + WINDOW - 1
    return out


#: Stands for a null doc_id: such documents come last.
NAMELESS = (1 << 63) - 1


def deduplicate(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_removed, kept_sha256, text, spans, factors.

    A word goes if a window of 20 words that covers it also starts earlier: in a document with a smaller doc_id, or
    earlier in the same one; windows are judged on the input. `factors` are the factors of at least 20 words of the
    greedy parse (first word, words, doc_id of the earlier place, first word there), `spans` the removed runs (first
    word, end), `text` holds the kept words joined by one space. Of equal texts all but the first go whole (if they have
    a window). Rows equal in doc_id and text are one document and share its result; rows with equal doc_id and other
    texts are ordered by a hash of the text. Rows without a doc_id come after all others. Null and empty texts have no
    words; texts without a window stay whole; other columns are ignored.
    """
    base = docs.select(F.coalesce("doc_id", F.lit(NAMELESS)).cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    ids = materialize(base.select("doc_id", "text_hash").distinct())
    first = materialize(ids.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    status = materialize(join_counted(ids, first, ["text_hash"], "copies"))
    runs = repeated_runs(base, first.drop("copies"))
    runs = runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("at", "n", "ref", "ref_at")).alias("runs"))
    own = status.join(runs, ["doc_id", "text_hash"], "left")
    told = base.join(own, ["doc_id", "text_hash"]).select("doc_id", "text", "first_id", "runs")

    def cut(parts):
        for p in parts:
            out = []
            for doc_id, text, first_id, runs in zip(p["doc_id"].tolist(), p["text"], p["first_id"].tolist(), p["runs"]):
                words = (text or "").encode("utf-8", "replace").split()
                if doc_id != first_id:
                    found = [(0, len(words), first_id, 0)] if len(words) >= WINDOW else []
                else:
                    found = factors(runs) if runs is not None else []
                gone = np.zeros(len(words), bool)
                for at, n, _, _ in found:
                    gone[at : at + n] = True
                kept = b" ".join(w for w, c in zip(words, gone) if not c)
                edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                named = [(at, n, None if ref == NAMELESS else ref, ref_at) for at, n, ref, ref_at in found]
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"), edges.reshape(-1, 2).tolist(), named))
            cols = list(zip(*out)) if out else [[]] * 6
            yield pd.DataFrame({"doc_id": p["doc_id"].to_numpy(), "n_words": cols[0], "n_removed": cols[1], "kept_sha256": cols[2], "text": cols[3], "spans": cols[4], "factors": cols[5]})

    done = told.mapInPandas(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, text string, spans array<array<long>>, factors array<array<long>>")
    return done.withColumn("doc_id", F.when(F.col("doc_id") != NAMELESS, F.col("doc_id")))
