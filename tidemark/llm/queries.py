"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import alignment, codebooks, decontamination, extraction, fingerprints, jaccard, language_model, licenses, mixing, neighbours, quality, sharding, substrings
from .common import table


def op1_fourier_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs.select("doc_id", "text"), model).select("doc_id", (quality.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op2_template_extraction(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages"))


def op3_merkle_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op4_hilbert_shards(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_golden_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_relative_lempel_ziv(spark, sf_dir):
    return substrings.deduplicate(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_licence_digests(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_partial_matching(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


def op9_divide_skip(spark, sf_dir):
    return jaccard.link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_winnowing(spark, sf_dir):
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_multiprobe_hashing(spark, sf_dir):
    found = neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
    return found.select(F.col("vec_id").alias("query_id"), "rank", F.col("near_id").alias("vec_id"), F.col("distance").alias("score"))


def op12_anchor_windows(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_grid_cells(spark, sf_dir):
    return codebooks.encode(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_fourier_quality, op2_template_extraction, op3_merkle_fingerprints, op4_hilbert_shards, op5_golden_mix, op6_relative_lempel_ziv, op7_licence_digests, op8_partial_matching, op9_divide_skip, op10_winnowing, op11_multiprobe_hashing, op12_anchor_windows, op13_grid_cells)}

#: Every window of ten item words, held against every window of every document.
OP10_SQL = r"""
with item as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') w from benchmark),
win as (select distinct item_id, len(w[i:i + 9]) m, array_to_string(w[i:i + 9], ' ') g from item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) where len(w) > 0),
doc as (select row_number() over () k, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') w from documents),
own as (select k, i, m, array_to_string(w[i:i + m - 1], ' ') g from doc, (select distinct m from win) s, unnest(range(1, len(w) - m + 2)) t(i)),
hit as (select k, item_id, i, own.m from own join win using (g)),
n as (select k, count(distinct j) n_hit from hit, unnest(range(i, i + m)) t(j) group by k),
it as (select k, count(*) n_items, sha256(string_agg(id, ',' order by id)) items_sha256 from (select distinct k, item_id::varchar id from hit) group by k)
select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, coalesce(items_sha256, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 contaminated from doc left join n using (k) left join it using (k)
"""

def op7_sql() -> str:
    """Lines, blocks and whole texts against the digests of the known texts."""

    def canonical(c: str) -> str:
        c = f"lower(regexp_replace({c}, '{licenses.COPYRIGHT_LINE}', ' ', 'g'))"
        c = f"' ' || regexp_replace({c}, '[\x00-\x2F\x3A-\x60\x7B-\xBF]+', ' ', 'g') || ' '"
        for given, used in licenses.SPELLINGS.items():
            c = f"replace({c}, ' {given} ', ' {used} ')"
        return f"sha256(trim(regexp_replace({c}, ' +', ' ', 'g'), ' '))"

    digests = ", ".join(f"('{name}', '{digest}')" for name, digest in licenses.DIGESTS)
    known = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.KNOWN)
    return f"""
with raw(name, text) as (values {known}),
listed as (select digest, min(name) name from (select {canonical('text')} digest, name from raw union all select digest, name from (values {digests}) v(name, digest)) group by 1),
doc as (select row_number() over () k, doc_id, coalesce(text, '') text from documents),
unit as (select distinct k, u from doc, unnest(list_concat(regexp_split_to_array(text, '\n[ \t\r]*\n'), string_split(text, chr(10)))) t(u) where u <> ''),
met as (select distinct k, name from unit join listed on {canonical('u')} = digest),
said as (select k, string_agg(name, ',' order by name) notices, count(*) n_notices from met group by k)
select doc_id, {canonical('text')} digest, l.name licence, coalesce(notices, '') notices, coalesce(n_notices, 0) n_notices from doc left join said using (k) left join listed l on l.digest = {canonical('text')}
"""




def op3_sql() -> str:
    """The trees by nested lists, and the neighbour by a window over all documents."""
    leaf = f"regexp_extract_all(p, '(?s).{{1,{fingerprints.LEAF}}}')"

    def tree(t: str) -> str:
        paragraph = f"sha256(array_to_string(list_transform({leaf}, lambda l: sha256(l)), ''))"
        section = f"sha256(array_to_string(list_transform(string_split(s, chr(10)), lambda p: {paragraph}), '.'))"
        said = f"array_to_string(list_transform({leaf}, lambda l: left(sha256(l), {fingerprints.DIGITS})), '')"
        blocks = f"string_split({t}, chr(10) || chr(10))"
        root = f"sha256(array_to_string(list_transform({blocks}, lambda s: {section}), '/'))"
        return f"{root} || '/' || array_to_string(list_transform({blocks}, lambda s: '.' || array_to_string(list_transform(string_split(s, chr(10)), lambda p: {said}), '.')), '/')"

    def leaves(f: str) -> str:
        return f"list_distinct(regexp_extract_all(replace(replace(substr({f}, 65), '/', ''), '.', ''), '.{{{fingerprints.DIGITS}}}'))"

    def near(a: str, b: str) -> str:
        x, y = leaves(a), leaves(b)
        return f"case when left({a}, 64) = left({b}, 64) then 1.0::double else least(2 * len(list_intersect({x}, {y}))::double / greatest(len({x}) + len({y}), 1), 0.999999::double) end"

    return f"""
with d as (select doc_id, coalesce(text, '') t from documents),
n as (select doc_id, t, coalesce(lead(t) over (order by doc_id desc), first(t) over (order by doc_id desc)) u from d),
e as (select *, left(t, length(t) - length(t) // 2) || left(u, length(t) // 2) v from n),
f as (select doc_id, length(t) n_chars, sha256(v) edited_sha256, {tree('t')} fingerprint, {tree('v')} edited_fingerprint, {tree('u')} next_fingerprint from e)
select doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, {near('fingerprint', 'edited_fingerprint')} near_edited, {near('fingerprint', 'next_fingerprint')} near_next from f
"""


#: Words of a text, and the same with A-Z as a-z.
WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every window of twenty words, in order of its starts.
OP6_SQL = f"""
with d as (select doc_id, {WORDS_SQL} w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 19], ' ') g from d, unnest(range(1, len(w) - 18)) t(i)),
dup as (select doc_id, i from win qualify row_number() over (partition by g order by doc_id, i) > 1),
gone as (select distinct doc_id, j from dup, unnest(range(i, i + 20)) t(j)),
word as (select d.doc_id, j, w[j] x from d, unnest(range(1, len(w) + 1)) t(j)),
kept as (select doc_id, string_agg(x, ' ' order by j) s, count(*) n from word anti join gone using (doc_id, j) group by 1)
select doc_id, len(w) n_words, len(w) - coalesce(n, 0) n_removed, sha256(coalesce(s, '')) kept_sha256 from d left join kept using (doc_id)
"""

#: All pairs of documents that share a shingle, and what links reach.
OP9_SQL = f"""
with recursive d as (select doc_id, {WORDS_SQL.replace("coalesce(text, '')", f"coalesce({LOWER_SQL}, '')")} w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') g from d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0),
n as (select doc_id, count(*) n from sh group by 1),
both_ as (select a.doc_id a, b.doc_id b, count(*) c from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by all),
link as (select a, b from both_ join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
reach as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a),
least_ as (select a, min(b) b from reach group by 1)
select d.doc_id, coalesce(n, 0) n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) component_id from d left join n using (doc_id) left join least_ on a = d.doc_id
"""


def op13_sql() -> str:
    """Every part against every entry, a table for each round."""

    def nearest(k: int) -> str:
        apart = "list_sum(list_transform(list_zip(v, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
        return f"near{k} as materialized (select vec_id, label, p, v, min(struct_pack(d := {apart}, j := j)) n from part join book{k} using (p) group by all)"

    def moved(k: int) -> str:
        added = f"added{k} as (select p, n.j j, i, sum(v[i]) // count(*) - case when sum(v[i]) % count(*) < 0 then 1 else 0 end m from near{k}, unnest(range(1, len(v) + 1)) t(i) group by all)"
        return f"{added}, means{k} as (select p, j, list(m::bigint order by i) e from added{k} group by all), book{k + 1} as materialized (select p, j, coalesce(m.e, b.e) e from book{k} b left join means{k} m using (p, j))"

    steps = ", ".join(f"{nearest(k)}, {moved(k)}" for k in range(codebooks.ROUNDS)) + ", " + nearest(codebooks.ROUNDS)
    return f"""
with kept as (select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as materialized (select vec_id, label, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] v from kept, range(4) t(p)),
book0 as materialized (select p, dense_rank() over (order by vec_id) - 1 j, v e from part where vec_id in (select vec_id from kept order by vec_id limit 256)),
{steps},
coded as (select vec_id, label, string_agg(printf('%02x', n.j), '' order by p) code, sum(n.d)::bigint error from near{codebooks.ROUNDS} group by all)
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, (select sha256(string_agg(array_to_string(e, ','), ',' order by p, j)) from book{codebooks.ROUNDS}) codebooks_sha256 from coded
"""


ORACLE_SQL: dict[str, str] = {"op3_merkle_fingerprints": op3_sql(), "op6_relative_lempel_ziv": OP6_SQL, "op9_divide_skip": OP9_SQL, "op7_licence_digests": op7_sql(), "op10_winnowing": OP10_SQL, "op13_grid_cells": op13_sql()}

import corpus_pipeline  # noqa: E402  it stands at the top of the repository and counts as part of this subpackage

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
