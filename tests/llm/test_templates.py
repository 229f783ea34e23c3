"""Main text on hosts whose pages are mostly links, and on hosts of copies."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import extraction


def texts(spark, pages):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in extraction.extract(df).collect()}


def links(n, word="Read about the matter of number"):
    return "".join(f"<li><a href=/{i}>{word} {i}</a></li>" for i in range(n))


def test_long_menus_and_a_short_article(spark):
    def page(n, tag):
        return f"<html><body><div class=topics><ul>{links(60)}</ul></div><{tag}><h1>Title {n}</h1><p>Body {n} of few words</p></{tag}><div class=more><ul>{links(40, f'More on {n}')}</ul></div></body></html>"

    for tag in ("article", "main", "div"):
        want = {i: f"Title {i}\n\nBody {i} of few words" for i in range(6)}
        assert texts(spark, [page(i, tag) for i in range(6)]) == want, tag
        assert texts(spark, [page(0, tag)]) == {0: want[0]}, tag


def test_menus_by_name_leave_the_slot_around_them_alone(spark):
    """Neither the menu nor the story is a template container, so both stand in the slot of the body."""
    pages = [f"<html><body><nav class={'abcdef'[i] * 3}>{links(30)}</nav><div class={'abcdef'[i]}story><p>Story {i}</p></div></body></html>" for i in range(6)]
    assert texts(spark, pages) == {i: f"Story {i}" for i in range(6)}


def test_articles_full_of_links(spark):
    def page(n, inner):
        body = "".join(f"<p>See <a href=/{k}>the long name of a linked thing {n} {k}</a> too</p>" for k in range(3))
        related = f"<ul class=others>{links(9, f'Another of {n}')}</ul>"
        return f"<html><body><article><h1>Title {n}</h1>{f'<div class=text>{body}</div>{related}' if inner else body}</article></body></html>"

    for inner in (False, True):
        want = {i: "\n\n".join([f"Title {i}", *[f"See the long name of a linked thing {i} {k} too" for k in range(3)]]) for i in range(6)}
        assert texts(spark, [page(i, inner) for i in range(6)]) == want


def story(n, tag="article"):
    return f"<html><body><div class=top>Some site</div><{tag} class=story><h1>Title {n}</h1><p>Body of {n}</p></{tag}><div class=end>Same words on each page</div></body></html>"


def test_copies_of_a_page_count_once(spark):
    want = "Title {0}\n\nBody of {0}"
    assert texts(spark, [story(0)] * 5) == {i: want.format(0) for i in range(5)}
    for tag in ("article", "div"):  # mostly one article, and each of them evenly repeated
        for which in ([0] * 9 + [1, 2, 3], [0, 1, 2, 3] * 2):
            assert texts(spark, [story(n, tag) for n in which]) == {i: want.format(n) for i, n in enumerate(which)}, (tag, which)


def test_repeated_rows_keep_their_own_results(spark):
    pages = spark.createDataFrame([(n, f"http://h.example/{n}", story(n, "div")) for n in range(5)] * 4, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"]) for r in extraction.extract(pages).collect())
    assert got == [(n, f"Title {n}\n\nBody of {n}") for n in range(5) for _ in range(4)]


def test_text_of_near_copies_of_an_article_stays(spark):
    pages = [story(0).replace("Some site", f"Visitor {i}") for i in range(6)]
    assert texts(spark, pages) == {i: "Title 0\n\nBody of 0" for i in range(6)}


def test_template_alone_gives_what_names_give(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    named, alone = ({r["page_id"]: r["text"] for r in extraction.extract(pages, by_name=n).collect()} for n in (True, False))
    assert named == alone and all(named.values())


def test_names_without_meaning(spark):
    """The same pages with elements and classes that tell nothing: only occurrence vectors part article and frame."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    plain = pages
    for tag in ("article", "nav", "footer", "header", "aside", "main", "section"):
        plain = plain.withColumn("html", F.regexp_replace("html", rf"<{tag}\b[^>]*>", f'<div class="k{len(tag)}{tag[1]}q">')).withColumn("html", F.regexp_replace("html", f"</{tag}>", "</div>"))
    plain = plain.withColumn("html", F.regexp_replace("html", r'class="(?:ad|comments?|sidebar|cookie)[^"]*"', 'class="zz"'))
    want, got = ({r["page_id"]: r["text"] for r in extraction.extract(p).collect()} for p in (pages, plain))
    assert plain.filter("html like '%<article%' or html like '%<nav%' or html like '%<footer%'").count() == 0
    assert np.mean([got[k] == want[k] for k in want]) > 0.98


def test_a_heading_ahead_of_the_text(spark):
    page = lambda n: f"<div class=qa><ul>{links(9)}</ul></div><div class=qb><h1>Title {n}</h1><div class=qc>by {n}</div><div class=qd><p>{'many words of text ' * n}</p><p>end {n}</p></div></div><div class=qe>Terms {n}</div>"
    assert texts(spark, [page(n) for n in range(40, 46)]) == {i: f"Title {n}\n\n{('many words of text ' * n).strip()}\n\nend {n}" for i, n in enumerate(range(40, 46))}


def test_classes_by_brute_force(spark):
    rng = random.Random(12)

    def page(n):
        parts = [f"<div class=c{'abcdef'[k]}><p>{rng.choice(['fixed', f'own {n} {k}'])} {k}</p></div>" for k in range(6) if rng.random() < 0.9]
        return f"<html><body><div class=top>Site</div>{''.join(parts)}<div class=end>Bye</div></body></html>"

    rows = [(i, f"http://h{i % 3}.example/{i}", page(i)) for i in range(36)]
    got = {r["host"]: r for r in extraction.templates(spark.createDataFrame([(f"h{i % 3}", h) for i, _, h in rows], "host string, html string"), 100).collect()}
    for host in ("h0", "h1", "h2"):
        pages = {tuple(extraction.blocks(h)) for i, _, h in rows if f"h{i % 3}" == host}
        counts = [Counter(extraction.token(path, text) for path, text, _ in p) for p in pages]
        # the container of a block is counted where it opens, as a block without text
        vectors = {t: tuple(c[t] for c in counts) for t in set().union(*counts)}
        frequent = {t: v for t, v in vectors.items() if sum(map(bool, v)) >= max(0.6 * len(pages), 2)}
        members = Counter(frequent.values())
        valid = {t for t, v in frequent.items() if members[v] >= 2 and max(v) == 1}
        assert set(got[host]["containers"]) == {t for t in valid if "\t" not in t}
        assert set(got[host]["texts"]) == {t for t in valid if "\t" in t}


def test_what_is_too_large_to_broadcast_is_shuffled(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(extraction.extract(pages, broadcast_bytes=0)) == rows(extraction.extract(pages))
