"""Main text of web pages by template deduction from equivalence classes.

A page is a row of tokens: its containers (with the path of containers around them) and its text blocks. Tokens of a
host that occur equally often on each of its pages, that is with the same occurrence vector, form an equivalence class.
Large, frequent classes that occur once a page are the host's template; their containers nest by path and leave slots
between them. Slots of menus, notices, adverts and the like are told by their names or by being mostly links, each by the
text that no smaller slot holds; text that itself belongs to the template is none of the article. What remains in the
article's slots is the main text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, within_bytes

# Element and class names by their meaning in HTML pages.
DROPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "math", "canvas", "select", "textarea", "title", "head"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "nobr", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HEADINGS_AND_LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "header"}
ASIDE_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "alert", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "site-header", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget"}
MAIN_TAGS = {"article", "main"}
MAIN_NAMES = {"article", "articlebody", "main"}

#: Markup: comments, declarations, tags (an unfinished one at the end of a page included).
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Share of a host's pages on which a token must stand to be frequent, and of link text above which a slot is a menu.
FREQUENT, LINKS = 0.6, 0.5
#: Share of a host's text outside links that the article's container holds at least, where none is named as such.
MOST = 0.7
#: Stands between the containers of a token; names hold no white space.
INSIDE = "\n"


def names_of(attributes: str) -> list[str]:
    """Words of the class, id and role attributes, without numbers."""
    if "=" not in attributes:
        return []
    found = " ".join("".join(m) for m in ATTRIBUTE.findall(attributes))
    return [re.sub(r"\d+", "", x).strip("-_").lower() for x in found.split()]


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters inside links) for each text block of a page in order; containers without text too, as
    blocks with an empty text. A path names the containers around the block, outermost first."""
    page = page or ""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, str]] = []
    piece: list[str] = []
    links, in_link, at, size = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal links
        text = " ".join(entities.unescape("".join(piece)).split()) if piece else ""
        if text:
            out.append((tuple(x[1] for x in stack), text, min(links, len(text))))
        piece.clear()
        links = 0

    while at < size:
        m = MARKUP.search(page, at)
        if m is None or m.start() > at:
            text = page[at : m.start() if m else size]
            piece.append(text)
            links += len(text) if in_link else 0
        if m is None:
            break
        at = max(m.end(), at + 1)
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in DROPPED:
            if not m[1] and not m[0].endswith("/>"):
                flush()
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style"):
                    break
            continue
        if tag == "a":
            in_link = 0 if m[1] else 1
            continue
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr"):
                piece.append(" ")
            continue
        flush()
        if m[1]:
            if any(x[0] == tag for x in stack):
                while stack.pop()[0] != tag:
                    pass
            in_link = 0
            continue
        if tag in HEADINGS_AND_LEAVES or stack and stack[-1][0] in HEADINGS_AND_LEAVES:  # an open paragraph ends here
            while stack and stack[-1][0] in HEADINGS_AND_LEAVES:
                stack.pop()
        if tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == tag:
            stack.pop()
        if not m[0].endswith("/>"):
            stack.append((tag, ".".join([tag, *names_of(m[3])])))
            out.append((tuple(x[1] for x in stack), "", 0))
    flush()
    return out


@lru_cache(1 << 14)
def is_aside(path: tuple[str, ...]) -> bool:
    """Whether a container around the block is named as something beside the article."""
    inside = False
    for x in path:
        tag, *names = x.split(".")
        words = [w for n in names for w in (n, *re.split(r"[-_]+", n))]
        if tag in ASIDE_TAGS and not (tag == "header" and inside) or any(w in ASIDE_NAMES for w in words) and tag not in ("html", "body"):
            return True
        inside = inside or tag in MAIN_TAGS
    return False


def is_main(container: str) -> bool:
    tag, *names = container.split(".")
    return tag in MAIN_TAGS or any(n.replace("-", "").replace("_", "") in MAIN_NAMES for n in names)


@lru_cache(1 << 14)
def place_of(path: tuple[str, ...]) -> int:
    """2 for a container of the article, 1 for what stands inside one, 0 for all else."""
    return 0 if not path or is_aside(path) else 2 if is_main(path[-1]) else int(any(map(is_main, path)))


def token(path: tuple[str, ...], text: str = "") -> str:
    """A container by its path, a text block by its path and a hash of its text."""
    return INSIDE.join(path) + ("\t" + hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest() if text else "")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


#: What is broadcast at most; more is shuffled.
BROADCAST_BYTES = 16 << 20
COUNTED = "host string, content long, token array<string>, times array<long>, chars array<long>, links array<long>, place array<int>"


def count_tokens(parts, by_name: bool):
    """For each page: a hash of what stands on it (equal for copies), and for each of its tokens how often it occurs,
    how much text, and text in links, stands in it and in no container further inside (without what goes by name), and
    its place. Copies inside a batch give one row."""
    for p in parts:
        got: dict[tuple[str, int], list] = {}
        for host, page in zip(p["host"], p["html"]):
            found = blocks(page)
            content = int.from_bytes(hashlib.blake2b(repr(found).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
            if (host, content) in got:
                continue
            seen: Counter = Counter()
            inside: dict[str, list[int]] = {}
            for path, text, links in found:
                sums = inside.setdefault(token(path), [0, 0, place_of(path) if by_name else 0])
                if text:
                    block = token(path, text)
                    seen[block] += 1
                    inside[block] = [0, 0, min(1, sums[2])]
                    if not (by_name and is_aside(path)):
                        sums[0] += len(text)
                        sums[1] += links
                else:
                    seen[token(path)] += 1
            chars, links, place = zip(*(inside[t] for t in seen)) if seen else ((), (), ())
            got[host, content] = [list(seen), list(seen.values()), list(chars), list(links), list(place)]
        yield pd.DataFrame([(*k, *v) for k, v in got.items()], columns=["host", "content", "token", "times", "chars", "links", "place"])


def templates(pages: DataFrame, broadcast_bytes: int, by_name: bool = True) -> DataFrame:
    """host -> slots: the containers of the host's template, with `menus` (mostly links), the one that holds `most` of
    the text, and fixed texts.

    pages: host, html. Pages of a host with the same blocks count once. Classes are the tokens of a host with the same
    vector; those of at least two tokens that stand once a page on most pages are the template. A host with one page has
    its containers as the template. Text inside a container of the article is never fixed. A slot is a menu by the text
    of which it is the innermost template container. Containers of the article, those around them, and of the slots
    inside the one with the most text outside links are never menus. A host's row is no longer than twice a mean page.
    """
    distinct = materialize(pages.mapInPandas(lambda parts: count_tokens(parts, by_name), COUNTED).dropDuplicates(["host", "content"]))
    hosts = materialize(distinct.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")))
    lists = F.arrays_zip("token", "times", "chars", "links", "place")
    each = distinct.select("host", "content", F.inline(lists))
    vector = F.bit_xor(F.xxhash64("content", "times"))  # nothing cancels, as contents differ
    tokens = each.groupBy("host", "token").agg(F.count(F.lit(1)).alias("pages"), *[F.sum(c).alias(c) for c in ("times", "chars", "links")], vector.alias("vector"), F.max("place").alias("place"))
    few_hosts = within_bytes(hosts, broadcast_bytes)
    frequent = F.col("pages") >= F.greatest(F.col("host_pages") * FREQUENT, F.least("host_pages", F.lit(2)))
    filled = (F.col("chars") > 0) | (F.col("place") == 2)
    listed = materialize(tokens.join(F.broadcast(hosts) if few_hosts else hosts, "host").filter(frequent | filled))
    often = listed.filter(frequent)
    classes = often.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("members"))
    valid = materialize(often.join(classes, ["host", "vector"]).filter("members >= 2 and times = pages").select("host", "token", "host_pages", "place"))
    is_text = F.contains(F.col("token"), F.lit("\t"))

    slots = valid.filter(~is_text).groupBy("host").agg(F.collect_list("token").alias("slots"))
    few_slots = within_bytes(slots, broadcast_bytes)
    around = F.filter("slots", lambda c: (c == F.col("token")) | F.startswith(F.col("token"), F.concat(c, F.lit(INSIDE))))
    nested = listed.filter(filled).join(F.broadcast(slots) if few_slots else slots, "host").select("host", "chars", "links", "place", around.alias("around")).filter(F.size("around") > 0)
    innermost = F.array_max("around")  # the longest, as all begin one token
    held = nested.groupBy("host", innermost.alias("token")).agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    guarded = nested.filter("place = 2").select("host", F.explode("around").alias("token")).distinct().withColumn("guarded", F.lit(True))
    # the innermost container around most of the host's text outside links; two such are nested, so the longest path
    text_of = nested.select("host", (F.col("chars") - F.col("links")).alias("said"), F.explode("around").alias("token"))
    text_of = text_of.groupBy("host", "token").agg(F.sum("said").alias("said"))
    whole = nested.groupBy("host").agg(F.sum(F.col("chars") - F.col("links")).alias("all"))
    no_leaf = ~F.col("token").rlike(rf"(?:^|{INSIDE})(?:{'|'.join(sorted(HEADINGS_AND_LEAVES))})(?:\.[^{INSIDE}]*)?$")
    most = text_of.join(F.broadcast(whole) if few_hosts else whole, "host").filter((F.col("said") >= MOST * F.col("all")) & (F.col("said") > 0) & no_leaf)
    most = most.groupBy("host").agg(F.max_by("token", F.length("token")).alias("most"))
    outside_links = F.struct(F.col("chars") - F.col("links"), F.col("token"))
    return (
        valid.join(held, ["host", "token"], "left").join(guarded, ["host", "token"], "left").groupBy("host").agg(
            F.collect_list(F.when(~is_text & F.col("guarded").isNull() & (F.col("links") > F.col("chars") * LINKS), F.col("token"))).alias("menus"),
            F.max(F.when(~is_text & (F.col("place") > 0), outside_links))["token"].alias("body"),
            F.collect_list(F.when(~is_text, F.col("token"))).alias("containers"),
            F.collect_list(F.when(is_text & (F.col("place") == 0) & (F.col("host_pages") >= 4), F.col("token"))).alias("texts"),
        ).select("host", F.filter("menus", lambda m: ~m.eqNullSafe(F.col("body"))).alias("menus"), "containers", "texts")
        .join(F.broadcast(most) if few_slots else most, "host", "left")  # a slot for each host
    )


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, by_name: bool = True) -> DataFrame:
    """A row for each row of pages: page_id, url, text, n_chars.

    Pages of a host share a template; each block belongs to the innermost template container around it, its slot.
    Blocks in slots beside the article, in menus, and template texts go. Of the rest those inside a container of the
    article stay if the page has one: one that is named so, or else the innermost template container around most of the
    host's text outside links, with the page's first-order headings ahead of it. Names tell asides and articles where
    they are known (`by_name`); without, the template alone decides. Text that stands on most pages is told from the
    article's own only on hosts with four different pages or more; with fewer, names, links and the share of text
    decide. White space inside a block becomes one space, blocks are joined by two line feeds. Null or empty pages, and
    pages without an article text, have an empty text; a null url counts as one host; repeated rows keep their own
    results and, like all copies of a page on its host, count once for the template; other columns are ignored. A hot
    host's pages stay spread: only counts are gathered by host.
    """
    base = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    known = materialize(templates(base.select("host", "html"), broadcast_bytes, by_name))
    told = base.join(F.broadcast(known) if within_bytes(known, broadcast_bytes) else known, "host", "left")

    def pick(parts):
        for p in parts:
            texts = []
            for page, menus, containers, fixed, most in zip(p["html"], p["menus"], p["containers"], p["texts"], p["most"]):
                menus, containers, fixed = (set(x) if x is not None else set() for x in (menus, containers, fixed))
                around = tuple(most.split(INSIDE)) if most else None
                found = [(path, text) for path, text, _ in blocks(page) if text and not (by_name and is_aside(path))]

                def in_slot(path: tuple[str, ...]) -> bool:
                    slot = next((t for t in (token(path[:i]) for i in range(len(path), 0, -1)) if t in containers), None)
                    return slot not in menus

                kept = [(path, text) for path, text in found if in_slot(path) and token(path, text) not in fixed]
                inner = [(path, text) for path, text in kept if by_name and any(map(is_main, path))]
                if not inner and around:
                    here = [path[: len(around)] == around for path, _ in kept]
                    begun = here.index(True) if True in here else 0
                    inner = [x for i, x in enumerate(kept) if here[i] or i < begun and (x[0] or ("",))[-1].split(".")[0] == "h1"] if True in here else []
                texts.append("\n\n".join(text for _, text in inner or kept))
            yield pd.DataFrame({"page_id": p["page_id"], "url": p["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return told.select("page_id", "url", "html", "menus", "containers", "texts", "most").mapInPandas(pick, "page_id long, url string, text string, n_chars long")
