"""Main text of web pages by consensus host paths.

1. Every page's containers are scored: characters of running text directly in their blocks, less
   what is in links. A container's path is the tags and classes from the root down, generalised:
   digits become 0 and positions are left out, so pages of one template have equal paths.
   The container with the highest score is lifted to the one around it that holds the whole article:
   its article or main element, else what adds its headline or further running text.
2. The pages of a host vote with their scores, in Spark: the path with most votes, and each that
   has at least ``SHARE`` of its votes and is not inside another winner, are the host's paths.
3. Every page is read again. Its text is what its containers at its host's paths hold; a page with
   none of them uses its own best container.

Navigation, headers, footers, asides, adverts, notices, scripts and styles are left out wherever they are, by tag or
role; one in the middle of a paragraph does not end it. A class or id whose whole name is one of such
parts, or of comments of readers, leaves an element out inside a winning container, and so does a form, but never one that is
or holds the container or a heading; of paragraphs and their parts only names of adverts do. A word of such a name
only lowers its score. A headline in a container of its own ahead of the article is voted for with it. Character references are decoded,
white space inside a block becomes one space, blocks are joined by line ends in page order. A
heading is a block, ``br`` is white space.

Winning paths are joined by host; adaptive execution splits hosts with many pages and broadcasts
the paths where they are measured small.

Defined results: a null or empty page has empty text. A null url, or one without a host, belongs to
the host "". Broken markup is read as far as it goes: unclosed and crossed tags close at the next
fitting end. Equal rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclerlake.llm.common import landed
from cyclerlake.llm.url_filter import host_of

SHARE = 0.25
# a block of so many characters is running text
RUNNING = 80

# fixed values: names of HTML
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "head script style title noscript template iframe svg math canvas object embed audio video map nav header footer aside button select "
    "option input textarea fieldset dialog menu xmp noembed noframes".split()
)
# of these, the ones that may stand in the middle of a paragraph
PHRASING = frozenset("script style noscript template iframe svg math canvas object embed audio video map button select option input textarea".split())
SOFT = INLINE | PHRASING
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
# words of class names and ids
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion "
    "related respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe teaser toolbar topbar widget widgets".split()
)
# of these, the ones that speak against a paragraph or a part of one too
ADS = frozenset("ad ads advert adverts advertisement advertising adbox promo promoted promotion sponsor sponsored".split())
# words that leave such a name what it is
PLAIN = frozenset("area articles bar block bottom box button buttons container count form inner item items left link links list outer post posts reader readers right section slot stories thread threads top unit user users wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements whose names say nothing
KEPT = frozenset("html body article main p h1 h2 h3 h4 h5 h6".split())
# an end of p is understood before these
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tr article section div body main td select".split())

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>][^\s>]*)))?")
_READ = frozenset("class id role hidden aria-hidden".split())
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_NESTED = re.compile(r"<!--|<script|<style", re.I)


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    linked: int
    # depths of the elements around it that a whole name speaks against, and what names add up to
    named: tuple[int, ...] = ()
    doubts: int = 0
    # of a heading, 1 to 6
    level: int = 0


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text) if text.strip(" /") else ():
        if (name := m[1].lower()) in _READ:
            out.setdefault(name, m[2] or m[3] or m[4] or "")
    return out


def _unwanted(tag: str, attributes: dict[str, str], path: list[str]) -> bool:
    if tag in DROPPED:
        # the heading of an article is its own
        return not (tag == "header" and any(p.split(".")[0] in ("article", "main") for p in path))
    # a page's root may be hidden until its scripts have run
    if not attributes or tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or attributes.get("role", "").lower() in ROLES:
        return True
    if tag == "p" or tag in INLINE:
        told = [_WORDS.findall(name) for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()]
        return any(not ADS.isdisjoint(words) and all(w in ADS or w in PLAIN for w in words) for words in told)
    return False


def _named(tag: str, attributes: dict[str, str], path: list[str]) -> int:
    """Whether class or id speak against an element: 2 by a whole name, 1 by a word in one, else 0.

    A form is such an element by its tag: one around the whole page holds the container and stays.
    """
    if tag == "form":
        return 2
    if not attributes or tag in INLINE or tag in KEPT:
        return 0
    told = 0
    own_head = any(p.split(".")[0] in ("article", "main") for p in path)
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = _WORDS.findall(name)
        if NAMES.isdisjoint(words) or (own_head and "header" in words):
            continue
        if len(words) == 1 or ("header" not in words and all(w in NAMES or w in PLAIN for w in words)):
            return 2
        told = 1
    return told


@cache
def _ends(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I)


def _end_of(page: str, tag: str, at: int) -> int:
    """Where the element ends that begins before ``at``; 0 if that takes a closer look."""
    depth = 1
    for mark in _ends(tag).finditer(page, at):
        if tag in RAW and not mark[1]:
            continue
        depth += -1 if mark[1] else 1
        if not depth:
            return mark.end() if tag in RAW or not _NESTED.search(page, at, mark.start()) else 0
    return 0


def blocks(page: str) -> list[Block]:
    """The blocks of a page with the paths of their containers, in page order; unwanted parts are left out."""
    out: list[Block] = []
    tags: list[str] = []
    steps: list[str] = []
    names: list[int] = []
    drop = 0  # so many open tags down to the one that is left out
    links = linked = 0
    text: list[str] = []
    at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                path = tuple(s for t, s in zip(tags, steps) if t not in SOFT)
                told = [n for t, n in zip(tags, names) if t not in SOFT] if any(names) else []
                head = next((t for t in reversed(tags) if t in HEADINGS), "h0")
                while path and path[-1].split(".")[0] in TEXT_TAGS:
                    path = path[:-1]
                out.append(Block(path, words, linked, tuple(d for d, n in enumerate(told, 1) if n == 2), sum(told), int(head[1])))
            text.clear()
        linked = 0

    def close(to: int) -> None:
        """Closes open tags from number ``to`` on."""
        nonlocal drop, links
        if any(t not in SOFT for t in tags[to:]):
            flush()
        links -= tags[to:].count("a")
        del tags[to:], steps[to:], names[to:]
        if drop > to:
            drop = 0

    size = len(page)
    while at < size:
        mark = _MARK.search(page, at)
        # a plain < before the next mark is text
        start = mark.start() if mark else size
        if start > at and not drop:
            part = page[at:start]
            text.append(part)
            if links:
                linked += len(part)
        if not mark:
            break
        at = mark.end()
        name = mark[2]
        if name is None:
            continue
        tag = name.lower()
        if mark[1]:
            if tag in tags:
                to = len(tags) - 1 - tags[::-1].index(tag)
                # an inline end does not close blocks around it
                if tag not in INLINE or all(t in SOFT for t in tags[to:]):
                    close(to)
            elif tag == "br" and not drop:
                text.append(" ")
            continue
        if tag == "br":
            if not drop:
                text.append(" ")
            continue
        if tag not in SOFT and not drop:
            flush()
        if tag in VOID:
            continue
        if tag in ENDS_P and "p" in tags:
            to = len(tags) - 1 - tags[::-1].index("p")
            if not any(t in SCOPES for t in tags[to:]):
                close(to)
        elif tag in SIBLINGS:
            for i in range(len(tags) - 1, -1, -1):
                if tags[i] in SIBLINGS[tag]:
                    close(i)
                    break
                if tags[i] in SCOPES:
                    break
        if tag in RAW:
            if end := _end_of(page, tag, at):
                at = end
                continue
            if tag in ("script", "style"):  # never closed
                break
        attributes = _attributes(mark[3])
        if not drop and _unwanted(tag, attributes, steps):
            if tag not in SOFT:
                flush()
            if end := _end_of(page, tag, at):
                at = end
                continue
            drop = len(tags) + 1
        names.append(0 if drop else _named(tag, attributes, steps))
        tags.append(tag)
        kind = attributes.get("class", "")
        steps.append(f"{tag}.{'.'.join(sorted(_DIGITS.sub('0', kind).lower().split()))}" if kind else tag)
        links += tag == "a"
    flush()
    return out


# tags that hold text themselves; what is around them is a container
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr td th caption address details summary".split())


def scores(found: list[Block]) -> dict[str, int]:
    """Score of each container that directly holds blocks; a word that speaks against one leaves a quarter, a whole name a sixteenth."""
    out: dict[str, float] = defaultdict(float)
    for block in found:
        out[" ".join(block.path)] += (len(block.text) - 2 * min(block.linked, len(block.text))) / 4**block.doubts
    return {path: int(score) for path, score in out.items()}


def _holds(path: tuple[str, ...], block: Block) -> bool:
    """Whether a block is in the container at the path, and in nothing further inside that a whole name speaks against."""
    return block.path[: len(path)] == path and not any(d > len(path) for d in block.named)


def _lifted(found: list[Block], path: tuple[str, ...]) -> tuple[str, ...]:
    """The container around the best one that holds the whole article.

    That is the closest article element, else the closest main. Without them it is the highest
    ancestor below body that adds the article's headline, ahead of its text, or further running text;
    body itself where the headline is directly in it.
    """
    tags = [p.split(".")[0] for p in path]
    for whole in ("article", "main"):
        if whole in tags:
            return path[: len(tags) - tags[::-1].index(whole)]
    top = sum(t in ("html", "body") for t in tags)
    headline = min((b.level for b in found if 0 < b.level <= 2), default=0)
    for depth in range(len(path) - 1, top - 1, -1):
        up = path[:depth]
        inside = [b for b in found if _holds(up, b)]
        first = next((i for i, b in enumerate(inside) if _holds(path, b)), 0)
        heads = [b for b in inside[:first] if b.level == headline > 0 and (depth > top or b.path == up)]
        if heads and not any(b.level == headline for b in inside if _holds(path, b)):
            path = up
            continue
        if depth == top:
            break
        running = [len(b.text) / 4**b.doubts for b in inside if not b.level and len(b.text) >= RUNNING and 4 * b.linked <= len(b.text) and not _holds(path, b)]
        own = sum((len(b.text) - 2 * min(b.linked, len(b.text))) / 4**b.doubts for b in inside if _holds(path, b))
        if sum(running) >= SHARE * own > 0:
            path = up
    return path


def _headline(found: list[Block], path: tuple[str, ...]) -> tuple[str, ...] | None:
    """The container of its own in which the headline of an article without one stands, ahead of the text."""
    headline = min((b.level for b in found if 0 < b.level <= 2), default=0)
    first = next((i for i, b in enumerate(found) if _holds(path, b)), 0)
    if not headline or any(b.level == headline for b in found if _holds(path, b)):
        return None
    top = sum(p.split(".")[0] in ("html", "body") for p in path)
    return next((b.path for b in found[:first] if b.level == headline and not b.doubts and len(b.path) > top), None)


def best_paths(found: list[Block]) -> tuple[list[str], int]:
    """The container of the article around the highest score, the first of those that tie, that of its headline, and the score."""
    scored = scores(found)
    if not scored:
        return [], 0
    best, score = max(scored.items(), key=lambda x: x[1])
    path = _lifted(found, tuple(best.split(" ")) if best else ())
    head = _headline(found, path)
    return [" ".join(p) for p in (path, head) if p is not None], score


def text_at(found: list[Block], paths: list[str]) -> str:
    """Text of the containers at the paths and below them; without any, of the page's best container."""
    whole = [tuple(p.split(" ")) if p else () for p in paths]
    kept = [b.text for b in found if any(_holds(p, b) for p in whole)]
    if not kept:
        own = [tuple(p.split(" ")) if p else () for p in best_paths(found)[0]]
        kept = [b.text for b in found if any(_holds(p, b) for p in own)]
    return "\n".join(kept)


def votes(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, path, votes``: what the pages' best containers, and those of their headlines, score, added up."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = [(host, path, score) for host, x in zip(batch["host"], batch["page"]) for paths, score in [best_paths(blocks(x))] for path in paths]
            yield pd.DataFrame(told, columns=["host", "path", "score"])

    read = pages.select(host_of(url).alias("host"), F.coalesce(F.col(page), F.lit("")).alias("page"))
    each = read.mapInPandas(best, "host string, path string, score long").where("score > 0")
    return each.groupBy("host", "path").agg(F.sum("score").alias("votes"))


def winners(voted: DataFrame, share: float = SHARE) -> DataFrame:
    """``host, paths``: each host's winning paths."""
    # a host has as many rows here as its templates have paths
    most = voted.groupBy("host").agg(F.max("votes").alias("most"))
    strong = voted.join(most, "host").where(F.col("votes") >= share * F.col("most"))
    paths = strong.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    inside: Column = F.filter("paths", lambda p: ~F.exists("paths", lambda q: p.startswith(F.concat(q, F.lit(" ")))))
    return paths.select("host", inside.alias("paths"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", share: float = SHARE) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    paths = landed(winners(votes(pages, url, page), share), "html-paths")

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = [text_at(blocks(x), [] if p is None else list(p)) for x, p in zip(batch["page"], batch["paths"])]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": told, "n_chars": list(map(len, told))})

    read = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(page), F.lit("")).alias("page"), host_of(url).alias("host"))
    kind = pages.schema[key].dataType.simpleString()
    joined = read.join(paths, "host", "left").select("page_id", "url", "page", "paths")
    return joined.mapInPandas(texts, f"page_id {kind}, url string, text string, n_chars long")
