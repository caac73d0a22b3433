"""URL filters by a trie over reversed host labels and path segments.

A rule names a host, which stands for its subdomains too, and a beginning of the path. Rules go
into one trie: a node per host label from the right, below it a node per path segment. Walking a
url down the trie passes every rule that fits it; the longest wins, that is the one with the most
host labels and, among these, the longest path. Allow and block entries are equal in that. Without
a fitting rule the verdict is ``default``, allow.

The trie is broadcast. Its size is checked: more than ``MAX_RULES`` rules or ``MAX_BYTES`` of rule
text are refused, and such lists are joined instead (``judge_by_join``): every url lists the rules
that could fit it, one per suffix of its host and beginning of its path, and an equi-join finds
which exist.

Defined results: a null url and one without ``://`` have an empty host and path, fit no rule and get
the default. An empty table gives no rows, an empty list of rules the default for all. Repeated
rules count once; the same rule as allow and block is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
MAX_BYTES = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class Node:
    __slots__ = ("labels", "paths", "segments", "rule")

    def __init__(self) -> None:
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        # endings inside a segment, longest first
        self.paths: list[tuple[str, Rule]] = []
        self.rule: Rule | None = None


def build_trie(rules: Iterable[Rule]) -> Node:
    root, seen = Node(), {}
    for rule in map(lambda r: Rule(*r), rules):
        if seen.setdefault(rule.name, rule.verdict) != rule.verdict:
            raise ValueError(f"rule {rule.name} is both allow and block")
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.labels.setdefault(label, Node())
        *whole, ending = rule.path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        if ending:
            node.paths = sorted({*node.paths, (ending, rule)}, key=lambda x: -len(x[0]))
        else:
            node.rule = rule
    return root


def longest_match(trie: Node, host: str, path: str) -> Rule | None:
    """The rule with the most host labels that fits, and of these the longest path."""
    hosts, node = [], trie
    for label in reversed(host.split(".")) if host else ():
        node = node.labels.get(label)
        if node is None:
            break
        hosts.append(node)
    for start in reversed(hosts):
        best, at, node = None, 0, start
        while node is not None:
            best = node.rule or best
            rest = path[at:]
            best = next((rule for ending, rule in node.paths if rest.startswith(ending)), best)
            cut = path.find("/", at)
            node = node.segments.get(path[at:cut]) if cut >= 0 else None
            at = cut + 1
        if best:
            return best
    return None


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _split(pages: DataFrame, key: str, url: str) -> DataFrame:
    return pages.select(F.col(key).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))


def judge(pages: DataFrame, rules: Iterable[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict."""
    rules = [Rule(*r) for r in rules]
    if len(rules) > MAX_RULES or sum(len(r.name.encode()) for r in rules) > MAX_BYTES:
        raise ValueError("too many rules to broadcast: use judge_by_join")
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [longest_match(trie.value, h, p) for h, p in zip(batch["host"], batch["path"])]
            yield batch.assign(rule=[r and r.name for r in found], verdict=[r.verdict if r else default for r in found])

    parts = _split(pages, key, url)
    return parts.mapInPandas(judged, f"page_id {pages.schema[key].dataType.simpleString()}, host string, path string, rule string, verdict string")


def judge_by_join(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """The same for ``rules`` (host, path, verdict) of any number. Rule paths must end in a slash."""
    parts = _split(pages, key, url).withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segments = F.split("path", "/")
    inside = F.when(F.size(segments) > 1, F.sequence(F.lit(1), F.size(segments) - 1)).otherwise(F.array().cast("array<int>"))
    paths = F.transform(inside, lambda i: F.concat(F.array_join(F.slice(segments, F.lit(1), i), "/"), F.lit("/")))
    tried = parts.select("row", F.explode(hosts).alias("h"), "path").select("row", "h", F.explode(paths).alias("p"))
    known = rules.select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v")).distinct()
    fits = tried.join(known, ["h", "p"]).groupBy("row")
    rank = F.struct(F.size(F.split("h", r"\.")).alias("labels"), F.length("p").alias("chars"), F.concat("h", "p").alias("name"), "v")
    best = fits.agg(F.max(rank).alias("best"))
    joined = parts.join(best, "row", "left")
    return joined.select("page_id", "host", "path", F.col("best.name").alias("rule"), F.coalesce("best.v", F.lit(default)).alias("verdict"))
