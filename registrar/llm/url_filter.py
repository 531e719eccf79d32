"""URL filters: a trie over reversed host labels, then path segments.

A rule (host, path, verdict) fits its host and all subdomains where the
url's path starts with the rule's path. The longest rule wins: more host
labels first, then the longer path; if an allow and a block entry are the
same, block wins. The trie is broadcast; its size is checked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import mapped

#: Entries that one broadcast trie may hold (about 1 kB each); longer lists are refused, not cut.
MOST_RULES = 200_000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nodes are dicts; ``labels`` lead from the top-level domain downwards,
    then ``segments`` along the path. A rule's path ends within a segment:
    its last part is kept at the node as a prefix of the next segment."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {"labels": {}}
        for n, rule in enumerate(rules):
            if n >= MOST_RULES:
                raise ValueError(f"more than {MOST_RULES} rules in one trie")
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node["labels"].setdefault(label, {"labels": {}})
            node = node.setdefault("paths", {"segments": {}, "ends": {}})
            *whole, last = rule.path.split("/")
            for segment in whole:
                node = node["segments"].setdefault(segment, {"segments": {}, "ends": {}})
            known = node["ends"].get(last)
            if known is None or rule.verdict == "block":
                node["ends"][last] = rule

    def find(self, host: str, path: str) -> Rule | None:
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node["labels"].get(label)
            if node is None:
                break
            if "paths" in node:
                best = self._along(node["paths"], path) or best
        return best

    @staticmethod
    def _along(node: dict, path: str) -> Rule | None:
        best = None
        for segment in path.split("/"):
            fit = [end for end in node["ends"] if segment.startswith(end)]
            if fit:
                best = node["ends"][max(fit, key=len)]
            node = node["segments"].get(segment)
            if node is None:
                break
        return best


def judge(pages: DataFrame, rules: Iterable[Rule], default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (page_id, url, ...): page_id, host, path,
    rule (host and path of the entry that decides, else null), verdict.

    A null url or one without ``://`` has an empty host and path and gets the
    default. Other columns are ignored; repeated rows stay; an empty table
    gives an empty one.
    """
    tree = pages.sparkSession.sparkContext.broadcast(Trie(rules))
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("rule", pa.string()), ("verdict", pa.string())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = tree.value
        for b in stream:
            found = [trie.find(h, p) for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([r and r.host + r.path for r in found], type=pa.string()),
                 pa.array([r.verdict if r else default for r in found], type=pa.string())], schema=schema)

    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    return parts.transform(mapped, run, "page_id bigint, host string, path string, rule string, verdict string")
