"""Allow and block lists for URLs, as a trie over reversed host labels and path segments.

An entry is a host with an optional path, such as ``example.com/en/``.  It fits that host and all its
subdomains, for paths that start with its own.  The longest entry that fits decides.  A URL that no
entry fits gets the default verdict.

Defined cases: a null URL, or one without ``://``, has an empty host and an empty path and fits no
entry; rows are judged one by one, so repeated rows repeat and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, table

#: Entries in one list; the trie is sent to every task, so its size has a bound.
MAX_ENTRIES = 200_000


@dataclass(frozen=True)
class Entry:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


@dataclass
class Node:
    """A trie node.  ``ends``: entries whose last, possibly unfinished, path segment starts here."""

    below: dict[str, Node] = field(default_factory=dict)
    path: Node | None = None
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)


def build_trie(entries: list[Entry]) -> Node:
    """Equal entries with both verdicts: block wins, whatever the order."""
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"{len(entries)} entries; a list may have {MAX_ENTRIES}: split it and union the verdicts")
    root = Node()
    for entry in sorted(entries, key=lambda e: e.verdict):
        node = root
        for label in reversed(entry.host.lower().split(".")):
            node = node.below.setdefault(label, Node())
        node.path = node.path or Node()
        node = node.path
        *whole, last = entry.path.split("/")
        for segment in whole:
            node = node.below.setdefault(segment, Node())
        node.ends[last] = (entry.name, entry.verdict)
    return root


def match(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """The longest entry that fits: most host labels first, then the longest path."""
    labels, node, depth, found = host.split("."), root, 0, None
    tops = []
    for label in reversed(labels):
        node = node.below.get(label)
        if node is None:
            break
        depth += len(label) + 1
        if node.path is not None:
            tops.append((depth, node.path))
    best = -1
    segments = path.split("/")
    for host_size, node in tops:
        size = host_size
        for segment in segments:
            for end, entry in node.ends.items():
                if segment.startswith(end) and size + len(end) > best:
                    best, found = size + len(end), entry
            node = node.below.get(segment)
            if node is None:
                break
            size += len(segment) + 1
    return found


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path, by SQL functions; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, path


def judge_urls(pages: DataFrame, entries: list[Entry], url: str = "url", default: str = "allow") -> DataFrame:
    """Every row with ``host``, ``path``, ``rule`` and ``verdict`` added."""
    root = build_trie(entries)
    shared = pages.sparkSession.sparkContext.broadcast(root)

    @F.pandas_udf("rule string, verdict string")
    def decide(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        trie = shared.value
        found = [match(trie, h, p) or (None, default) for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = url_parts(F.col(url))
    judged = pages.withColumn("host", host).withColumn("path", path)
    judged = judged.withColumn("_decided", decide("host", "path"))
    return judged.withColumns({"rule": F.col("_decided.rule"), "verdict": F.col("_decided.verdict")}).drop("_decided")


#: Fixed values of the query.
LIST = [
    Entry("allow", "com", "/"),
    Entry("block", "example.com", "/en/"),
    Entry("allow", "www.example.com", "/en/"),
    Entry("block", "net", "/es/"),
    Entry("block", "net", "/fr/"),
]

OP8_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
ruled AS (
  SELECT *, CASE
      WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
      WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op8_url_filters", OP8_SQL)
def op8_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, LIST).select("page_id", "host", "path", "rule", "verdict")
