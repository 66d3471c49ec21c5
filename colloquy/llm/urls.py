"""URL filter: a trie over reversed host labels, with paths below each host, looked up for the longest matching entry.

An entry (host, path) fits its host and all subdomains if the URL's path starts with the entry's. The trie is walked from
the last host label; each node that ends an entry's host holds a second trie over the characters of paths, cut at
segments: a whole segment is one edge, and the rest of the entry after its last slash is matched as the start of a
segment. Of all fitting entries the deepest host wins, then the longest path; of an allow and a block entry that
are equal, block wins. The list is a parameter: up to ``MAX_BROADCAST`` entries it is broadcast as a trie; a longer list
is joined by its keys (every host suffix and path start of a URL) instead.

Host and path: the part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; the path
then goes up to ``?``, ``#`` or the end. A null URL or one without ``://`` has both empty and is blocked, as there
is nothing to fetch; a URL without a fitting entry is allowed. Repeated rows are judged one by one; an empty table gives an
empty result; other columns are handed on, those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import packed, require, unpacked
from colloquy.session import ship

Entry = tuple[str, str, str]

#: Fixed values: (verdict, host, path).
RULES: tuple[Entry, ...] = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MAX_BROADCAST = 200_000


class HostTrie:
    """Host labels from the right; at the nodes, entry paths by segment."""

    def __init__(self, rules: Sequence[Entry]) -> None:
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(("label", label), {})
            *segments, last = path.split("/")
            node = node.setdefault("paths", {})
            for segment in segments:
                node = node.setdefault(("segment", segment), {})
            ends = node.setdefault("ends", {})
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (host + path, verdict)
        self._sort(self.root)

    def _sort(self, node: dict) -> None:
        """Unfinished last segments with the longest first."""
        for key, below in node.items():
            if key == "ends":
                node[key] = dict(sorted(below.items(), key=lambda item: -len(item[0])))
            else:
                self._sort(below)

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        found = None
        for segment in path.split("/"):
            found = next((hit for start, hit in node.get("ends", {}).items() if segment.startswith(start)), found)
            node = node.get(("segment", segment))
            if node is None:
                return found
        return found

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the entry with the longest host, then path."""
        found, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get(("label", label))
            if node is None:
                break
            if "paths" in node:
                found = self._path(node["paths"], path) or found
        return found


def host_of(url: Column) -> Column:
    """A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _by_trie(rows: DataFrame, rules: Sequence[Entry]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(HostTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for hosts, paths in batches:
            found = [trie.find(host, path) or (None, None) for host, path in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    return rows.withColumn("found", look_up("host", "path"))


def _by_join(rows: DataFrame, rules: Sequence[Entry]) -> DataFrame:
    """For long lists: each URL's host suffixes joined to the entries; the best entry is aggregated per URL.

    Entries of one host are grouped by path length, so a URL asks for no more keys than there are lengths.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame([(v, h, p, len(p)) for v, h, p in rules], "verdict string, r_host string, r_path string, r_length int")
    lengths = sorted({len(p) for _, _, p in rules})
    distinct = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.when(F.length("path") >= n, F.substr("path", F.lit(1), n)))
    keys = distinct.select("host", "path", F.explode(suffixes).alias("suffix"))
    keys = keys.select("host", "path", "suffix", F.explode(F.array_compact(F.array_distinct(starts))).alias("start"))
    hits = keys.join(table, (F.col("suffix") == F.col("r_host")) & (F.col("start") == F.col("r_path")))
    rank = F.struct(F.size(F.split("r_host", r"\.")).alias("depth"), "r_length", (F.col("verdict") == "block").alias("blocks"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "verdict"), rank).alias("found"))
    best = best.select(F.col("host").alias("h"), F.col("path").alias("p"), "found")
    return rows.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left").drop("h", "p")


def judge(pages: DataFrame, rules: Sequence[Entry] = RULES, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """All rows and columns with ``host``, ``path``, ``rule`` and ``verdict``."""
    require(pages, "url")
    ship(pages.sparkSession)
    rows = pages.select(packed(pages), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = _by_trie(rows, rules) if len(rules) <= max_broadcast else _by_join(rows, rules)
    default = F.when(F.col("host") == "", F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        *unpacked(found, ("host", "path", "rule", "verdict")), "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), default).alias("verdict"),
    )
