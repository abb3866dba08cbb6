"""URL filters: a trie over reversed host labels, then path segments.

Rules ``(host, path, action)`` go into one trie: the host's labels from the
last to the first, then the path's segments. A url walks the trie once; the
deepest rule met wins, so an entry for ``www.example.com`` beats one for
``example.com``, and among rules of one host the longer path wins. The rule set
is counted before it is broadcast; a larger one is applied by joins on host
suffixes and path prefixes, with the same results.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path`` of its urls; both empty for a null url or one without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return without(df, ["host", "path"]).select("*", host.alias("host"), path.alias("path")) if url.lower() not in (
        "host", "path") else df.select(host.alias("host"), path.alias("path"))


class RuleTrie:
    """Nested dicts: host labels (last first), then path segments; rules sit at the node where they end.

    A path is cut behind each ``/``; a last segment without ``/`` is kept as the
    open end of its node, where any url segment that starts with it matches.
    """

    def __init__(self, root: dict | None = None) -> None:
        self.root: dict = {} if root is None else root

    @staticmethod
    def _segments(path: str) -> list[str]:
        return path.split("/")  # 'a/b' -> a closed 'a' and an open 'b'

    def add(self, host: str, path: str, action: str) -> None:
        node = self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.setdefault("hosts", {}).setdefault(label, {})
        *closed, last = self._segments(path)
        for segment in closed:
            node = node.setdefault("paths", {}).setdefault(segment, {})
        ends = node.setdefault("ends", {})
        if ends.get(last, ("", "allow"))[1] != "block":  # block wins between equal entries
            ends[last] = (host + path, action)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule of the longest match: the most host labels, then the longest path."""
        nodes = [self.root]
        for label in reversed(host.split(".")) if host else ():
            node = nodes[-1].get("hosts", {}).get(label)
            if node is None:
                break
            nodes.append(node)
        for node in reversed(nodes):
            if found := self._find_path(node, path):
                return found
        return None

    def _find_path(self, node: dict | None, path: str) -> tuple[str, str] | None:
        best, segments = None, self._segments(path)
        for i, segment in enumerate(segments):
            ends = node.get("ends")
            if ends:
                fits = [e for e in ends if segment.startswith(e)]
                if fits:
                    best = ends[max(fits, key=len)]
            node = node.get("paths", {}).get(segment) if i < len(segments) - 1 else None
            if node is None:
                break
        return best


def _by_trie(hosts: DataFrame, rules: list) -> DataFrame:
    trie = RuleTrie()
    for host, path, action in rules:
        trie.add(host, path, action)
    shared = hosts.sparkSession.sparkContext.broadcast(trie.root)

    @F.pandas_udf("struct<rule string, action string>")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        known = RuleTrie(shared.value)
        found = [known.find(h, p) or (None, None) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "action"])

    return hosts.withColumn("__found", judge("host", "path"))


def _by_join(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same verdicts without a broadcast: join on host suffix and path prefix, the longest wins."""
    lengths = F.broadcast(rules.agg(F.collect_set(F.length("path")).alias("__lengths")))  # one row of path lengths
    labels = F.split("host", r"\.")
    suffixes = F.expr("concat(array(''), transform(sequence(1, size(__labels)), "
                      "n -> array_join(slice(__labels, size(__labels) - n + 1, n), '.')))")
    pairs = hosts.select("host", "path").distinct()
    tried = (pairs.join(lengths).withColumn("__labels", labels).withColumn("__host", F.explode(suffixes))
             .withColumn("__path", F.explode(F.expr("transform(filter(__lengths, n -> n <= length(path)), "
                                                    "n -> substring(path, 1, n))"))))
    found = (tried.join(rules.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "action"),
                        ["__host", "__path"])
             .groupBy("host", "path")
             .agg(F.max_by(F.struct(F.concat("__host", "__path").alias("rule"), "action"),
                           F.struct(F.length("__host"), F.length("__path"))).alias("__found")))
    return hosts.join(found, ["host", "path"], "left")


def judge_urls(df: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow",
               trie_limit: int = 200_000, text_limit: int = 64 << 20) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict`` of every url.

    ``rules`` has ``host``, ``path`` and ``action`` (allow or block). A rule fits
    its host and all subdomains if the url's path starts with the rule's path.
    The longest match wins: more host first, then more path; between an allow
    and a block for the same host and path the block wins. ``rule`` is host and
    path of the winner, null if none fits; the verdict is then ``default``.

    Up to ``trie_limit`` rules of ``text_limit`` characters in all are broadcast
    as a trie; more are joined. Null urls and urls without ``://`` have an empty
    host and path, which only a rule with an empty host and path fits. Rules
    with a null action are ignored, null hosts and paths count as empty, hosts
    are compared in lower case (A-Z). Input columns named like the added ones
    are replaced. Empty tables: no rows, or no rules.
    """
    low = rules.where("action is not null").select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), "action")
    low = low.groupBy("host", "path").agg(F.max("action").alias("action"))  # 'block' > 'allow'
    size = low.agg(F.count("*"), F.sum(F.length("host") + F.length("path"))).first()
    hosts = with_host_path(without(df, ["rule", "verdict", "__found"]), url)
    if size[0] <= trie_limit and (size[1] or 0) <= text_limit:
        judged = _by_trie(hosts, [tuple(r) for r in low.collect()])  # at most trie_limit rows
    else:
        judged = _by_join(hosts, low)
    return judged.select(*[c for c in hosts.columns], F.col("__found.rule").alias("rule"),
                         F.coalesce(F.col("__found.action"), F.lit(default)).alias("verdict"))
