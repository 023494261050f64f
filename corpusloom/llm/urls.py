"""URL filters: a trie over reversed host labels and path segments, broadcast, longest match first.

Hosts and paths are cut out by Spark expressions; distinct batches of them walk the trie in an Arrow function. The trie
is broadcast if its size is proven when it is built: no more than MAX_NODES nodes and rules, of no more than MAX_BYTES of
text. Larger rule lists go by themselves through :func:`judge_by_join`, which looks up each URL's host suffixes and path
segments as keys of a join.

Defined cases: a null URL or one without ``://`` has an empty host and path and gets the default verdict; an empty host
matches no rule; a null path of a rule is empty, a rule without a host or verdict is none; repeated rows are judged one
by one; an empty table gives an empty result; clashing names of other columns don't matter, as only the id and the URL
are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

MAX_NODES, MAX_BYTES = 100_000, 4 << 20
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path


def _node() -> dict:
    """A host label or a path segment. ``tails`` are the rules, as (text, verdict), that end within the next segment."""
    return {"labels": {}, "segments": {}, "tails": {}}


def build(rules: Iterable[Rule], max_nodes: int = MAX_NODES, max_bytes: int = MAX_BYTES) -> dict | None:
    """The trie, in plain dictionaries so that any worker can read the broadcast; None if it exceeds the bounds."""
    root = _node()
    nodes = size = 0

    def under(children: dict, name: str) -> dict:
        nonlocal nodes
        if name not in children:
            children[name] = _node()
            nodes += 1
        return children[name]

    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = under(node["labels"], label)
        *full, tail = rule.path.split("/")
        for segment in full:
            node = under(node["segments"], segment)
        if node["tails"].get(tail, ("", ""))[1] != "block":  # of an allow and a block entry of the same text, block holds
            node["tails"][tail] = (rule.text, rule.verdict)
        nodes, size = nodes + 1, size + len(rule.text.encode())
        if nodes > max_nodes or size > max_bytes:
            return None
    return root


def find(root: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule, as (text, verdict): the most host labels first, then the longest path."""
    node, hosts = root, []
    for label in reversed(host.split(".")):
        node = node["labels"].get(label)
        if node is None:
            break
        hosts.append(node)
    segments = path.split("/")
    for at in reversed(hosts):
        best = None
        for segment in segments:
            tails = at["tails"]
            if tails:
                best = next((tails[segment[:n]] for n in range(len(segment), -1, -1) if segment[:n] in tails), best)
            at = at["segments"].get(segment)
            if at is None:
                break
        if best:
            return best
    return None


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: Iterable[Rule], key: str = "page_id", url: str = "url", default: str = DEFAULT, max_nodes: int = MAX_NODES) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict."""
    rules = list(rules)
    root = build(rules, max_nodes)
    if root is None:
        rows = pages.sparkSession.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
        return judge_by_join(pages, rows, key, url, default)
    trie = pages.sparkSession.sparkContext.broadcast(root)

    @F.pandas_udf("struct<rule string, verdict string>")
    def look(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = trie.value
        for hosts, paths in parts:
            found = [find(root, h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame({"rule": [r and r[0] for r in found], "verdict": [r[1] if r else default for r in found]})

    cut = pages.select(pages[key].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    return cut.withColumn("__found", look("host", "path")).select("page_id", "host", "path", "__found.rule", "__found.verdict")


def judge_by_join(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """The same for a rule table (verdict, host, path) of any size.

    A rule's key is its host and the whole segments of its path. Rules of one key become one row with the last, open
    segments of all of them, and distinct (host, path) look up the keys that they may have, so that a host of many pages,
    or of many rules, meets each key once.
    """
    parts = F.split(F.coalesce("path", F.lit("")), "/", -1)
    keyed = rules.filter("host is not null and verdict is not null").select("host", F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/").alias("full"), F.size(parts).alias("n"), F.element_at(parts, -1).alias("tail"), "verdict")
    tails = keyed.groupBy(F.col("host").alias("r_host"), F.col("full").alias("r_full"), F.col("n").alias("r_n")).agg(F.collect_set(F.struct("tail", "verdict")).alias("tails"))
    cut = pages.select(pages[key].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    labels, segments = F.split("host", r"\.", -1), F.split("path", "/", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fulls = F.transform(F.sequence(F.lit(1), F.size(segments)), lambda i: F.struct(F.array_join(F.slice(segments, F.lit(1), i - 1), "/").alias("full"), i.alias("n"), F.get(segments, i - 1).alias("segment")))
    asked = cut.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes)).withColumn("f", F.explode(fulls)).select("host", "path", "suffix", "f.*")
    fits = asked.join(tails, (F.col("suffix") == F.col("r_host")) & (F.col("full") == F.col("r_full")) & (F.col("n") == F.col("r_n"))).withColumn("t", F.explode(F.filter("tails", lambda t: F.col("segment").startswith(t["tail"]))))
    path = F.concat("full", F.when(F.col("n") > 1, "/").otherwise(""), F.col("t.tail"))
    rank = F.struct(F.length("suffix").alias("h"), F.length(path).alias("p"), (F.col("t.verdict") == "block").alias("b"), F.concat("suffix", path).alias("rule"), F.col("t.verdict").alias("verdict"))
    best = fits.groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path")).agg(F.max(rank).alias("best"))
    return cut.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left").select("page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
