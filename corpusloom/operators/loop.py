"""The outer loop: search for seeds, visit what is found, round by round, and make new seeds of what is new."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls

from . import crawl, seeds


@dataclass
class Visit:
    """What a bounded crawl gives."""

    sentences: DataFrame
    visited: DataFrame
    blacklist: DataFrame
    leftovers: DataFrame


def enqueue(lines: DataFrame, blacklist: DataFrame, counters: DataFrame | None = None, url: str = "url") -> DataFrame:
    """Start URLs of a list: fixed, worth a visit, not blacklisted, each once, with the counters of those that are known."""
    fixed = lines.filter(urls.is_url(F.col(url))).select(urls.fix(F.col(url)).alias("url")).filter("url is not null").distinct()
    start = crawl.not_blacklisted(fixed, blacklist)
    return start if counters is None else crawl.enrich(start, counters)


def visit(pages: DataFrame, start: DataFrame, store: DataFrame, blacklist: DataFrame, tools: crawl.Tools | Callable[[DataFrame], DataFrame], opt: crawl.Options = crawl.Options(), counters: DataFrame | None = None, asof: str | None = None, cut: Callable[[DataFrame], DataFrame] = crawl.checkpointed) -> Visit:
    """Breadth-first rounds over a table of pages (url, html) from the URLs ``start``.

    Each round is one plan. URLs not in the table count as empty documents; what lies beyond the depth is left over. ``cut``
    checkpoints what a round hands on. With ``counters`` (url, delta, delta_date) and ``asof`` the recrawl policy holds.
    """
    tools = tools if isinstance(tools, crawl.Tools) else crawl.usual(tools, opt)
    frontier = cut(crawl.not_blacklisted(start.select("url", F.lit(1).alias("depth"), F.lit(None).cast("string").alias("parent")).dropDuplicates(["url"]), blacklist))
    visited, found, bad = frontier.limit(0), None, None
    for _ in range(opt.max_depth):
        known = frontier.join(counters.select("url", "delta", "delta_date"), "url", "left") if counters is not None else frontier.withColumns({"delta": F.lit(0), "delta_date": F.lit(None).cast("timestamp")})
        due = known if asof is None else known.filter(tools.decider.crawl(F.col("delta_date"), F.col("delta"), F.lit(asof)))
        seen = store if found is None else store.select(F.col("text")).unionByName(found.select(F.col("sentence").alias("text")))
        gone = blacklist.select("url") if bad is None else blacklist.select("url").unionByName(bad.select("url"))
        r = crawl.crawl_round(due.join(pages.select("url", "html"), "url", "left").select("url", "html", "depth", "delta_date"), seen, gone, tools, opt, cut)
        r.new_sentences, r.blacklist = fresh, failed = cut(r.new_sentences), cut(r.blacklist)
        if tools.saver:
            tools.saver(r)
        found, bad = (fresh, failed) if found is None else (found.unionByName(fresh), bad.unionByName(failed))
        visited = cut(visited.unionByName(frontier))
        frontier = cut(r.children.select("url", "depth", "parent").join(visited.select("url"), "url", "left_anti"))
    return Visit(found, visited, bad, frontier)


def search(queries: DataFrame, results: DataFrame, known: DataFrame, blacklist: DataFrame, most: int = 10, max_fetches: int = -1) -> DataFrame:
    """Accepted links of the queries (seed_order, query) among the results (query, rank, link)."""
    return seeds.accept(results.join(queries, "query"), known, blacklist, most, max_fetches)


def turn(pages: DataFrame, queries: DataFrame, results: DataFrame, store: DataFrame, known: DataFrame, blacklist: DataFrame, tools: crawl.Tools | Callable[[DataFrame], DataFrame], opt: crawl.Options = crawl.Options(), most: int = 10, max_fetches: int = -1, cut: Callable[[DataFrame], DataFrame] = crawl.checkpointed) -> tuple[DataFrame, Visit, DataFrame]:
    """One turn of the loop: (links taken from the search, what the visit gave, the seeds that follow from it)."""
    tools = tools if isinstance(tools, crawl.Tools) else crawl.usual(tools, opt)
    taken = cut(search(queries, results, known, blacklist, most, max_fetches))
    out = visit(pages, taken.select(F.col("link").alias("url")), store, blacklist, tools, opt, cut=cut)
    return taken, out, (tools.seed_creator or seeds.top_ngrams)(out.sentences)
