"""Crawl decisions, page rounds, frontiers and counters, set by set."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import extract, langid, normalize, rules, split, urls
from corpusloom.functions.text import seconds


@dataclass(frozen=True)
class Options:
    """What alters results: thresholds, depth, and the text tools' switches."""

    min_proba: float = 0.85
    max_depth: int = 2
    min_recrawl: str = "7d"
    active_recrawl: str = "4d"
    min_ratio: float = 0.2
    keep_newlines: bool = True
    more: bool = True
    strip_emojis: bool = True
    fix_encoding: bool = False


# --- decisions -------------------------------------------------------------------------------------------------------


def is_new(delta_date: Column) -> Column:
    return delta_date.isNull()


def should_crawl(delta_date: Column, delta: Column, asof: Column, opt: Options = Options()) -> Column:
    """New pages, pages that lately gave something after a short pause, others after a longer one."""
    age = asof.cast("timestamp").cast("double") - delta_date.cast("timestamp").cast("double")
    return F.when(delta_date.isNull(), True).when(delta > 0, age > seconds(opt.active_recrawl)).otherwise(age > seconds(opt.min_recrawl))


def should_crawl_new_only(delta_date: Column) -> Column:
    return delta_date.isNull()


def should_follow(sentences: Column, hits: Column, opt: Options = Options()) -> Column:
    """Whether a page's links are followed: it has hits, and sentences for each hit exceed the ratio (as is: never a bar below one)."""
    return F.when(hits > 0, sentences / hits > opt.min_ratio).otherwise(False)


def should_follow_share(sentences: Column, hits: Column, opt: Options = Options()) -> Column:
    """The variant by the share of hits among the sentences."""
    return F.when(sentences > 0, hits / sentences > opt.min_ratio).otherwise(False)


def should_follow_new(sentences: Column, hits: Column, new: Column, opt: Options = Options()) -> Column:
    return should_follow(sentences, hits, opt) & (new > 0)


def should_blacklist(delta_date: Column, hits: Column) -> Column:
    return delta_date.isNull() & (hits == 0)


def always(_: Column | None = None) -> Column:
    return F.lit(True)


class Decider:
    """What to crawl, follow and blacklist, as columns: all but new pages without a hit."""

    def crawl(self, delta_date: Column, delta: Column, asof: Column) -> Column:
        return always()

    def follow(self, sentences: Column, hits: Column, new: Column) -> Column:
        return always()

    def blacklist(self, delta_date: Column, hits: Column) -> Column:
        return should_blacklist(delta_date, hits)


class BasicDecider(Decider):
    """Recrawls after a pause, and follows by ratio."""

    def __init__(self, **options):
        self.opt = Options(**options)

    def crawl(self, delta_date: Column, delta: Column, asof: Column) -> Column:
        return should_crawl(delta_date, delta, asof, self.opt)

    def follow(self, sentences: Column, hits: Column, new: Column) -> Column:
        return should_follow(sentences, hits, self.opt)


class NewPagesDecider(BasicDecider):
    """Only pages that were never crawled."""

    def crawl(self, delta_date: Column, delta: Column, asof: Column) -> Column:
        return should_crawl_new_only(delta_date)


class NewSentenceDecider(BasicDecider):
    """Only links of pages that gave a new sentence."""

    def follow(self, sentences: Column, hits: Column, new: Column) -> Column:
        return should_follow_new(sentences, hits, new, self.opt)


# --- sentences -------------------------------------------------------------------------------------------------------


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; a local one only where all run on one machine."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="corpusloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system, wherever it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame, waves: int = 2) -> DataFrame:
    """Rows over all cores where a source has fewer partitions than cores; larger sources stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= waves * cores else df.repartition(waves * cores)


def page_sentences(docs: DataFrame, key: str, text: str, normalizer: Callable[[Column], Column], splitter: Callable[[Column], Column]) -> DataFrame:
    """(key, pos, sentence): each page's distinct sentences, the first place of each."""
    rows = spread(docs.select(key, F.col(text))).filter(F.col(text).isNotNull()).select(key, normalizer(F.col(text)).alias("t"))
    return rows.select(key, F.posexplode(F.array_distinct(splitter(F.col("t")))).alias("pos", "sentence")).filter("sentence != ''")


def site_sentences(pages: DataFrame, normalizer: Callable[[Column], Column], splitter: Callable[[Column], Column]) -> DataFrame:
    """(url, pos, sentence): each URL's distinct sentences over all contents (url, text) that it has, in the contents' order."""
    rows = spread(pages.select("url", "text")).filter(F.col("text").isNotNull()).select("url", normalizer(F.col("text")).alias("t"))
    lists = rows.select("url", splitter(F.col("t")).alias("l")).groupBy("url").agg(F.flatten(F.array_sort(F.collect_set("l"))).alias("l"))
    return lists.select("url", F.posexplode(F.array_distinct("l")).alias("pos", "sentence")).filter("sentence != ''")


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "text", opt: Options = Options(), compose: bool = True) -> DataFrame:
    """:func:`page_sentences` by the usual normaliser and splitter."""
    return page_sentences(docs, key, text, lambda t: normalize.normalize(t, repair=opt.fix_encoding, emojis=not opt.strip_emojis, compose=compose), lambda t: split.split(t, opt.more, opt.keep_newlines))


def valid_sentences(rows: DataFrame, profile: list[rules.Rule] = rules.DEFAULT, sentence: str = "sentence") -> DataFrame:
    return rows.filter(rules.valid(F.col(sentence), profile))


def first_seen(rows: DataFrame, order: list[str], sentence: str = "sentence") -> DataFrame:
    """The first row of each sentence by ``order``: an aggregate with a partial step, no window over hot sentences."""
    others = [c for c in rows.columns if c not in order and c != sentence]
    return rows.groupBy(sentence).agg(F.min(F.struct(*order, *others)).alias("f")).select(sentence, *[f"f.{c}" for c in [*order, *others]])


def unseen(rows: DataFrame, store: DataFrame, sentence: str = "sentence", stored: str = "text") -> DataFrame:
    """Rows whose sentence isn't in the store, by content address."""
    return rows.join(store.select(F.md5(stored).alias("__id")).distinct(), F.md5(F.col(sentence)) == F.col("__id"), "left_anti")


def page_counts(scored: DataFrame, key: str, proba: str = "proba", new: str = "new", opt: Options = Options()) -> DataFrame:
    hit = F.col(proba) >= opt.min_proba
    return scored.groupBy(key).agg(F.count(F.lit(1)).alias("sentence_count"), F.count_if(hit).alias("sg_count"), F.count_if(hit & F.col(new)).alias("new_count"))


# --- storage views ---------------------------------------------------------------------------------------------------


def url_counters(history: DataFrame, key: str, date: str, count: str, tie: str) -> DataFrame:
    """count, delta and delta_date of each URL from its crawl history."""
    last = F.struct(date, tie)
    return history.groupBy(key).agg(F.sum(count).alias("count"), F.max_by(count, last).alias("delta"), F.max(date).alias("delta_date"), F.count(F.lit(1)).alias("crawls"))


def enrich(pages: DataFrame, counters: DataFrame, key: str = "url") -> DataFrame:
    """Pages with their counters, unknown ones as new."""
    return pages.join(counters, key, "left")


def not_blacklisted(rows: DataFrame, blacklist: DataFrame, key: str = "url") -> DataFrame:
    return rows.join(blacklist.select(key).distinct(), key, "left_anti")


def blacklist_urls(urls_: DataFrame, failed: DataFrame, key: str = "url") -> tuple[DataFrame, DataFrame]:
    """(urls without the failed ones, the failed ones with a source): the two sets stay disjoint."""
    gone = failed.select(key, F.when(F.col("error").isNull(), "auto").otherwise("error").alias("source_type"), F.col("error").alias("source_extra"))
    return urls_.join(gone.select(key).distinct(), key, "left_anti"), gone


def insert_absent(store: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The store with the rows whose key it lacks; never overwrites."""
    return store.unionByName(rows.dropDuplicates([key]).join(store.select(key), key, "left_anti"), allowMissingColumns=True)


def text_store(rows: DataFrame, text: str, url: str, date: str) -> DataFrame:
    """Content-addressed texts with the set of their URLs and the first date."""
    return rows.groupBy(F.md5(text).alias("id")).agg(F.any_value(text).alias("text"), F.array_sort(F.collect_set(url)).alias("urls"), F.min(date).alias("date_added"))


def link_state(links: DataFrame, known: DataFrame, blacklist: DataFrame, link: str = "link") -> DataFrame:
    """BLACKLISTED over EXISTS over NOT_EXIST, as 2, 1, 0."""
    k, b = known.select(F.col("url").alias("__k")).distinct(), blacklist.select(F.col("url").alias("__b")).distinct()
    joined = links.join(k, F.col(link) == F.col("__k"), "left").join(b, F.col(link) == F.col("__b"), "left")
    return joined.withColumn("state", F.when(F.col("__b").isNotNull(), 2).when(F.col("__k").isNotNull(), 1).otherwise(0)).drop("__k", "__b")


# --- rounds ----------------------------------------------------------------------------------------------------------


def next_frontier(edges: DataFrame, frontier: DataFrame, visited: DataFrame, src: str = "src", dst: str = "dst", key: str = "url") -> DataFrame:
    """Unvisited targets of a frontier, each once with its smallest parent."""
    reached = frontier.join(edges, F.col(key) == F.col(src)).groupBy(F.col(dst).alias("__n")).agg(F.min(src).alias("parent"))
    return reached.join(visited.select(F.col(key).alias("__n")), "__n", "left_anti").select(F.col("__n").alias(key), "parent")


def rounds(edges: DataFrame, start: DataFrame, max_depth: int, src: str = "src", dst: str = "dst", key: str = "url", cut=checkpointed) -> tuple[DataFrame, DataFrame]:
    """(visited with depth and parent, leftovers beyond the depth). ``cut`` may checkpoint each round's set."""
    kind = dict(start.dtypes)[key]
    visited = cut(start.select(key, F.lit(None).cast(kind).alias("parent")).dropDuplicates([key]).withColumn("depth", F.lit(1)))
    frontier = visited
    for depth in range(2, max_depth + 1):
        frontier = cut(next_frontier(edges, frontier, visited, src, dst, key).withColumn("depth", F.lit(depth)))
        visited = cut(visited.unionByName(frontier))
    return visited, next_frontier(edges, frontier, visited, src, dst, key).withColumn("depth", F.lit(max_depth + 1))


@dataclass(frozen=True)
class Tools:
    """The stages of a crawl, each of which a user may exchange; the defaults do as little as a stage can."""

    crawler: Callable[[DataFrame], DataFrame] = extract.crawl  # (url, html) to (url, text, hrefs, error)
    normalizer: Callable[[Column], Column] = lambda text: text
    splitter: Callable[[Column], Column] = split.split_lines
    sentence_filter: Callable[[Column], Column] = lambda sentence: F.lit(True)
    sg_detector: Callable[[DataFrame], DataFrame] = langid.always  # adds proba to sentences
    seed_creator: Callable[[DataFrame], DataFrame] | None = None  # new sentences to n-grams
    url_filter: Callable[[Column, Column], Column] = lambda url, href: url  # null for links that aren't followed
    decider: Decider = Decider()
    saver: Callable[[Round], None] | None = None  # is given each round


def usual(detector: Callable[[DataFrame], DataFrame], opt: Options = Options()) -> Tools:
    """The usual stages with a detector."""
    return Tools(
        normalizer=lambda t: normalize.normalize(t, repair=opt.fix_encoding, emojis=not opt.strip_emojis),
        splitter=lambda t: split.split(t, opt.more, opt.keep_newlines),
        sentence_filter=lambda s: rules.valid(s, rules.DEFAULT),
        sg_detector=detector,
        url_filter=urls.fix,
        decider=BasicDecider(min_ratio=opt.min_ratio, active_recrawl=opt.active_recrawl, min_recrawl=opt.min_recrawl),
    )


@dataclass
class Round:
    """What one round over pages gives."""

    new_sentences: DataFrame
    counts: DataFrame
    blacklist: DataFrame
    children: DataFrame
    texts: DataFrame


def crawl_round(pages: DataFrame, store: DataFrame, blacklist: DataFrame, tools: Tools | Callable[[DataFrame], DataFrame], opt: Options = Options(), cut=lambda df: df) -> Round:
    """One breadth-first round: (url, html, depth, delta_date) to new sentences, counters, blacklist entries and children.

    ``tools`` are the stages, or a detector alone for the usual ones. ``cut`` may checkpoint what several results share:
    the extracted pages, the scored sentences and the counters. A URL that comes with several contents is one page: it has
    the distinct sentences and the links of all, and fails if all do.
    """
    tools = tools if isinstance(tools, Tools) else usual(tools, opt)
    ok = pages.filter(F.col("depth") <= opt.max_depth)
    got = cut(tools.crawler(ok))
    found = site_sentences(got.filter("error is null"), tools.normalizer, tools.splitter)
    scored = cut(tools.sg_detector(found.filter(tools.sentence_filter(F.col("sentence")))))
    hits = scored.filter(F.col("proba") >= opt.min_proba)
    fresh = unseen(first_seen(hits.select("sentence", "url", "pos", "proba"), ["url", "pos"]), store)
    marked = scored.join(fresh.select("url", "pos", F.lit(True).alias("new")), ["url", "pos"], "left").withColumn("new", F.coalesce("new", F.lit(False)))
    each = got.groupBy("url").agg(F.when(F.count_if(F.col("error").isNull()) == 0, F.min("error")).alias("error"), F.flatten(F.array_sort(F.collect_set("hrefs"))).alias("hrefs"))
    each = ok.groupBy("url").agg(F.min("depth").alias("depth"), F.max("delta_date").alias("delta_date")).join(each, "url")
    counts = each.join(page_counts(marked, "url", opt=opt), "url", "left")
    counts = cut(counts.fillna(0, ["sentence_count", "sg_count", "new_count"]))
    failed = counts.filter(F.col("error").isNotNull() | tools.decider.blacklist(F.col("delta_date"), F.col("sg_count"))).select("url", "error")
    follow = counts.filter(F.col("error").isNull() & ~tools.decider.blacklist(F.col("delta_date"), F.col("sg_count")) & tools.decider.follow(F.col("sentence_count"), F.col("sg_count"), F.col("new_count")))
    links = urls.filter_links(follow.withColumn("base", F.col("url")), "url", "base", "hrefs", tools.url_filter)
    children = not_blacklisted(links.join(follow.select("url", "depth"), "url").groupBy(F.col("link").alias("url")).agg(F.min(F.struct((F.col("depth") + 1).alias("depth"), F.col("url").alias("parent"))).alias("c")).select("url", "c.depth", "c.parent"), blacklist)
    return Round(fresh, counts.drop("hrefs"), failed, children, got.filter("error is null").select("url", "text"))


# --- bootstrap -------------------------------------------------------------------------------------------------------


def what(rows: DataFrame, kind: str, crawls: str = "crawls", source: str = "source") -> DataFrame:
    """any; new (never crawled); ext (never crawled and not found by crawling)."""
    if kind == "new":
        return rows.filter(F.coalesce(F.col(crawls), F.lit(0)) == 0)
    if kind == "ext":
        return rows.filter((F.coalesce(F.col(crawls), F.lit(0)) == 0) & (F.col(source) != "auto"))
    return rows


def oldest(rows: DataFrame, n: int, crawls: str, last: str, added: str, key: str) -> DataFrame:
    return rows.orderBy(F.col(crawls), F.col(last).asc_nulls_first(), F.col(added), F.col(key)).limit(n)


def sample(rows: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """A random sample that is the same in every run."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def loader_status(rows: DataFrame, url: str, known: DataFrame) -> DataFrame:
    """malformed, ignored, duplicate or enqueued for each line of a URL list."""
    fixed = urls.fix(F.col(url))
    r = rows.withColumn("__ok", urls.is_url(F.col(url))).withColumn("link", F.when(F.col("__ok"), fixed))
    each = F.coalesce("link", F.concat(F.lit("line "), F.col("line").cast("string")))  # lines without a link are alone
    seen = F.row_number().over(Window.partitionBy(each).orderBy("line")) > 1
    r = r.join(known.select(F.col("url").alias("__k")).distinct(), F.col("link") == F.col("__k"), "left")
    return r.withColumn("status", F.when(~F.col("__ok"), "malformed").when(F.col("link").isNull(), "ignored").when(F.col("__k").isNotNull() | seen, "duplicate").otherwise("enqueued")).drop("__ok", "__k")
