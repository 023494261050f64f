"""Query seeds: generation, selection, search acceptance and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import ngrams, without_numbers, without_words, words
from corpusloom.operators.crawl import checkpointed


def top_ngrams(rows: DataFrame, text: str = "sentence", n: int | tuple[int, int] = 3, most: int = 10, stop_words: list[str] = ()) -> DataFrame:
    """The most frequent word n-grams without stop words; ties by n-gram descending."""
    found = ngrams(without_words(words(F.col(text)), list(stop_words)), n)
    return rows.select(F.explode(found).alias("ngram")).groupBy("ngram").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("ngram")).limit(most)


def tfidf_ngrams(rows: DataFrame, key: list[str], text: str = "sentence", n: int | tuple[int, int] = 3, most: int = 10, stop_words: list[str] = (), sanitize: bool = True) -> DataFrame:
    """N-grams by the sum over texts of l2-normalised (1 + ln tf) (ln((1 + N) / (1 + df)) + 1); ``sanitize`` removes numbers."""
    clean = without_numbers(F.col(text)) if sanitize else F.col(text)
    tf = rows.select(*key, F.explode(ngrams(without_words(words(clean), list(stop_words)), n)).alias("ngram")).groupBy(*key, "ngram").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("ngram").agg(F.count(F.lit(1)).alias("df"))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    weighed = tf.join(df, "ngram").join(F.broadcast(total), F.lit(True)).withColumn("w", (1 + F.log("tf")) * (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1))
    norm = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    scored = weighed.join(norm, key).groupBy("ngram").agg(F.round(F.sum(F.col("w") / F.col("norm")), 6).alias("score"))
    return scored.orderBy(F.desc("score"), F.desc("ngram")).limit(most)


def newest_sentences(rows: DataFrame, n: int, date: str, key: str) -> DataFrame:
    return rows.orderBy(F.desc(date), F.col(key)).limit(n)


def unused(seeds: DataFrame, n: int, skip_deleted: bool = False) -> DataFrame:
    """Seeds never searched, by source descending."""
    rows = seeds.filter("num_searches = 0")
    return (rows.filter("not deleted") if skip_deleted else rows).orderBy(F.desc("source"), "id").limit(n)


def any_seeds(seeds: DataFrame, n: int, skip_deleted: bool = False) -> DataFrame:
    rows = seeds.filter("not deleted") if skip_deleted else seeds
    return rows.orderBy("num_searches", F.desc("source"), "date_added", F.col("last_searched").asc_nulls_first(), "id").limit(n)


def seed_counters(history: DataFrame, key: str, count: str, date: str) -> DataFrame:
    return history.groupBy(key).agg(F.sum(count).alias("count"), F.max(date).alias("delta_date"), F.count(F.lit(1)).alias("usages"))


def top_results(results: DataFrame, k: int, query: str = "query", rank: str = "rank") -> DataFrame:
    return results.withColumn("__r", F.row_number().over(Window.partitionBy(query).orderBy(rank))).filter(F.col("__r") <= k).drop("__r")


def as_fetched(results: DataFrame, page: int = 10, query: str = "query", rank: str = "rank") -> DataFrame:
    """Results (ranks from zero, without gaps) with ``fetched``, their place as a client that reads pages hands them out: each page from its end."""
    number = F.floor(F.col(rank) / page)
    size = F.count(F.lit(1)).over(Window.partitionBy(query, number))
    return results.withColumn("fetched", (number * page + size - 1 - F.col(rank) % page).cast("long"))


def accept(results: DataFrame, known: DataFrame, blacklist: DataFrame, most: int = 10, max_fetches: int = -1, order: str = "seed_order", cut=checkpointed) -> DataFrame:
    """Results (seed_order, query, rank, link) that become URLs, as if the queries were searched one after the other.

    No blacklisted or known links, each link once over all queries, and no more than ``most`` for a query; a query also
    ends with the first link that it takes from rank ``max_fetches`` (counted from zero) on. A link that a query doesn't
    come to is free for later ones: rounds drop such links until there are none, one round a query at most.
    """
    rows = results.filter("link is not null")
    for gone in (blacklist, known):
        rows = rows.join(gone.select(F.col("url").alias("link")).distinct(), "link", "left_anti")
    rows = cut(rows.groupBy("link", "query", order).agg(F.min("rank").alias("rank")))
    in_rank = Window.partitionBy("query").orderBy("rank", "link")
    while True:
        first = rows.groupBy("link").agg(F.min(F.struct(order, "rank", "query")).alias("f")).select("link", f"f.{order}", "f.rank", "f.query")
        first = first.withColumns({"taken": F.row_number().over(in_rank), "before": F.lag("rank").over(in_rank)})
        within = F.col("taken") <= most
        if max_fetches > 0:
            within &= F.coalesce(F.col("before") < max_fetches, F.lit(True))
        first = cut(first.withColumn("within", within).drop("before"))
        late = first.filter("not within").select("link", "query")
        if late.isEmpty():
            return first.drop("within")
        rows = cut(rows.join(late, ["link", "query"], "left_anti"))


def save_searched(seeds: DataFrame, taken: DataFrame, date: Column) -> tuple[DataFrame, DataFrame]:
    """What a search leaves: (a use of every seed searched, with its number of new links; the new URLs with the seed as their source).

    ``seeds`` are the queries searched (query); ``taken`` is what :func:`accept` gave.
    """
    n = taken.groupBy("query").agg(F.count(F.lit(1)).alias("count"))
    uses = seeds.select("query").distinct().join(n, "query", "left").select(F.col("query").alias("id"), date.alias("date"), F.coalesce("count", F.lit(0)).alias("count"))
    urls = taken.select(F.col("link").alias("url"), F.struct(F.lit("seed").alias("type"), F.col("query").alias("extra")).alias("source"), date.alias("date_added"))
    return uses, urls


def similar(seeds: DataFrame, query: str, column: str = "id") -> DataFrame:
    """Seeds that hold one of the query's words, in any case; a single word is searched as a substring."""
    parts = query.split()
    if len(parts) == 1:
        return seeds.filter(F.contains(F.lower(column), F.lit(query.lower())))
    return seeds.filter(F.col(column).rlike("(?i)" + "|".join(f"({p})" for p in parts)))


def quality(uses: DataFrame, history: DataFrame, key: str = "seed") -> DataFrame:
    """(seed, usages, count, urls, urls_sg, sentences) and the ratios that follow from them.

    ``uses`` has a row for each URL of a seed (seed, url, crawls, sentences), ``history`` one for each search (seed, count).
    """
    u = uses.groupBy(key).agg(F.count("url").alias("urls"), F.count_if(F.col("crawls") > 0).alias("urls_sg"), F.coalesce(F.sum("sentences"), F.lit(0)).alias("sentences"))
    h = history.groupBy(key).agg(F.count(F.lit(1)).alias("usages"), F.sum("count").alias("count"))
    return derived(h.join(u, key, "left").fillna(0, ["urls", "urls_sg", "sentences"]))


def derived(rows: DataFrame) -> DataFrame:
    rows = rows.filter("usages > 0").withColumn("not_visited", F.col("urls") - F.col("urls_sg")).withColumn("visited", F.col("count") - F.col("not_visited"))
    return rows.withColumns({"blacklisted": F.col("visited") - F.col("urls_sg"), "ratio": _over(F.col("urls_sg"), F.col("visited")), "s_ratio": F.col("sentences") / (1 + 10 * F.col("count"))})


def _over(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(0.0)


def search(report: DataFrame, pattern: str = "", min_count: int = 0, deleted: bool = False, key: str = "seed") -> DataFrame:
    """Seeds by case-sensitive pattern; ``min_count`` bounds both URLs and usages."""
    rows = report if deleted or "deleted" not in report.columns else report.filter("deleted is null")
    return rows.filter(F.col(key).rlike(pattern) & (F.col("urls") >= min_count) & (F.col("usages") >= min_count))


def searchable(link: Column) -> Column:
    """Whether a search result may be a page: no videos and no office documents."""
    return ~link.rlike(r"(?i)youtube\.|\.pdf($|\?)|\.docx?($|\?)")


def delete(store: DataFrame, ids: DataFrame, date: Column, by: str = "user") -> DataFrame:
    """Seeds that were searched are marked deleted, others go."""
    gone = ids.select("id", F.lit(True).alias("__d")).distinct()
    marked = store.join(gone, "id", "left").filter(F.col("__d").isNull() | (F.col("num_searches") > 0))
    return marked.withColumn("deleted", F.when(F.col("__d"), F.struct(F.lit(by).alias("by"), F.lit("").alias("comment"), date.alias("date")))).drop("__d")
