"""Review queries: search forms, validation, votes and majorities, pages and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def icontains(c: Column, what: str) -> Column:
    return F.contains(F.lower(c), F.lit(what.lower()))


def search_sentences(rows: DataFrame, text: str = "", url: str = "", dialects: list[str] | None = None, labelled: bool = False, validated: bool = False, deleted: bool = False) -> DataFrame:
    if text:
        rows = rows.filter(icontains(F.col("text"), text))
    if url:
        rows = rows.filter(icontains(F.col("url"), url))
    if dialects:
        rows = rows.filter(F.col("dialect").isin(dialects))
    if labelled:
        rows = rows.filter(F.col("dialect").isNotNull())
    if validated:
        rows = rows.filter(F.size("validated_by") > 0)
    return rows if deleted else rows.filter(F.col("deleted").isNull())


def search_urls(rows: DataFrame, url: str = "", min_count: int = 0, crawled: bool | None = None) -> DataFrame:
    rows = rows.filter(icontains(F.col("url"), url) & (F.coalesce(F.col("count"), F.lit(0)) >= min_count))
    return rows if crawled is None else rows.filter((F.coalesce(F.col("crawls"), F.lit(0)) > 0) == F.lit(crawled))


def search_texts(rows: DataFrame, text: str = "", n_urls: int = 0) -> DataFrame:
    """Texts with more than ``n_urls`` URLs."""
    return rows.filter(icontains(F.col("text"), text) & (F.size("urls") > n_urls))


def similar_urls(rows: DataFrame, url: str, column: str = "url") -> DataFrame:
    return rows.filter(icontains(F.col(column), url.split("?")[0].rstrip("/")))


def paginate(rows: DataFrame, order: list[Column], page: int, size: int = 20) -> DataFrame:
    """One page with the overall count in each row: a top-k for the page, an aggregate for the count."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    shown = rows.orderBy(*order).offset((page - 1) * size).limit(size)
    return shown.join(F.broadcast(total), F.lit(True))  # one row of one number


def latest_votes(events: DataFrame, item: str, user: str, action: str, order: list[str]) -> DataFrame:
    """The last action of each user on each item."""
    return events.groupBy(item, user).agg(F.max_by(action, F.struct(*order)).alias(action), F.max(order[0]).alias(order[0]))


def votes(latest: DataFrame, action: str, not_votes: list[str]) -> DataFrame:
    """Those that are labels: a skip or a removal takes the vote back."""
    return latest.filter(~F.col(action).isin(not_votes))


def majority(rows: DataFrame, item: str, label: str, date: str) -> DataFrame:
    """(item, label, count, confidence): the most frequent label, ties to the one voted first, then by name."""
    per = rows.groupBy(item, label).agg(F.count(F.lit(1)).alias("count"), F.min(date).alias("first"))
    best = per.groupBy(item).agg(F.min(F.struct((-F.col("count")).alias("c"), "first", F.col(label).alias("label"))).alias("b"), F.sum("count").alias("all"))
    return best.select(item, F.col("b.label").alias("label"), (-F.col("b.c")).alias("count"), (-F.col("b.c") / F.col("all")).alias("confidence"))


def to_validate(rows: DataFrame, user: int | str, url: str | None = None, most: int = 100) -> DataFrame:
    rows = rows.filter(F.col("deleted").isNull() & ~F.array_contains("validated_by", user))
    return (rows.filter(F.col("url") == url) if url else rows).orderBy("url", "date_added", "id").limit(most)


def to_label(rows: DataFrame, user: int | str, text: str = "", most: int = 50) -> DataFrame:
    rows = rows.filter(F.col("deleted").isNull() & (F.size("validated_by") > 0) & ~F.exists("labels", lambda x: x["user"] == user) & ~F.array_contains("skipped_by", user))
    return rows.filter(icontains(F.col("text"), text)).orderBy("url", "date_added", "id").limit(most)


def user_history(rows: DataFrame, user: int | str, page: int = 1, size: int = 10) -> DataFrame:
    """A user's own votes, newest first."""
    mine = rows.withColumn("vote", F.get(F.filter("labels", lambda x: x["user"] == user), F.lit(0))).filter("vote is not null")
    return mine.select("id", "vote.label", "vote.date").orderBy(F.desc("date"), "id").offset((page - 1) * size).limit(size)


def validate(rows: DataFrame, ids: DataFrame, user: int | str) -> DataFrame:
    """Adds the user to the validators of the given ids, as a set."""
    marked = rows.join(ids.select("id").distinct().withColumn("__v", F.lit(True)), "id", "left")
    return marked.withColumn("validated_by", F.when(F.col("__v"), F.array_union("validated_by", F.array(F.lit(user)))).otherwise(F.col("validated_by"))).drop("__v")


def mark_deleted(rows: DataFrame, ids: DataFrame, by: str, date: Column, comment: str = "", key: str = "id") -> DataFrame:
    marked = rows.join(ids.select(key).distinct().withColumn("__d", F.lit(True)), key, "left")
    entry = F.struct(F.lit(by).alias("by"), F.lit(comment).alias("comment"), date.alias("date"))
    return marked.withColumn("deleted", F.when(F.col("__d"), entry).otherwise(F.col("deleted"))).drop("__d")


def unmark_deleted(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    marked = rows.join(ids.select(key).distinct().withColumn("__d", F.lit(True)), key, "left")
    return marked.withColumn("deleted", F.when(F.col("__d").isNull(), F.col("deleted"))).drop("__d")


def delete_cascade(urls: DataFrame, sentences: DataFrame, gone: DataFrame, key: str = "url") -> dict[str, DataFrame]:
    """URLs that go: the URLs left, the sentences deleted with them by ``key``, and the new blacklist entries."""
    keys = gone.select(key).distinct()
    return {
        "urls": urls.join(keys, key, "left_anti"),
        "deleted": sentences.join(keys, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n_sentences")),
        "blacklist": keys.withColumn("source_type", F.lit("user")),
    }


def delete_found(urls: DataFrame, sentences: DataFrame, sure: bool, key: str = "url", **search) -> dict[str, DataFrame]:
    """:func:`delete_cascade` for what a search finds; a search without any filter, or one that isn't confirmed, deletes nothing and raises."""
    if not sure:
        raise ValueError("not confirmed")
    if not any(v not in ("", 0, None) for v in search.values()):
        raise ValueError("a bulk delete needs a filter")
    return delete_cascade(urls, sentences, search_urls(urls, **search), key)


def add_url(rows: DataFrame, url: str, user: str, date: Column, sure: bool = False) -> tuple[str, DataFrame]:
    """(exists, similar or added; the URL's row, up to ten similar ones unless ``sure``, or the rows with the new one)."""
    same = rows.filter(F.col("url") == url)
    if not same.isEmpty():
        return "exists", same
    alike = similar_urls(rows, url).orderBy("url").limit(10)
    if not sure and not alike.isEmpty():
        return "similar", alike
    new = rows.sparkSession.range(1).select(F.lit(url).alias("url"), F.struct(F.lit("user").alias("type"), F.lit(user).alias("extra")).alias("source"), date.alias("date_added"))
    return "added", rows.unionByName(new, allowMissingColumns=True)


def next_to_label(rows: DataFrame, user: int | str, id_: str | None = None) -> DataFrame:
    """The sentence to label, with the user's label so far (``?`` if skipped) and how many of its URL are left: the one asked for, if it is validated, else the first of those to label."""
    if id_ is None:
        one = to_label(rows, user, most=1)
    else:
        one = rows.filter((F.col("id") == id_) & (F.size("validated_by") > 0))
    mine = F.get(F.filter("labels", lambda x: x["user"] == user), F.lit(0))["label"]
    one = one.withColumn("current", F.when(F.array_contains("skipped_by", user), "?").otherwise(mine))
    left = to_label(rows, user, most=1 << 30).groupBy(F.col("url").alias("__url")).agg(F.count(F.lit(1)).alias("remaining"))
    return one.join(left, F.col("url") == F.col("__url"), "left").drop("__url").withColumn("remaining", F.coalesce("remaining", F.lit(0)))


def label_one(rows: DataFrame, id_: str, user: int | str, value: str, date: Column, delete: bool = False) -> DataFrame:
    """The rows after a user's answer for one sentence: deleted, skipped (values that begin with ?), or labelled; a new label or skip takes the place of the old one."""
    it, skip = F.col("id") == id_, value.startswith("?")
    if delete:
        return mark_deleted(rows, rows.filter(it).select("id"), str(user), date)
    others = F.filter("labels", lambda x: x["user"] != user)
    label = F.array(F.struct(F.lit(user).alias("user"), F.lit(value).alias("label"), date.alias("date")))
    skippers = F.array_except("skipped_by", F.array(F.lit(user)))
    rows = rows.withColumn("labels", F.when(it, others if skip else F.concat(others, label.cast(dict(rows.dtypes)["labels"]))).otherwise(F.col("labels")))
    return rows.withColumn("skipped_by", F.when(it, F.concat(skippers, F.array(F.lit(user))) if skip else skippers).otherwise(F.col("skipped_by")))


def export_rows(rows: DataFrame) -> DataFrame:
    """The columns of the CSV export."""
    return rows.select("id", "text", "url", "crawl_proba", "dialect", "dialect_confidence", "dialect_nb_votes")


def bulk_labels(form: DataFrame, user: int | str) -> DataFrame:
    """Form rows (key, value) to vote events: ``sentence-<id>`` keys, values that begin with ? are skips."""
    rows = form.filter(F.startswith("key", F.lit("sentence-")))
    return rows.select(F.regexp_replace("key", "^sentence-", "").alias("id"), F.lit(user).alias("user"), F.when(F.startswith("value", F.lit("?")), "skip").otherwise(F.col("value")).alias("action"))


def duplicate_texts(store: DataFrame) -> DataFrame:
    return store.filter(F.size("urls") > 1)


def user_counts(rows: DataFrame, user: int | str) -> DataFrame:
    return rows.agg(F.count_if(F.array_contains("validated_by", user)).alias("validated"), F.count_if(F.array_contains("skipped_by", user)).alias("skipped"))


def remaining_per_url(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("deleted").isNull()).groupBy("url").agg(F.count(F.lit(1)).alias("remaining"))


def urls_of_texts(texts: DataFrame) -> DataFrame:
    return texts.select("id", F.explode("urls").alias("url"))
