"""Review queries, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import crawl, review

from .crawling import _EVENTS, _events
from .text import _SENTENCES, _VALID, valid

NOT_VOTES = ["view", "remove"]


def _sentences(spark, d):
    """Valid sentences as stored rows: users validate, label and skip by rule."""
    pick = lambda m, r, u: F.when(F.col("n") % m == r, F.array(F.lit(u))).otherwise(F.array().cast("array<int>"))
    rows = valid(spark, d).withColumn("n", F.col("doc_id") * 7 + F.col("pos"))
    return rows.select(
        (F.col("doc_id") * 100000 + F.col("pos")).alias("id"), F.col("sentence").alias("text"), F.concat(F.lit("u"), F.col("doc_id") % 50).alias("url"), F.col("n").alias("date_added"), F.lit(0.9).alias("crawl_proba"),
        F.concat(pick(2, 0, 1), pick(3, 0, 2)).alias("validated_by"), pick(5, 0, 1).alias("skipped_by"),
        F.when(F.col("n") % 4 == 0, F.array(F.struct(F.lit(1).alias("user"), F.lit("be").alias("label"), F.col("n").alias("date")))).otherwise(F.array().cast("array<struct<user: int, label: string, date: bigint>>")).alias("labels"),
        F.when(F.col("n") % 11 == 0, F.lit("x")).alias("deleted"), F.when(F.col("n") % 4 == 0, "be").alias("dialect"),
    )


_ST = f"{_SENTENCES}, {_VALID}, st AS (SELECT doc_id * 100000 + pos AS id, sentence AS text, 'u' || (doc_id % 50) AS url, doc_id * 7 + pos AS n, doc_id * 7 + pos AS date_added, CASE WHEN (doc_id * 7 + pos) % 4 = 0 THEN 'be' END AS dialect FROM val)"


def sentence_search(spark, d):
    return review.search_sentences(_sentences(spark, d), text="Tion", dialects=["be", "zh"], validated=True).select("id", "url")


def url_search(spark, d):
    c = crawl.url_counters(_events(spark, d), "k", "ts", "n", "event_id").withColumn("url", F.concat(F.lit("http://U"), "k"))
    return review.search_urls(c, "u1", 100, True).select("url", "count")


def text_search(spark, d):
    s = crawl.text_store(spark.read.parquet(f"{d}/documents.parquet").withColumn("date", F.col("doc_id")), "text", "source", "date")
    return review.search_texts(s, "THE", 1).select("id", F.size("urls").cast("long").alias("n"))


def duplicate_texts(spark, d):
    s = crawl.text_store(spark.read.parquet(f"{d}/documents.parquet").withColumn("date", F.col("doc_id")), "text", "source", "date")
    return review.urls_of_texts(review.duplicate_texts(s))


def paginate_with_total(spark, d):
    return review.paginate(spark.read.parquet(f"{d}/customer.parquet").filter("c_acctbal > 0").select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.col("c_custkey")], 3)


def vote_latest(spark, d):
    return review.latest_votes(_events(spark, d), "k", "user_id", "event_type", ["ts", "event_id"])


def dialect_majority(spark, d):
    return review.majority(review.votes(vote_latest(spark, d), "event_type", NOT_VOTES), "k", "event_type", "ts").withColumn("confidence", F.round("confidence", 6))


def to_validate(spark, d):
    return review.to_validate(_sentences(spark, d), 1).select("id", "url")


def to_label(spark, d):
    return review.to_label(_sentences(spark, d), 1, "the").select("id", "url")


def user_history(spark, d):
    return review.user_history(_sentences(spark, d), 1, 2).select("id", "label", "date")


def validate_page(spark, d):
    s = _sentences(spark, d)
    v = review.validate(s, s.filter("id % 3 = 0"), 9)
    return v.groupBy(F.array_contains("validated_by", 9).alias("mine")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("validated_by")).alias("marks"))


def soft_delete(spark, d):
    s = _sentences(spark, d).withColumn("deleted", F.lit(None).cast("struct<by: string, comment: string, date: bigint>"))
    gone = review.mark_deleted(s, s.filter("id % 3 = 0"), "me", F.lit(5).cast("long"))
    back = review.unmark_deleted(gone, s.filter("id % 6 = 0"))
    return back.groupBy(F.col("deleted").isNull().alias("alive")).agg(F.count(F.lit(1)).alias("n"))


def export_csv_rows(spark, d):
    s = _sentences(spark, d).filter("deleted is null").withColumns({"dialect_confidence": F.when(F.col("dialect").isNotNull(), 1.0).otherwise(0.0), "dialect_nb_votes": F.size("labels").cast("long")})
    return review.export_rows(s.withColumn("text", F.md5("text")))


def delete_cascade(spark, d):
    s = _sentences(spark, d)
    u = s.select("url").distinct()
    return review.delete_cascade(u, s, u.filter("url like 'u1%'"))["deleted"]


def remaining_per_url(spark, d):
    return review.remaining_per_url(_sentences(spark, d))


def user_counts(spark, d):
    return review.user_counts(_sentences(spark, d), 1)


QUERIES = {f.__name__: f for f in (sentence_search, url_search, text_search, duplicate_texts, paginate_with_total, vote_latest, dialect_majority, to_validate, to_label, user_history, validate_page, soft_delete, export_csv_rows, delete_cascade, remaining_per_url, user_counts)}
_VOTES = f"WITH {_EVENTS}, lv AS (SELECT k, user_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS event_type, max(ts) AS ts FROM ev GROUP BY ALL)"
_TEXTS = "WITH t AS (SELECT md5(text) AS id, any_value(text) AS text, list_distinct(list(source)) AS urls FROM documents GROUP BY 1)"
_ALIVE = "n % 11 <> 0"
ORACLE_SQL = {
    "sentence_search": f"{_ST} SELECT id, url FROM st WHERE lower(text) LIKE '%tion%' AND dialect = 'be' AND (n % 2 = 0 OR n % 3 = 0) AND {_ALIVE}",
    "url_search": f"WITH {_EVENTS} SELECT 'http://U' || k AS url, sum(n)::BIGINT AS count FROM ev WHERE 'u' || k LIKE 'u1%' GROUP BY k HAVING sum(n) >= 100",
    "text_search": f"{_TEXTS} SELECT id, len(urls) AS n FROM t WHERE lower(text) LIKE '%the%' AND len(urls) > 1",
    "duplicate_texts": f"{_TEXTS} SELECT id, unnest(urls) AS url FROM t WHERE len(urls) > 1",
    "paginate_with_total": "SELECT c_custkey, c_acctbal, (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS total FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 40",
    "vote_latest": f"{_VOTES} SELECT * FROM lv",
    "dialect_majority": f"{_VOTES}, p AS (SELECT k, event_type AS label, count(*) AS count, min(ts) AS f FROM lv WHERE event_type NOT IN ('view', 'remove') GROUP BY ALL) SELECT k, label, count, round(count / sum(count) OVER (PARTITION BY k), 6) AS confidence FROM p QUALIFY row_number() OVER (PARTITION BY k ORDER BY count DESC, f, label) = 1",
    "to_validate": f"{_ST} SELECT id, url FROM st WHERE {_ALIVE} AND n % 2 <> 0 ORDER BY url, date_added, id LIMIT 100",
    "to_label": f"{_ST} SELECT id, url FROM st WHERE {_ALIVE} AND (n % 2 = 0 OR n % 3 = 0) AND n % 4 <> 0 AND n % 5 <> 0 AND lower(text) LIKE '%the%' ORDER BY url, date_added, id LIMIT 50",
    "user_history": f"{_ST} SELECT id, 'be' AS label, n AS date FROM st WHERE n % 4 = 0 ORDER BY n DESC, id LIMIT 10 OFFSET 10",
    "validate_page": f"{_ST} SELECT id % 3 = 0 AS mine, count(*) AS n, sum((n % 2 = 0)::INT + (n % 3 = 0)::INT + (id % 3 = 0)::INT)::BIGINT AS marks FROM st GROUP BY 1",
    "soft_delete": f"{_ST} SELECT NOT (id % 3 = 0 AND id % 6 <> 0) AS alive, count(*) AS n FROM st GROUP BY 1",
    "export_csv_rows": f"{_ST} SELECT id, md5(text) AS text, url, 0.9::DOUBLE AS crawl_proba, dialect, (CASE WHEN dialect IS NULL THEN 0.0 ELSE 1.0 END)::DOUBLE AS dialect_confidence, CAST(n % 4 = 0 AS BIGINT) AS dialect_nb_votes FROM st WHERE {_ALIVE}",
    "delete_cascade": f"{_ST} SELECT url, count(*) AS n_sentences FROM st WHERE url LIKE 'u1%' GROUP BY 1",
    "remaining_per_url": f"{_ST} SELECT url, count(*) AS remaining FROM st WHERE {_ALIVE} GROUP BY 1",
    "user_counts": f"{_ST} SELECT count_if(n % 2 = 0) AS validated, count_if(n % 5 = 0) AS skipped FROM st",
}
