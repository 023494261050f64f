"""Queries on crawl state: visits, decisions, selections, frontiers and seeds, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import langid
from corpusloom.functions import text as text_
from corpusloom.operators import crawl, seeds

from . import sql
from .text import _MODEL, _SENTENCES, _VALID, valid

ASOF = "2024-01-31 00:00:00"
_SEEDS = """(SELECT c_name AS id, ['user', 'seed', 'file', 'error', 'auto'][c_nationkey % 5 + 1] AS source, DATE '2024-01-01' + (c_custkey % 20)::INTEGER AS date_added, c_custkey % 4 AS num_searches,
    CASE WHEN c_custkey % 8 <> 0 THEN DATE '2024-02-01' + (c_custkey % 13)::INTEGER END AS last_searched, c_custkey % 7 = 0 AS deleted FROM customer) v"""


def _events(spark, d):
    """Events as crawl history: the key in props is the URL, the floor of the value the new sentences."""
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"), F.floor("value").cast("long").alias("n"))


_EVENTS = "ev AS (SELECT event_id, ts, user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(floor(value) AS BIGINT) AS n FROM events)"
_COUNTERS = "uc AS (SELECT k, sum(n)::BIGINT AS count, arg_max(n, struct_pack(a := ts, b := event_id)) AS delta, max(ts) AS delta_date, count(*) AS crawls, min(ts) AS added FROM ev GROUP BY k)"


def url_counters(spark, d):
    return crawl.url_counters(_events(spark, d), "k", "ts", "n", "event_id")


def decider_recrawl(spark, d):
    c = url_counters(spark, d)
    return c.select("k", crawl.should_crawl(F.col("delta_date"), F.col("delta") % 2, F.lit(ASOF), crawl.Options(active_recrawl="26h", min_recrawl="28h")).alias("again"), crawl.should_crawl_new_only(F.col("delta_date")).alias("new"))


def _counts(spark, d):
    """Sentences by document with a stand-in for hits."""
    return valid(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("sentences"), F.count_if(F.col("sentence").rlike("^[A-M]")).alias("hits"), F.count_if(F.col("pos") == 0).alias("new"))


def decider_children(spark, d):
    s, h = F.col("sentences"), F.col("hits")
    opt = crawl.Options(min_ratio=3)
    return _counts(spark, d).select("doc_id", crawl.should_follow(s, h, opt).alias("follow"), crawl.should_follow_share(s, h).alias("share"), crawl.should_follow_new(s, h, F.col("new"), opt).alias("follow_new"))


def blacklist_decision(spark, d):
    return _counts(spark, d).select("doc_id", crawl.should_blacklist(F.when(F.col("doc_id") % 3 == 0, F.lit(ASOF)), F.col("hits")).alias("blacklist"))


def _visits(spark, d):
    """Customers as URLs, orders of status F as crawls."""
    c, o = spark.read.parquet(f"{d}/customer.parquet"), spark.read.parquet(f"{d}/orders.parquet").filter("o_orderstatus = 'F'")
    v = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("crawls"), F.max("o_orderdate").alias("last"))
    return c.join(v, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.when(F.col("c_nationkey") % 2 == 0, "auto").otherwise("file").alias("source"), F.coalesce("crawls", F.lit(0)).alias("crawls"), "last")


_VISITS = "vi AS (SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'auto' ELSE 'file' END AS source, coalesce(crawls, 0) AS crawls, last FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS crawls, max(o_orderdate) AS last FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey)"


def bootstrap_oldest(spark, d):
    return crawl.oldest(_visits(spark, d), 50, "crawls", "last", "c_custkey", "c_custkey").select("c_custkey", "crawls")


def bootstrap_new(spark, d):
    return crawl.what(_visits(spark, d), "new").select("c_custkey")


def bootstrap_ext(spark, d):
    return crawl.what(_visits(spark, d), "ext").select("c_custkey")


def bootstrap_sample(spark, d):
    return crawl.sample(_visits(spark, d), 50, "c_custkey").select("c_custkey")


def frontier_rounds(spark, d):
    """Breadth-first rounds over two synthetic links of each page."""
    p = spark.read.parquet(f"{d}/pages.parquet").select(F.col("page_id").alias("src"))
    p = p.join(F.broadcast(p.agg(F.count(F.lit(1)).alias("n"))), F.lit(True))  # one row of one number
    edges = p.select("src", F.explode(F.array((F.col("src") * 7 + 3) % F.col("n"), (F.col("src") * 13 + 5) % F.col("n"))).alias("dst"))
    visited, left = crawl.rounds(edges, spark.range(1).select(F.col("id").alias("url")), 4)
    return visited.unionByName(left).select("url", "parent", F.col("depth").cast("long").alias("depth"))


def link_state(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet")
    known, black = pages.filter("page_id % 2 = 0").select("url"), pages.filter("page_id % 5 = 0").select("url")
    return crawl.link_state(pages.select("page_id", F.col("url").alias("link")), known, black).select("page_id", "state")


def seeds_ngram(spark, d):
    return seeds.top_ngrams(valid(spark, d), most=20)


def seeds_tfidf(spark, d):
    return seeds.tfidf_ngrams(valid(spark, d), ["doc_id", "pos"], most=20)


def seeds_ranges(spark, d):
    """Runs of one to three words, without stop words."""
    return seeds.top_ngrams(valid(spark, d), n=(1, 3), most=40, stop_words=["the", "of", "der", "die"])


def query_builders(spark, d):
    g = seeds.top_ngrams(valid(spark, d), most=20)
    return g.select("ngram", text_.quoted(F.col("ngram")).alias("whole"), text_.quoted_words(F.col("ngram")).alias("words"))


def newest_sentences(spark, d):
    return seeds.newest_sentences(valid(spark, d).withColumn("id", F.col("doc_id") * 1000 + F.col("pos")), 20, "doc_id", "id").select("doc_id", "pos")


def _seeds(spark, d):
    """Customers as seeds: sources, searches and deletions by rule."""
    c, k = spark.read.parquet(f"{d}/customer.parquet"), F.col("c_custkey")
    source = F.element_at(F.array(*[F.lit(x) for x in ("user", "seed", "file", "error", "auto")]), F.col("c_nationkey") % 5 + 1)
    day = lambda first, n: F.date_add(F.lit(first).cast("date"), (k % n).cast("int"))
    return c.select(F.col("c_name").alias("id"), source.alias("source"), day("2024-01-01", 20).alias("date_added"), (k % 4).alias("num_searches"), F.when(k % 8 != 0, day("2024-02-01", 13)).alias("last_searched"), (k % 7 == 0).alias("deleted"))


def seed_selection_new(spark, d):
    return seeds.unused(_seeds(spark, d), 9).select("id", "source")


def seed_selection_any(spark, d):
    return seeds.any_seeds(_seeds(spark, d), 30, True).select("id", "source")


def search_order(spark, d):
    """Results in the order in which a client hands them out: each page of ten from its end."""
    return seeds.as_fetched(_results(spark, d)).select("query", "rank", "fetched")


def _results(spark, d):
    """Pages as the results of eight queries, a link in more than one of them."""
    r = spark.read.parquet(f"{d}/pages.parquet").select(F.col("page_id").alias("id"))
    return r.select((F.col("id") % 8).alias("seed_order"), F.concat(F.lit("q"), F.col("id") % 8).alias("query"), F.floor(F.col("id") / 8).cast("long").alias("rank"), F.concat(F.lit("http://h"), (F.col("id") * 37) % 150 % 61, F.lit(".ch/")).alias("link"))


def _seen(spark, d, rest):
    return _results(spark, d).filter(F.regexp_extract("link", "h([0-9]+)", 1).cast("int") % 10 == rest).select(F.col("link").alias("url"))


def search_accept(spark, d):
    return seeds.accept(_results(spark, d), _seen(spark, d, 3), _seen(spark, d, 4), 5).select("query", "rank", "link")


def search_fetches(spark, d):
    """The search ends with the first link that is taken from the third fetch on; what it leaves are uses of the seeds and new URLs."""
    results = _results(spark, d)
    taken = seeds.accept(results, _seen(spark, d, 3), _seen(spark, d, 4), 50, max_fetches=3)
    uses, urls = seeds.save_searched(results, taken, F.lit("2024-01-01").cast("timestamp"))
    return uses.select(F.col("id").alias("query"), "count", F.lit(None).cast("string").alias("url")).unionByName(urls.select(F.col("source.extra").alias("query"), F.lit(None).cast("long").alias("count"), "url"))


def top_results(spark, d):
    return seeds.top_results(_results(spark, d), 5).select("query", "rank", "link")


def similar_seeds(spark, d):
    s = seeds.top_ngrams(valid(spark, d), most=200)
    return seeds.similar(s, "The of", "ngram").select("ngram")


def seed_report(spark, d):
    """Nations as seeds, customers as their URLs, orders as crawl entries."""
    n, c, o = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("nation", "customer", "orders"))
    per = o.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("crawls"), F.count_if(F.col("o_orderkey") % 2 == 0).alias("sentences"))
    uses = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("n_name").alias("seed"), F.col("c_custkey").alias("url"), "crawls", "sentences")
    history = c.filter("c_mktsegment = 'BUILDING'").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("seed"), F.lit(7).cast("long").alias("count"))
    q = seeds.quality(uses, history)
    return seeds.search(q, "", 1).select("seed", "usages", "count", "urls", "urls_sg", "sentences", "not_visited", "visited", "blacklisted", F.round("ratio", 6).alias("ratio"), F.round("s_ratio", 6).alias("s_ratio"))


def lid_model(spark, d):
    m = langid.fit(spark.read.parquet(f"{d}/documents.parquet"))
    return m.select("label", "gram", F.round("weight", 6).alias("weight"))


_TOK = "list_filter(regexp_extract_all(lower({t}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: true)"
_NG = f"ng AS (SELECT doc_id, pos, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS ngram FROM (SELECT doc_id, pos, {_TOK.format(t='sentence')} AS w FROM val))"
_NO_NUMBERS = "lower(regexp_replace(sentence, '(?:^|[^\\p{L}\\p{N}_])\\p{Nd}+(?:$|[^\\p{L}\\p{N}_])', ' ', 'g'))"
_TOP = "SELECT ngram, count(*) AS n FROM ng GROUP BY 1 ORDER BY n DESC, ngram DESC LIMIT "
QUERIES = {f.__name__: f for f in (url_counters, decider_recrawl, decider_children, blacklist_decision, bootstrap_oldest, bootstrap_new, bootstrap_ext, bootstrap_sample, frontier_rounds, link_state, seeds_ngram, seeds_tfidf, seeds_ranges, query_builders, newest_sentences, seed_selection_new, seed_selection_any, search_order, search_accept, search_fetches, top_results, similar_seeds, seed_report, lid_model)}
_CNT = f"{_SENTENCES}, {_VALID}, c AS (SELECT doc_id, count(*) AS sentences, count_if(regexp_matches(sentence, '^[A-M]')) AS hits, count_if(pos = 0) AS new FROM val GROUP BY 1)"
_RES = "r AS (SELECT page_id % 8 AS seed_order, 'q' || (page_id % 8) AS query, page_id // 8 AS rank, 'http://h' || ((page_id * 37) % 150 % 61) || '.ch/' AS link, (page_id * 37) % 150 % 61 AS h FROM pages)"


def _accepted(most: int, fetches: int) -> str:
    """One query after the other, with the links taken so far. Of a query's links the first ``most``, and none after one of rank ``fetches`` or more."""
    return f"""WITH RECURSIVE {_RES}, c AS (SELECT seed_order, query, link, min(rank) AS rank FROM r WHERE h % 10 NOT IN (3, 4) GROUP BY ALL),
        l AS (SELECT s AS seed_order, coalesce(list(struct_pack(rank := rank, link := link) ORDER BY rank, link) FILTER (link IS NOT NULL), []) AS l FROM range(8) t(s) LEFT JOIN c ON seed_order = s GROUP BY 1),
        w(step, got, taken) AS (SELECT 0, []::STRUCT(rank BIGINT, link VARCHAR)[], []::VARCHAR[] UNION ALL SELECT step + 1, n, list_concat(taken, list_transform(n, lambda x: x.link)) FROM (SELECT step, taken, list_filter(f, lambda x, i: i <= {most} AND (i = 1 OR f[i - 1].rank < {fetches})) AS n FROM (SELECT step, taken, list_filter(l, lambda x: NOT list_contains(taken, x.link)) AS f FROM w JOIN l ON seed_order = step)))"""


ORACLE_SQL = {
    "url_counters": f"WITH {_EVENTS}, {_COUNTERS} SELECT k, count, delta, delta_date, crawls FROM uc",
    "decider_recrawl": f"WITH {_EVENTS}, {_COUNTERS} SELECT k, CASE WHEN delta % 2 > 0 THEN TIMESTAMP '{ASOF}' - delta_date > INTERVAL 26 HOUR ELSE TIMESTAMP '{ASOF}' - delta_date > INTERVAL 28 HOUR END AS again, delta_date IS NULL AS new FROM uc",
    "decider_children": f"{_CNT} SELECT doc_id, hits > 0 AND sentences / hits > 3 AS follow, hits / sentences > 0.2 AS share, hits > 0 AND sentences / hits > 3 AND new > 0 AS follow_new FROM (SELECT doc_id, sentences, hits, new FROM c)",
    "blacklist_decision": f"{_CNT} SELECT doc_id, doc_id % 3 <> 0 AND hits = 0 AS blacklist FROM c",
    "bootstrap_oldest": f"WITH {_VISITS} SELECT c_custkey, crawls FROM vi ORDER BY crawls, last NULLS FIRST, c_custkey LIMIT 50",
    "bootstrap_new": f"WITH {_VISITS} SELECT c_custkey FROM vi WHERE crawls = 0",
    "bootstrap_ext": f"WITH {_VISITS} SELECT c_custkey FROM vi WHERE crawls = 0 AND source <> 'auto'",
    "bootstrap_sample": "SELECT c_custkey FROM customer ORDER BY md5('0:' || c_custkey), c_custkey LIMIT 50",
    "frontier_rounds": """
        WITH RECURSIVE p AS (SELECT page_id AS src, count(*) OVER () AS n FROM pages), e AS (SELECT src, (src * 7 + 3) % n AS dst FROM p UNION SELECT src, (src * 13 + 5) % n FROM p),
        w(url, depth) AS (SELECT 0::BIGINT, 1 UNION SELECT dst, depth + 1 FROM w JOIN e ON src = url WHERE depth < 5),
        f AS (SELECT url, min(depth) AS depth FROM w GROUP BY url)
        SELECT f.url, (SELECT min(e.src) FROM e JOIN f g ON g.url = e.src WHERE e.dst = f.url AND g.depth = f.depth - 1) AS parent, CAST(f.depth AS BIGINT) AS depth FROM f""",
    "link_state": "SELECT page_id, CASE WHEN url IN (SELECT url FROM pages WHERE page_id % 5 = 0) THEN 2 WHEN url IN (SELECT url FROM pages WHERE page_id % 2 = 0) THEN 1 ELSE 0 END AS state FROM pages",
    "seeds_ngram": f"{_SENTENCES}, {_VALID}, {_NG} {_TOP} 20",
    "seeds_tfidf": f"""{_SENTENCES}, {_VALID}, {_NG.replace("lower(sentence)", _NO_NUMBERS)}, tf AS (SELECT doc_id, pos, ngram, count(*) AS tf FROM ng GROUP BY ALL), df AS (SELECT ngram, count(*) AS df FROM tf GROUP BY 1), t AS (SELECT count(*) AS total FROM val),
        w AS (SELECT tf.*, (1 + ln(tf)) * (ln((1 + total) / (1 + df)) + 1) AS w FROM tf JOIN df USING (ngram), t), nn AS (SELECT doc_id, pos, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL)
        SELECT ngram, round(sum(w / norm), 6) AS score FROM w JOIN nn USING (doc_id, pos) GROUP BY 1 ORDER BY score DESC, ngram DESC LIMIT 20""",
    "seeds_ranges": f"""{_SENTENCES}, {_VALID}, ws AS (SELECT list_filter({_TOK.format(t='sentence')}, lambda w: w NOT IN ('the', 'of', 'der', 'die')) AS w FROM val),
        ng AS (SELECT unnest(flatten([list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' ')) for n in [1, 2, 3]])) AS ngram FROM ws) {_TOP} 40""",
    "query_builders": f"""{_SENTENCES}, {_VALID}, {_NG} SELECT ngram, '"' || ngram || '"' AS whole, '"' || replace(ngram, ' ', '" "') || '"' AS words FROM ({_TOP} 20)""",
    "newest_sentences": f"{_SENTENCES}, {_VALID} SELECT doc_id, pos FROM val ORDER BY doc_id DESC, doc_id * 1000 + pos LIMIT 20",
    "seed_selection_new": f"SELECT id, source FROM {_SEEDS} WHERE num_searches = 0 ORDER BY source DESC, id LIMIT 9",
    "seed_selection_any": f"SELECT id, source FROM {_SEEDS} WHERE NOT deleted ORDER BY num_searches, source DESC, date_added, last_searched NULLS FIRST, id LIMIT 30",
    "search_order": f"WITH {_RES} SELECT query, rank, rank // 10 * 10 + count(*) OVER (PARTITION BY query, rank // 10) - 1 - rank % 10 AS fetched FROM r",
    "search_accept": f"{_accepted(5, 1 << 30)} SELECT 'q' || (step - 1) AS query, x.rank AS rank, x.link AS link FROM (SELECT step, unnest(got) AS x FROM w WHERE step > 0)",
    "search_fetches": f"{_accepted(50, 3)}, t AS (SELECT 'q' || (step - 1) AS query, unnest(got).link AS url FROM w WHERE step > 0) SELECT query, NULL::BIGINT AS count, url FROM t UNION ALL SELECT DISTINCT r.query, (SELECT count(*) FROM t WHERE t.query = r.query), NULL FROM r",
    "top_results": f"WITH {_RES} SELECT query, rank, link FROM r WHERE rank < 5",
    "similar_seeds": f"{_SENTENCES}, {_VALID}, {_NG} SELECT ngram FROM ({_TOP} 200) WHERE regexp_matches(ngram, '(?i)(The)|(of)')",
    "seed_report": """
        WITH per AS (SELECT o_custkey, count(*) AS crawls, count_if(o_orderkey % 2 = 0) AS sentences FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
        u AS (SELECT n_name AS seed, count(*) AS urls, count_if(crawls > 0) AS urls_sg, coalesce(sum(sentences), 0)::BIGINT AS sentences FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN per ON c_custkey = o_custkey GROUP BY 1),
        h AS (SELECT n_name AS seed, count(*) AS usages, 7 * count(*) AS count FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1),
        a AS (SELECT seed, usages, count, urls, urls_sg, sentences, urls - urls_sg AS not_visited, count - (urls - urls_sg) AS visited FROM h JOIN u USING (seed) WHERE urls >= 1 AND usages >= 1)
        SELECT *, visited - urls_sg AS blacklisted, round(CASE WHEN visited <> 0 THEN urls_sg / visited ELSE 0 END, 6) AS ratio, round(sentences / (1 + 10 * count), 6) AS s_ratio FROM a""",
    "lid_model": f"WITH {_MODEL} SELECT label, gram, round(weight, 6) AS weight FROM m",
}
