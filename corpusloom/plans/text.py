"""Queries on texts and sentences, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import langid, normalize, rules, split
from corpusloom.functions import text as text_
from corpusloom.operators import crawl

from . import sql

#: Literal rows for what the documents never hold.
TORTURE = [
    "„Hoi“ seit’s «ja» ‹nei› ‘ok’ ‚x‘ `y´ ''z''",
    "a % b : 1,200 3,5 7 000 « mot » fin",
    "em—dash en–dash minus−sign non‑breaking",
    "café è ñ ü so­ft zero‍width x️",
    "œuvre æther ﬁn ﬀ ﬂ ĳs ��end",
    "  spaces  here \n\n  next\t line  \n",
    "( trim ) ☺ smile \U0001f600 face .dot , comma ,next",
    'Er sagte "gut." Dann ,"nein". x : y ; z',
    "Dr. Who met i.e. someone. No. 14 is here. No. xx too... And then! ok? yes (sure.) Fine.",
    'He said "Go!" Then left. U.S.A. Next one ... maybe. "Quoted." Next: more; and 1:1 http://x',
]


def torture(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(-1 - k, t) for k, t in enumerate(TORTURE)], "doc_id long, text string")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return crawl.spread(spark.read.parquet(f"{d}/documents.parquet"))


def _both(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", "text").unionByName(torture(spark))


_BOTH = "(SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES " + ", ".join(f"({-1 - k}, {sql.lit(t)})" for k, t in enumerate(TORTURE)) + ") v(doc_id, text))"
_SENT = f"WITH n AS (SELECT doc_id, {sql.normalized('text')} AS t FROM @SOURCE@), " + sql.split_cte("n")
_SENTENCES = _SENT.replace("@SOURCE@", "documents")


def sentences(spark: SparkSession, d: str) -> DataFrame:
    return crawl.sentences(_docs(spark, d))


def valid(spark: SparkSession, d: str) -> DataFrame:
    return crawl.valid_sentences(sentences(spark, d))


def normalize_text(spark, d):
    rows = _both(spark, d).select("doc_id", normalize.normalize(F.col("text"), emojis=False).alias("t"))
    return rows.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n_chars"))


def strip_emojis(spark, d):
    return _both(spark, d).select("doc_id", F.md5(normalize.strip_emojis(F.col("text"))).alias("text_md5"))


def repair_encoding(spark, d):
    """Every second document read in the wrong encoding, and repaired line by line."""
    wrong = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    rows = _docs(spark, d).select("doc_id", F.when(F.col("doc_id") % 2 == 0, wrong).otherwise(F.col("text")).alias("text"))
    return rows.select("doc_id", F.md5(normalize.fix_encoding(F.col("text"))).alias("text_md5"))


def split_lines(spark, d):
    return _docs(spark, d).select("doc_id", F.size(split.split_lines(F.col("text"))).cast("long").alias("n_lines"))


def split_paragraphs(spark, d):
    return _docs(spark, d).select("doc_id", F.size(split.paragraphs(F.col("text"))).cast("long").alias("n_lines"), F.size(split.paragraphs(F.col("text"), False)).cast("long").alias("n_blocks"))


def split_sentences(spark, d):
    return crawl.sentences(_both(spark, d))


def split_sentences_strict(spark, d):
    text = normalize.normalize(F.col("text"), emojis=False)
    rows = _both(spark, d).select("doc_id", text.alias("t"))
    return rows.select("doc_id", F.posexplode(F.array_distinct(split.split(F.col("t"), True, True, strict=True))).alias("pos", "sentence")).filter("sentence != ''")


def _rule_query(name):
    rule = next(r for r in rules.DEFAULT if r.name == name)

    def query(spark, d):
        return sentences(spark, d).groupBy(rules.holds(rule, F.col("sentence")).alias("passes")).agg(F.count(F.lit(1)).alias("n"))

    return query, f"{_SENTENCES} SELECT {sql.holds(rule, 'sentence')} AS passes, count(*) AS n FROM sent WHERE sentence <> '' GROUP BY 1"


def sentence_filter_default(spark, d):
    return valid(spark, d).select("doc_id", "pos")


def sentence_filter_strict(spark, d):
    return crawl.valid_sentences(sentences(spark, d), rules.STRICT).select("doc_id", "pos")


def rule_failure_histogram(spark, d):
    return sentences(spark, d).groupBy(F.coalesce(rules.first_failing(F.col("sentence"), rules.DEFAULT), F.lit("none")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def rule_failure_histogram_strict(spark, d):
    return sentences(spark, d).groupBy(F.coalesce(rules.first_failing(F.col("sentence"), rules.STRICT), F.lit("none")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def rule_examples(spark, d):
    by = {r.name: r for r in rules.DEFAULT}
    rows = rules.examples(rules.DEFAULT)
    frame = spark.createDataFrame(rows, "rule string, text string, must_fail boolean")
    passes = F.coalesce(*[F.when(F.col("rule") == n, rules.holds(by[n], F.col("text"))) for n in {r for r, _, _ in rows}])
    return frame.withColumn("as_said", passes != F.col("must_fail"))


def uniq_in_page(spark, d):
    return sentences(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def first_seen_sentences(spark, d):
    return crawl.first_seen(valid(spark, d), ["doc_id", "pos"]).select("doc_id", "pos", F.md5("sentence").alias("id"))


def sentence_novelty(spark, d):
    store = spark.read.parquet(f"{d}/benchmark.parquet")
    return crawl.unseen(first_seen(spark, d), store).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_new"))


def first_seen(spark, d):
    return crawl.first_seen(valid(spark, d), ["doc_id", "pos"])


def text_dedup_urls(spark, d):
    rows = crawl.text_store(_docs(spark, d).withColumn("date", F.col("doc_id")), "text", "source", "date")
    return rows.select("id", F.array_join("urls", ",").alias("urls"), "date_added")


def hash_ids(spark, d):
    return _docs(spark, d).select("doc_id", text_.text_id(F.col("text")).alias("id"))


def lid_sanitize(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(langid.sanitize(F.col("text"))).alias("text_md5"))


def _model(spark, d):
    return langid.collected(langid.fit(_docs(spark, d)))


def lid_scores(spark, d):
    rows = _docs(spark, d).select("doc_id", F.explode(langid.scores(F.col("text"), _model(spark, d))).alias("label", "score"))
    return rows.select("doc_id", "label", F.round("score", 6).alias("score"))


def lid_predict_lang(spark, d):
    rows = _docs(spark, d).select("doc_id", langid.scores(F.col("text"), _model(spark, d)).alias("scores"))
    return rows.select("doc_id", langid.predict(F.col("scores")).alias("p")).select("doc_id", "p.label", F.round("p.proba", 6).alias("proba"))


def scored(spark, d):
    """Valid sentences, each with its own probability of the stand-in target language."""
    return langid.detector(_model(spark, d), "de")(valid(spark, d))


def proba_threshold(spark, d):
    """Sentences that reach the least probability."""
    return scored(spark, d).filter(F.col("proba") >= MIN_PROBA).select("doc_id", "pos", F.round("proba", 6).alias("proba"))


def page_counts(spark, d):
    opt = crawl.Options(min_proba=MIN_PROBA)
    return crawl.page_counts(scored(spark, d).withColumn("new", F.col("pos") % 2 == 0), "doc_id", opt=opt)


def st1_crawl_sentences(spark, d):
    """New sentences of the target language for each source: the whole path from text to novelty."""
    rows = scored(spark, d).filter(F.col("proba") >= MIN_PROBA).drop("proba")
    fresh = crawl.first_seen(rows, ["doc_id", "pos"])
    return fresh.join(_docs(spark, d).select("doc_id", "source"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n_sentences"), F.countDistinct("doc_id").alias("n_docs"))


MIN_PROBA = 0.4
_CLEAN = "trim(replace(regexp_replace(regexp_replace(lower({t}), '[^\\p{{L}} .,]', '', 'g'), ' +', ' ', 'g'), ' .', '.'), ' ')"
_ALL_GRAMS = "unnest(flatten([list_transform(range(1, length(t) - n + 2), lambda i: t[i:i + n - 1]) for n in [3, 4, 5]]))"
_MODEL = f"""s AS (SELECT doc_id, lang, {_CLEAN.format(t="text")} AS t FROM documents),
    lab AS (SELECT * FROM s WHERE lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) <= {langid.ROWS}),
    lc AS (SELECT lang, gram, count(*) AS n FROM (SELECT lang, {_ALL_GRAMS} AS gram FROM lab) GROUP BY ALL),
    v AS (SELECT gram FROM lc GROUP BY gram ORDER BY sum(n) DESC, gram LIMIT 6000),
    m AS (SELECT l.lang AS label, v.gram, ln((coalesce(n, 0) + 1) / (sum(coalesce(n, 0)) OVER (PARTITION BY l.lang) + count(*) OVER (PARTITION BY l.lang))) AS weight
        FROM (SELECT DISTINCT lang FROM lc) l CROSS JOIN v LEFT JOIN lc ON lc.lang = l.lang AND lc.gram = v.gram)"""


def _scores_of(source: str, key: str) -> str:
    """CTEs from ``source`` (key, t: clean text) to sc (key, label, score) and e with the softmax's terms."""
    return f"""gr AS (SELECT {key}, gram, count(*) AS n FROM (SELECT {key}, {_ALL_GRAMS} AS gram FROM {source}) GROUP BY ALL),
    ks AS (SELECT {key}, label, sum(n * weight) / sum(n) AS score FROM gr JOIN m USING (gram) GROUP BY ALL),
    sc AS (SELECT {key}, l.label, coalesce(ks.score, 0) AS score FROM (SELECT {key} FROM {source}) CROSS JOIN (SELECT DISTINCT label FROM m) l LEFT JOIN ks USING ({key}, label)),
    e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY {key})) AS e FROM sc)"""


_GRAMS = f"{_MODEL}, {_scores_of('s', 'doc_id')}"
_VALID = f"val AS (SELECT * FROM sent WHERE sentence <> '' AND {sql.valid('sentence', rules.DEFAULT)})"
_FIRST = "fs AS (SELECT * FROM val QUALIFY row_number() OVER (PARTITION BY sentence ORDER BY doc_id, pos) = 1)"
_SCORED = f"""{_SENTENCES}, {_VALID}, {_MODEL}, st AS (SELECT doc_id, pos, {_CLEAN.format(t="sentence")} AS t FROM val), {_scores_of("st", "doc_id, pos")},
    pl AS (SELECT doc_id, pos, sum(CASE WHEN label = 'de' THEN e ELSE 0 END) / sum(e) AS proba FROM e GROUP BY ALL), scored AS (SELECT val.*, proba FROM val JOIN pl USING (doc_id, pos))"""

QUERIES = {f.__name__: f for f in (normalize_text, strip_emojis, repair_encoding, split_lines, split_paragraphs, split_sentences, split_sentences_strict, sentence_filter_default, sentence_filter_strict, rule_failure_histogram, rule_failure_histogram_strict, rule_examples, uniq_in_page, first_seen_sentences, sentence_novelty, text_dedup_urls, hash_ids, lid_sanitize, lid_scores, lid_predict_lang, proba_threshold, page_counts, st1_crawl_sentences)}
ORACLE_SQL = {
    "normalize_text": f"SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars FROM (SELECT doc_id, {sql.normalized('text')} AS t FROM {_BOTH})",
    "strip_emojis": f"SELECT doc_id, md5({sql.sub('text', normalize.EMOJI, ' ')}) AS text_md5 FROM {_BOTH}",
    "repair_encoding": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "split_lines": "SELECT doc_id, len(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS n_lines FROM documents",
    "split_paragraphs": "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda p: trim(p, ' ' || chr(9) || chr(13)) <> '')) AS n_lines, len(list_filter(string_split_regex(text, '\\n(?:[ \\t\\r\\f]*\\n)+'), lambda p: trim(p, ' ' || chr(9) || chr(10) || chr(13)) <> '')) AS n_blocks FROM documents",
    "split_sentences": _SENT.replace("@SOURCE@", _BOTH) + " SELECT * FROM sent WHERE sentence <> ''",
    "split_sentences_strict": f"WITH n AS (SELECT doc_id, {sql.normalized('text')} AS t FROM {_BOTH}), " + sql.split_cte("n", strict=True) + " SELECT * FROM sent WHERE sentence <> ''",
    "sentence_filter_default": f"{_SENTENCES}, {_VALID} SELECT doc_id, pos FROM val",
    "sentence_filter_strict": f"{_SENTENCES} SELECT doc_id, pos FROM sent WHERE sentence <> '' AND {sql.valid('sentence', rules.STRICT)}",
    "rule_failure_histogram": f"{_SENTENCES} SELECT coalesce({sql.first_failing('sentence', rules.DEFAULT)}, 'none') AS rule, count(*) AS n FROM sent WHERE sentence <> '' GROUP BY 1",
    "rule_failure_histogram_strict": f"{_SENTENCES} SELECT coalesce({sql.first_failing('sentence', rules.STRICT)}, 'none') AS rule, count(*) AS n FROM sent WHERE sentence <> '' GROUP BY 1",
    "rule_examples": "SELECT *, true AS as_said FROM (VALUES " + ", ".join(f"({sql.lit(r)}, {sql.lit(t)}, {str(m).lower()})" for r, t, m in rules.examples(rules.DEFAULT)) + ") v(rule, text, must_fail)",
    "uniq_in_page": f"{_SENTENCES} SELECT doc_id, count(*) AS n FROM sent WHERE sentence <> '' GROUP BY 1",
    "first_seen_sentences": f"{_SENTENCES}, {_VALID}, {_FIRST} SELECT doc_id, pos, md5(sentence) AS id FROM fs",
    "sentence_novelty": f"{_SENTENCES}, {_VALID}, {_FIRST} SELECT doc_id, count(*) AS n_new FROM fs WHERE sentence NOT IN (SELECT text FROM benchmark) GROUP BY 1",
    "text_dedup_urls": "SELECT md5(text) AS id, array_to_string(list_sort(list_distinct(list(source))), ',') AS urls, min(doc_id) AS date_added FROM documents GROUP BY md5(text)",
    "hash_ids": "SELECT doc_id, md5(text) AS id FROM documents",
    "lid_sanitize": f"SELECT doc_id, md5({_CLEAN.format(t='text')}) AS text_md5 FROM documents",
    "lid_scores": f"WITH {_GRAMS} SELECT doc_id, label, round(score, 6) AS score FROM sc",
    "lid_predict_lang": f"WITH {_GRAMS} SELECT doc_id, arg_max(label, struct_pack(a := score, b := label)) AS label, round(max(e) / sum(e), 6) AS proba FROM e GROUP BY doc_id",
    "proba_threshold": f"{_SCORED} SELECT doc_id, pos, round(proba, 6) AS proba FROM scored WHERE proba >= 0.4",
    "page_counts": f"{_SCORED} SELECT doc_id, count(*) AS sentence_count, count_if(proba >= 0.4) AS sg_count, count_if(proba >= 0.4 AND pos % 2 = 0) AS new_count FROM scored GROUP BY 1",
    "st1_crawl_sentences": f"{_SCORED}, f AS (SELECT * FROM scored WHERE proba >= 0.4 QUALIFY row_number() OVER (PARTITION BY sentence ORDER BY doc_id, pos) = 1) SELECT source, count(*) AS n_sentences, count(DISTINCT doc_id) AS n_docs FROM f JOIN documents USING (doc_id) GROUP BY 1",
}
for _kind, _rule in {"rule_length": "max_length", "rule_find_count": "min_words", "rule_find_ratio": "letter_density", "rule_compare": "too_many_commas", "rule_if_guard": "ellipsis"}.items():
    QUERIES[_kind], ORACLE_SQL[_kind] = _rule_query(_rule)
