"""One query for each operator, over its whole table with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, mixing, pieces, pii, quality, secrets, simhash_dedup, suffix_dedup, urls, warc
from .common import remove, saved, scratch, spread, table

#: Fixed values of the URL filter.
RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.decide(table(spark, sf_dir, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.select(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", F.col("__leaf.domain").alias("domain"), F.col("__leaf.lang").alias("lang"), F.col("__leaf.source").alias("source"), F.col("__epoch").alias("epoch"), F.col("__tokens").alias("tokens"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.classes(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("spans")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    out = saved(warc.digest(spark, path))
    remove(spark, path)
    return out


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_exact_dedup, op2_mixing, op3_url_filter, op4_quality_rules, op5_simhash, op6_sentencepiece, op7_secret_scan, op8_suffix_dedup, op9_warc, op10_pii)
}

_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in quality.STOP_WORDS.values() for w in ws}))

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, length(coalesce(text, '')) AS c FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t ORDER BY c DESC, doc_id)""",
    "op2_mixing": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
            CASE WHEN source IS NULL THEN '(none)' WHEN regexp_matches(source, '^[^0-9]*[0-9]$') THEN 'core' ELSE 'tail' END AS domain,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents),
        l AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, 2 * sum(tokens)::BIGINT AS cap FROM d GROUP BY ALL),
        tot AS (SELECT sum(tokens)::HUGEINT * 80 // 100 AS budget FROM l),
        ta AS (SELECT domain, sum(cap)::BIGINT AS cap, any_value(budget) AS budget FROM l, tot GROUP BY domain),
        t0 AS (SELECT *, CASE WHEN w > 0 THEN cap ELSE 0 END AS c FROM (SELECT *, CASE domain WHEN 'core' THEN 3 WHEN 'tail' THEN 2 ELSE 1 END AS w FROM ta)),
        t1 AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY 1 ORDER BY c::DOUBLE / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS cb,
            sum(w) OVER (PARTITION BY 1 ORDER BY c::DOUBLE / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS wf FROM t0),
        t2 AS (SELECT *, c = 0 OR c::HUGEINT * wf <= (budget - cb) * w AS is_full FROM t1),
        t AS (SELECT *, CASE WHEN is_full THEN c ELSE ((budget - sum(CASE WHEN is_full THEN c ELSE 0 END) OVER (PARTITION BY 1)) * w)::HUGEINT
            // (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (PARTITION BY 1))::HUGEINT END AS own FROM t2),
        ma AS (SELECT l.domain, lang, sum(l.cap)::BIGINT AS cap, any_value(own) AS budget FROM l JOIN t USING (domain) GROUP BY ALL),
        m0 AS (SELECT *, CASE WHEN w > 0 THEN cap ELSE 0 END AS c FROM (SELECT *, CASE lang WHEN 'en' THEN 4 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS w FROM ma)),
        m1 AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY domain ORDER BY c::DOUBLE / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS cb,
            sum(w) OVER (PARTITION BY domain ORDER BY c::DOUBLE / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS wf FROM m0),
        m2 AS (SELECT *, c = 0 OR c::HUGEINT * wf <= (budget - cb) * w AS is_full FROM m1),
        m AS (SELECT *, CASE WHEN is_full THEN c ELSE ((budget - sum(CASE WHEN is_full THEN c ELSE 0 END) OVER (PARTITION BY domain)) * w)::HUGEINT
            // (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (PARTITION BY domain))::HUGEINT END AS own FROM m2),
        sa AS (SELECT l.*, own AS budget FROM l JOIN m USING (domain, lang)),
        s0 AS (SELECT *, CASE WHEN w > 0 THEN cap ELSE 0 END AS c FROM (SELECT *, 1 AS w FROM sa)),
        s1 AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY domain, lang ORDER BY c::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS cb,
            sum(w) OVER (PARTITION BY domain, lang ORDER BY c::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS wf FROM s0),
        s2 AS (SELECT *, c = 0 OR c::HUGEINT * wf <= (budget - cb) * w AS is_full FROM s1),
        s AS (SELECT *, CASE WHEN is_full THEN c ELSE ((budget - sum(CASE WHEN is_full THEN c ELSE 0 END) OVER (PARTITION BY domain, lang)) * w)::HUGEINT
            // (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (PARTITION BY domain, lang))::HUGEINT END AS own FROM s2),
        cut AS (SELECT domain, lang, source, (own // tokens)::BIGINT AS whole, (own % tokens)::BIGINT AS rest FROM s WHERE tokens > 0),
        o AS (SELECT d.*, whole, rest, md5('17:' || whole || ':' || coalesce(doc_id::VARCHAR, '')) AS h FROM d JOIN cut USING (domain, lang, source)),
        p AS (SELECT *, whole + CASE WHEN rest > 0 AND sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h) <= rest THEN 1 ELSE 0 END AS times FROM o)
        SELECT doc_id, domain, lang, source, unnest(range(times))::INTEGER AS epoch, tokens FROM p""",
    "op3_url_filter": r"""
        WITH u AS (SELECT page_id, coalesce(url, '') AS url, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']), {'host': '', 'path': ''}) AS p FROM pages),
        h AS (SELECT page_id, translate(p.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, p.path AS path FROM u),
        r AS (SELECT *, CASE
            WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
            WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
            WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/'
            WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
            WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/' END AS rule FROM h)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r""",
    "op4_quality_rules": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
        g AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
        rep AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
        cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY r),
        m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
                coalesce(n, 0) AS n_repeat_words, len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop, coalesce(list_max(list_transform(ws, lambda x: length(x))), 0) AS longest
              FROM w LEFT JOIN cov USING (r)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND word_chars / n_words >= 2 AND word_chars / n_words <= 14 AND longest <= 1000 AND n_symbols / n_words <= 0.1 AND n_stop / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.5 AS kept
        FROM b""",
    "op9_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
        m AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 100 AND page_id > f THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 100 AND page_id > f THEN f END AS refers_to FROM m""",
}
