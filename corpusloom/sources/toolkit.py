"""Stages of a crawl by name: each function takes a stage's options and gives the stage."""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import extract, langid, normalize, punkt, rules, split, urls
from corpusloom.operators import crawl, seeds

from . import files, tables


def paragraph_crawler(keep_bad: bool = True, stoplist: str | None = None, **columns):
    words = files.word_list(stoplist) if stoplist else []
    return partial(extract.crawl, text=partial(extract.paragraph_text, keep_bad=keep_bad, stop_words=words), **columns)


def plain_crawler(**columns):
    return partial(extract.crawl, text=extract.plain_text, **columns)


def clever_crawler(**columns):
    return partial(extract.crawl, text=extract.clever_text, **columns)


def normalizer(fix_encoding: bool = False, strip_emojis: bool = True):
    return partial(normalize.normalize, repair=fix_encoding, emojis=not strip_emojis)


def _prefixes(prefix_file: str | None) -> dict[str, bool] | None:
    return split.read_prefixes(files.lines(prefix_file)) if prefix_file else None


def splitter(langs: list[str] = split.LANGS, prefix_file: str | None = None, more: bool = True, keep_newlines: bool = True):
    return partial(split.split, more=more, keep_newlines=keep_newlines, langs=langs, own=_prefixes(prefix_file))


def strict_splitter(lang: str = "de", prefix_file: str | None = None, more: bool = True, **_):
    return partial(split.split_marked, more=more, lang=lang, own=_prefixes(prefix_file))


def learned_splitter(abbreviations: str | None = None):
    """By learned abbreviations, a table (prefix, score) stored as Parquet; by none without it."""
    table = punkt.collected(SparkSession.active().read.parquet(abbreviations)) if abbreviations else []
    return partial(punkt.split_learned, abbreviations=table)


def builtin_splitter(lang: str = "en"):
    return partial(split.split_builtin, lang=lang)


def rule_filter(rules_path: str | None = None, strict: bool = False):
    profile = files.rules(rules_path) if rules_path else rules.STRICT if strict else rules.DEFAULT
    return partial(rules.valid, rules=profile)


def model_detector(model: str, label: str):
    """A model (label, gram, weight) stored as Parquet."""
    return langid.detector(langid.collected(SparkSession.active().read.parquet(model)), label)


def _range(n) -> tuple[int, int]:
    return tuple(n) if isinstance(n, list | tuple) else (n, n)


def frequent_seeds(ngram_range=(3, 3), max: int = 10, stopwords: list[str] = ()):
    return lambda rows: seeds.top_ngrams(rows, n=_range(ngram_range), most=max, stop_words=stopwords)


def weighted_seeds(ngram_range=(3, 3), max: int = 10, stopwords: list[str] = (), sanitize: bool = True):
    return lambda rows: seeds.tfidf_ngrams(rows, ["url", "pos"], n=_range(ngram_range), most=max, stop_words=stopwords, sanitize=sanitize)


def link_fixes():
    return urls.fix


def pattern_filter(drop: list[str], rewrites: list[tuple[str, str]] = ()):
    return lambda url, href: urls.custom_filter(url, drop, rewrites)


decider, new_pages_decider, new_sentence_decider = crawl.BasicDecider, crawl.NewPagesDecider, crawl.NewSentenceDecider


def table_saver(root: str, date: str):
    return lambda done: tables.save_round(done, root, F.lit(date).cast("timestamp"))


def console_saver(rows: int = 20):
    """Shows what a round found."""

    def show(done: crawl.Round) -> None:
        done.new_sentences.select("url", "sentence", "proba").show(rows, False)
        done.blacklist.show(rows, False)

    return show


def sentence_saver(path: str):
    """Appends new sentences to text files."""

    def save(done: crawl.Round) -> None:
        done.new_sentences.select(F.col("sentence").alias("value")).write.mode("append").text(path)

    return save
