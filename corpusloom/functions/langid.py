"""Language identification by character n-grams: an additive model of bounded size that scores each text in place."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .normalize import let

#: Lengths of the n-grams, how many of them the model has, and from how many rows of each label it is fitted, at most.
LENGTHS, FEATURES, ROWS = (3, 4, 5), 6000, 100


def sanitize(text: Column) -> Column:
    """Lower case; only letters, spaces, periods and commas; single spaces."""
    text = F.regexp_replace(F.lower(text), r"[^\p{L} .,]", "")
    return F.btrim(F.replace(F.regexp_replace(text, " +", " "), F.lit(" ."), F.lit(".")), F.lit(" "))


def grams(text: Column, n: int = 3) -> Column:
    """All runs of n characters; empty for shorter texts."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def labelled(docs: DataFrame, label: str = "lang", key: str = "doc_id", rows: int = ROWS) -> DataFrame:
    """The rows that a model is fitted from: so many of each label, by the hash of their key."""
    first = F.row_number().over(Window.partitionBy(label).orderBy(F.md5(F.col(key).cast("string")), key))
    keys = docs.filter(F.col(label).isNotNull()).select(label, key).withColumn("__r", first).filter(F.col("__r") <= rows).select(key)
    return docs.filter(F.col(label).isNotNull()).join(F.broadcast(keys), key, "left_semi")  # as many as rows times labels


def fit(docs: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", features: int = FEATURES, lengths: tuple[int, ...] = LENGTHS, rows: int = ROWS) -> DataFrame:
    """(label, gram, weight): log probabilities with add-one smoothing over the most frequent n-grams of a bounded sample.

    The model has ``features`` rows a label, so it can be broadcast whatever the corpus.
    """
    clean = labelled(docs, label, key, rows).select(F.col(label).alias("label"), sanitize(F.col(text)).alias("t"))
    c = clean.select("label", F.explode(F.flatten(F.array(*[grams(F.col("t"), n) for n in lengths]))).alias("gram")).groupBy("label", "gram").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = c.groupBy("gram").agg(F.sum("n").alias("t")).orderBy(F.desc("t"), "gram").limit(features).select("gram")
    c = c.join(F.broadcast(vocabulary), "gram")
    labels = c.select("label").distinct()
    grid = F.broadcast(labels).join(vocabulary, F.lit(True))  # bounded by features x labels
    full = grid.join(c, ["label", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy("label")) + F.count(F.lit(1)).over(Window.partitionBy("label"))
    return full.select("label", "gram", F.log((F.col("n") + 1) / total).alias("weight"))


@dataclass
class Model:
    """A fitted model on the driver: labels in order, and a row of weights for each n-gram."""

    labels: list[str]
    number: dict[str, int]
    weights: np.ndarray

    def score(self, text: str) -> list[float]:
        """For each label the mean log probability of the known n-grams; zeros if there are none."""
        get, found = self.number.get, []
        for n in self._lengths:
            found += [k for i in range(len(text) - n + 1) if (k := get(text[i : i + n])) is not None]
        return (self.weights[found].mean(axis=0) if found else np.zeros(len(self.labels))).tolist()

    def __post_init__(self):
        self._lengths = sorted({len(g) for g in self.number})


def collected(model: DataFrame) -> Model:
    """The model's rows, bounded by its features and labels, on the driver."""
    rows = model.collect()
    labels, number = sorted({r.label for r in rows}), {}
    for r in rows:
        number.setdefault(r.gram, len(number))
    weights = np.zeros((len(number), len(labels)))
    for r in rows:
        weights[number[r.gram], labels.index(r.label)] = r.weight
    return Model(labels, number, weights)


def scores(text: Column, model: Model) -> Column:
    """A map from label to score. Texts are scored where they are, in Arrow batches: nothing is exploded or shuffled."""

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else model.score(t) for t in texts], dtype=object)

    return F.map_from_arrays(F.array(*[F.lit(x) for x in model.labels]), score(sanitize(text)))


def _shares(scored: Column) -> Column:
    """(score, label, e) of a map of scores, e in proportion to the label's probability by softmax."""
    top = F.array_max(F.map_values(scored))
    return F.transform(F.map_entries(scored), lambda x: F.struct(x["value"].alias("score"), x["key"].alias("label"), F.exp(x["value"] - top).alias("e")))


def _sum(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x["e"])


def predict(scored: Column) -> Column:
    """(label, proba) of the best label of a column of scores; of equal ones, the last by name."""
    return let(_shares(scored), lambda parts: F.struct(F.array_max(parts)["label"].alias("label"), (F.array_max(parts)["e"] / _sum(parts)).alias("proba")))


def proba(scored: Column, label: str) -> Column:
    """The probability of one label."""
    return let(_shares(scored), lambda parts: F.aggregate(parts, F.lit(0.0), lambda a, x: a + F.when(x["label"] == label, x["e"]).otherwise(0.0)) / _sum(parts))


def detector(model: Model, label: str, sentence: str = "sentence") -> Callable[[DataFrame], DataFrame]:
    """A crawl's detector: adds ``proba`` of the label to each sentence."""
    return lambda rows: rows.withColumn("__scores", scores(F.col(sentence), model)).withColumn("proba", proba(F.col("__scores"), label)).drop("__scores")


def always(rows: DataFrame) -> DataFrame:
    """The default detector: every sentence is of the target language."""
    return rows.withColumn("proba", F.lit(1.0))
