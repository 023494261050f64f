"""Unsupervised sentence splitting: abbreviations are learned from how often a word has a period after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import let
from .split import paragraphs

#: The least score of an abbreviation, and how sure one is to have its period.
LEAST, SURE = 0.3, 0.99
#: A word with its inner periods, and what may stand around it.
WORD = r"^[^\p{L}\p{N}]*([\p{L}\p{N}][\p{L}\p{N}.\-]*)[^\p{L}\p{N}.]*$"


def fit(docs: DataFrame, text: str = "text") -> DataFrame:
    """(prefix, score) of the words that mostly stand before a period, by log likelihood, short ones with inner periods first.

    Counts are one partial aggregate over all words; what is kept is the table of abbreviations.
    """
    words = docs.select(F.explode(F.split(F.col(text), r"[\s\x{A0}]+")).alias("w")).select(F.lower(F.regexp_extract("w", WORD, 1)).alias("w")).filter("w != ''")
    words = words.select(F.rtrim(F.col("w"), F.lit(".")).alias("prefix"), F.endswith("w", F.lit(".")).alias("period"))
    counts = words.groupBy("prefix").agg(F.count_if("period").alias("with"), F.count_if(~F.col("period")).alias("without"))
    total = counts.agg(F.sum("with").alias("periods"), F.sum(F.col("with") + F.col("without")).alias("all"))
    c = counts.filter((F.col("with") > 0) & F.col("prefix").rlike(r"\p{L}")).join(F.broadcast(total), F.lit(True))  # one row of two numbers
    chance = F.col("periods") / F.col("all")
    null = F.col("with") * F.log(chance) + F.col("without") * F.log(1 - chance)
    alike = F.col("with") * F.log(F.lit(SURE)) + F.col("without") * F.log(1 - F.lit(SURE))
    periods = F.length("prefix") - F.length(F.replace("prefix", F.lit("."))) + 1
    letters = F.length("prefix") - periods + 1
    score = -2 * (null - alike) * F.exp(-letters) * periods * F.pow(letters, -F.col("without"))
    return c.filter("periods < all").select("prefix", score.alias("score")).filter(F.col("score") >= LEAST)


def collected(table: DataFrame, most: int = 10_000) -> list[str]:
    """The best abbreviations on the driver, no more than ``most``."""
    return [r.prefix for r in table.orderBy(F.desc("score"), "prefix").limit(most).collect()]


def split_learned(text: Column, abbreviations: list[str] = ()) -> Column:
    """Each line to sentences: they end with ``.``, ``?`` or ``!`` before a space, but after abbreviations and initials, and at dots before lower case."""

    def word(w: Column, after: Column) -> Column:
        ends = w.rlike(r"[.?!][\"')\]}]*$") & after.isNotNull() & ~w.rlike(r"^\p{L}\.$") & ~(w.rlike(r"\.\.+$") & after.rlike(r"^\p{Ll}"))
        if abbreviations:
            ends &= ~(F.endswith(w, F.lit(".")) & F.lower(F.rtrim(F.regexp_extract(w, WORD, 1), F.lit("."))).isin(list(abbreviations)))
        return F.when(ends, F.concat(w, F.lit("\n"))).otherwise(F.when(after.isNotNull(), F.concat(w, F.lit(" "))).otherwise(w))

    def line(p: Column) -> Column:
        words = F.filter(F.split(p, r"[ \t\r]+"), lambda w: w != "")
        return F.split(let(words, lambda ws: F.array_join(F.transform(ws, lambda w, i: word(w, F.get(ws, i + 1))), "")), "\n")

    return F.flatten(F.transform(paragraphs(text), line))
