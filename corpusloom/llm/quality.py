"""Quality rules: a threshold table compiled into one Spark projection.

Measures are columns over whole texts; each row of THRESHOLDS becomes one comparison, and ``kept`` is their
conjunction. No Python runs on executors and nothing is shuffled, so cost is linear in the input whatever the skew.

Defined cases: a null or empty text has no words and fails the base rule; rows with a null or repeated id are judged
one by one, each on its own text; other columns of the input, whatever their names, pass through or are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, boxed, whole, words_of

SYMBOLS = "#*$%&|<>"

#: Frequent function words of the languages that the corpus has, in lower case.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "at", "this", "are", "from", "an"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "du", "que", "est", "pour", "dans", "sur", "en", "au", "avec", "pas", "ce", "il"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo", "es"],
}

#: (rule, numerator, denominator or None, least, most). A ratio with denominator zero counts as zero.
THRESHOLDS = [
    ("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    ("longest_word", "longest_word", None, None, 1000.0),
    ("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    ("stop_words", "n_stop_words", "n_words", 0.02, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
]


#: Windows are sorted as one long each: 44 bits of hash above 20 bits of position.
POSITION_BITS = 20
POSITIONS = (1 << POSITION_BITS) - 1


def _gram(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i + k).alias(f"w{k}") for k in range(3)]


def _packed(words: Column) -> Column:
    """One sorted long for each 3-word window, so that windows of equal hash become neighbours."""
    heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.sort_array(F.transform(heads, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.lit(~POSITIONS)).bitwiseOR(i.cast("long"))))


def _alike(packed: Column) -> Column:
    """Of ``_packed``, those that have the hash of a neighbour."""
    hash_of = lambda x: x.bitwiseAND(F.lit(~POSITIONS))
    return F.filter(packed, lambda x, j: hash_of(x).eqNullSafe(hash_of(F.get(packed, j + 1))) | hash_of(x).eqNullSafe(hash_of(F.get(packed, j - 1))))


def _covered(starts: Column) -> Column:
    """Positions that 3-word windows at the sorted ``starts`` cover."""
    total = F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at")), lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["at"])).alias("n"), x.alias("at")))
    return total["n"]


def _repeat_words(words: Column, alike: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text, each counted once: O(n log n), exact.

    Neighbours of equal hash but other words, and texts with more windows than positions fit, take the second branch,
    which sorts the windows themselves.
    """
    place = lambda x: x.bitwiseAND(F.lit(POSITIONS)).cast("int")
    grams = lambda x: F.struct(*_gram(words, place(x)))
    clash = F.exists(F.transform(alike, lambda x, j: F.struct(x.alias("x"), F.get(alike, j - 1).alias("y"))), lambda p: p["y"].isNotNull() & (F.shiftright(p["x"], POSITION_BITS) == F.shiftright(p["y"], POSITION_BITS)) & (grams(p["x"]) != grams(p["y"])))
    whole_windows = F.sort_array(F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda x, i: F.struct(*_gram(words, i), i.alias("i"))))
    equal = lambda x, y: (x["w0"] == y["w0"]) & (x["w1"] == y["w1"]) & (x["w2"] == y["w2"])
    exact = F.transform(F.filter(whole_windows, lambda x, j: F.coalesce(equal(x, F.get(whole_windows, j + 1)), F.lit(False)) | F.coalesce(equal(x, F.get(whole_windows, j - 1)), F.lit(False))), lambda x: x["i"])
    return F.when((F.size(words) > POSITIONS) | clash, _covered(F.sort_array(exact))).when(F.size(alike) == 0, F.lit(0)).otherwise(_covered(F.sort_array(F.transform(alike, place))))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add every measure of the threshold table to ``docs``.

    The row number is a barrier: Spark pushes no predicate through it, which would otherwise unfold a filter on a
    measure into the words of words and evaluate them anew for each word.
    """
    t = F.col("__t")
    words, lines = F.col("__w"), F.col("__l")
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})
    return (
        docs.withColumn("__t", whole(docs[text]))
        .withColumns({"__w": words_of(t), "__l": F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WS)) != "")})
        .withColumns({"__s": _packed(words)})
        .withColumns({"__a": _alike(F.col("__s")), "__row": F.monotonically_increasing_id()})
        .withColumns(
            {
                "n_words": F.when(F.col("__row") >= 0, F.size(words)).cast("long"),
                "word_chars": F.length(F.translate(t, WS, "")).cast("long"),
                "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
                "n_lines": F.size(lines).cast("long"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
                "n_repeat_words": F.when(F.col("__row") >= 0, _repeat_words(words, F.col("__a"))).cast("long"),
                "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long"),
                "longest_word": F.coalesce(F.array_max(F.transform(words, lambda w: F.length(w))), F.lit(0)).cast("long"),
            }
        )
        .drop("__t", "__w", "__l", "__s", "__a", "__row")
    )


def verdict(thresholds: list[tuple] = THRESHOLDS) -> Column:
    """The table's conjunction."""
    out = F.lit(True)
    for _, num, den, least, most in thresholds:
        value = F.col(num).cast("double") if den is None else F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(0.0)
        if least is not None:
            out &= value >= least
        if most is not None:
            out &= value <= most
    return out


def judge(docs: DataFrame, text: str = "text", thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """``docs`` with its measures, ``base_failed`` and ``kept``."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measure(docs, text).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(thresholds))


def keep(docs: DataFrame, text: str = "text", thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` that pass, columns as they were."""
    return judge(docs.select(boxed(docs).alias("__doc"), F.col(f"`{text}`").alias("__text")), "__text", thresholds).filter("kept").select("__doc.*")
