"""Hashes, query builders and display formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import let


def text_id(text: Column) -> Column:
    """A content address, the same in any engine."""
    return F.md5(text)


def password_hash(password: Column) -> Column:
    """As users are stored."""
    return F.md5(password)


def quoted(query: Column) -> Column:
    """The whole query in quotes."""
    return F.concat(F.lit('"'), F.btrim(query), F.lit('"'))


def quoted_words(query: Column) -> Column:
    """Each word in quotes."""
    return F.array_join(F.transform(F.filter(F.split(query, r"\s+"), lambda w: w != ""), lambda w: F.concat(F.lit('"'), w, F.lit('"'))), " ")


#: What isn't a word character, as the number removal sees it.
_NO_WORD = r"[^\p{L}\p{N}_]"


def without_numbers(text: Column) -> Column:
    """Numbers between other characters than those of words become a space, and so do the characters on either side.

    As those are used up, of numbers in a row each second one stays.
    """
    return F.regexp_replace(text, rf"(?:^|{_NO_WORD})\p{{Nd}}+(?:$|{_NO_WORD})", " ")


def words(text: Column) -> Column:
    """Lower-case tokens of two word characters or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def without_words(tokens: Column, stop_words: list[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(stop_words)) if stop_words else tokens


def ngrams(tokens: Column, n: int | tuple[int, int] = 3) -> Column:
    """The runs of n tokens, or of from n[0] to n[1] tokens."""
    if isinstance(n, tuple):
        return let(tokens, lambda ts: F.flatten(F.array(*[ngrams(ts, k) for k in range(n[0], n[1] + 1)])))
    runs = lambda ts: F.transform(F.sequence(F.lit(1), F.size(ts) - n + 1), lambda i: F.array_join(F.slice(ts, i, F.lit(n)), " "))
    return let(tokens, lambda ts: F.when(F.size(ts) >= n, runs(ts)).otherwise(F.array().cast("array<string>")))


def percent(value: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(value * 100, digits), F.lit("%"))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def hue(value: Column) -> Column:
    """A share as a hue from red (0) to green (120)."""
    return F.round(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)) * 120).cast("int")


_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def seconds(duration: str, default: int = 7 * 86400) -> int:
    """``7d`` or ``1h30m`` in seconds; what can't be read is a week."""
    parts = re.findall(r"(\d+)\s*([smhdw])", duration or "")
    return sum(int(n) * _UNITS[u] for n, u in parts) if parts and re.fullmatch(r"(\s*\d+\s*[smhdw])+\s*", duration) else default


def vote_of(labels: Column, user: Column | str) -> Column:
    """The label that a user gave, or null."""
    return F.get(F.filter(labels, lambda x: x["user"] == user), F.lit(0))["label"]
