"""Text normalisation as one column expression: an ordered table of rewrites, with Unicode NFC where a text needs it."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: All Unicode white space, spelled out because engines differ on \s.
SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_WIDE = r"\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
#: Runs of blanks but single spaces, which may stay.
BLANKS = rf"[{_WIDE}][{_WIDE} ]*| [{_WIDE} ]+"
WORD = r"[\p{L}\p{N}_]"
EMOJI = r"[\x{2300}-\x{23FF}\x{2B50}-\x{2B55}\x{2600}-\x{2800}\x{10000}-\x{10FFFF}]"

#: The rewrites in their order, as (is a pattern, what, by what). \1 stands for a group.
REWRITES: list[tuple[bool, str, str]] = [
    (True, r"[\x00-\x09\x0B-\x1F\x7F-\x{9F}\x{200D}]", " "),
    (False, "\u00ad", ""),
    (True, r"[\x{300}-\x{36F}\x{FE00}-\x{FE0F}]", ""),
    (True, r"\x{FFFD}+", ""),
    (False, "`", "'"),
    (False, "„", '"'),
    (False, "“", '"'),
    (False, "”", '"'),
    (False, "—", " - "),
    (True, r"[\x{AF}\x{2010}-\x{2015}\x{2212}\x{FE58}\x{FE63}\x{FF0D}\x{1806}]", "-"),
    (False, "´", "'"),
    (True, r"(\p{L})[‘’](\p{L})", r"\1'\2"),
    (True, "[‘’‛‚]|''", '"'),
    (False, "…", "..."),
    (False, "\u00a0«\u00a0", ' "'),
    (False, "«\u00a0", '"'),
    (False, "«", '"'),
    (False, "\u00a0»\u00a0", '" '),
    (False, "\u00a0»", '"'),
    (False, "»", '"'),
    (False, "‹", "<"),
    (False, "›", ">"),
    (False, "œ", "oe"),
    (False, "æ", "ae"),
    (False, "ﬁ", "fi"),
    (False, "ﬀ", "ff"),
    (False, "ﬂ", "fl"),
    (False, "ĳ", "ij"),
    (True, r"\x{A0}([%:?!;])", r"\1"),
    (True, r"(\p{Nd})[\x{A0},](\p{Nd})", r"\1\2"),
    (True, rf'(\.+)"([{SPACE}]*[^<])', r'"\1\2'),
    (False, ',"', '",'),
    (False, " ,", ","),
    (False, ",", ", "),
    (True, BLANKS, " "),
    (True, r"(\p{Nd}) %", r"\1%"),
    (True, r"""([\p{L}\p{N}_"']) ?([:;]) ?([\p{L}\p{N}_"'\n]|$)""", r"\1\2 \3"),
    (False, " , ", ", "),
    (False, " .", "."),
    (True, rf"\( +({WORD})", r"(\1"),
    (True, rf"({WORD}) +\)", r"\1)"),
    (True, BLANKS, " "),
    (True, rf"(^|\n)[{SPACE}]+", r"\1"),
    (True, rf"[{SPACE}]+(\n|$)", r"\1"),
]



def listed(*ranges: tuple[int, int]) -> str:
    """Code points under 256 one by one, for a class: the JVM looks those up in a table, while it tries ranges in turn."""
    return "".join(f"\\x{c:02X}" for a, b in ranges for c in range(a, b + 1))


#: The first so many rewrites concern code points out of this list only; a text without any of them skips these.
PLAIN = listed((0x0A, 0x0A), (0x20, 0x5F), (0x61, 0x7E), (0xA1, 0xAA), (0xAC, 0xAC), (0xAE, 0xAE), (0xB0, 0xB3), (0xB5, 0xBA), (0xBC, 0xE5), (0xE7, 0xFF))
SPECIAL, N_SPECIAL = f"[^{PLAIN}]|''", 29

#: Code points under it are their own NFC, alone and in any order.
FIRST_COMBINING = r"[\x{300}-\x{10FFFF}]"


@F.pandas_udf(StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(StringType())
def _repaired(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def line(s: str) -> str:
        for code in ("latin-1", "cp1252"):
            try:
                return s.encode(code).decode("utf-8")
            except UnicodeError:
                continue
        return s

    for texts in batches:
        yield texts.map(lambda t: "\n".join(line(s) for s in t.split("\n")), na_action="ignore")


#: What bytes of UTF-8 read as Latin-1 look like.
MOJIBAKE = r"[\x{C2}\x{C3}][\x{80}-\x{BF}\x{20AC}\x{201A}-\x{201E}\x{2026}\x{2020}\x{2021}\x{2030}\x{2039}\x{203A}\x{2122}\x{0152}\x{0153}\x{0160}\x{0161}\x{0178}\x{017D}\x{017E}\x{0192}\x{02C6}\x{02DC}]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nfc(text: Column) -> Column:
    """NFC; only texts with code points that may combine leave the JVM."""
    return F.coalesce(_nfc(F.when(text.rlike(FIRST_COMBINING), text)), text)


def fix_encoding(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1 or Windows-1252, line by line."""
    return F.coalesce(_repaired(F.when(text.rlike(MOJIBAKE), text)), text)


def strip_emojis(text: Column) -> Column:
    return F.regexp_replace(text, EMOJI, " ")


def _chain(text: Column, rewrites: list[tuple[bool, str, str]]) -> Column:
    for is_pattern, what, by in rewrites:
        text = F.regexp_replace(text, F.lit(what), F.lit(by.replace("$", r"\$").replace("\\1", "$1").replace("\\2", "$2").replace("\\3", "$3"))) if is_pattern else F.replace(text, F.lit(what), F.lit(by))
    return text


def rewrite(text: Column) -> Column:
    """All rewrites in order."""
    return let(text, lambda t: _chain(F.when(t.rlike(SPECIAL), _chain(t, REWRITES[:N_SPECIAL])).otherwise(t), REWRITES[N_SPECIAL:]))


def normalize(text: Column, repair: bool = False, emojis: bool = True, compose: bool = True) -> Column:
    """The whole normalisation; ``emojis=False`` strips them, ``compose=False`` leaves NFC to the caller."""
    if repair:
        text = fix_encoding(text)
    if compose:
        text = nfc(text)
    if not emojis:
        text = strip_emojis(text)
    return rewrite(text)
