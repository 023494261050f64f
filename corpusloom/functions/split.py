"""Sentence splitting as a column expression from text to an array of sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import let

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TENS = ["", "X", "XX"]
_ROMAN = [t + u for t in _TENS for u in ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")][1:21]
#: What a period ends no sentence after. ``-`` after a word: only where a number follows.
TITLES = """Adj Adm Adv Asst Bart Bldg Brig Bros Capt Cmdr Col Comdr Con Corp Cpl DR Dr Ens Gen Gov Hon Hosp Insp Lt MM MR MRS MS Maj
Messrs Mlle Mme Mr Mrs Ms Msgr Op Ord Pfc Ph Prof Pvt Rep Reps Res Rev Rt Sen Sens Sfc Sgt Sr St Supt Surg"""
ENGLISH = """Drs Hr Jr v vs i.e rev e.g aka No- Nos Art- Nr pp- max- min- Jan Feb Mar Apr Jun Jul Aug Sep Oct Nov Dec"""
GERMAN = """Min Mio Mrd bzw v vs usw d.h z.B u.a etc Mrd MwSt ggf d.J D.h m.E vgl I.F z.T sogen ff u.E g.U g.g.A c.-à-d Buchst
u.s.w sog u.ä Std evtl Zt Chr u.U o.ä Ltd b.A z.Zt spp sen SA k.o jun i.H.v dgl dergl Co zzt usf s.p.a Dkr Corp bzgl BSE inkl
No Nos Art Nr pp ca Ca"""


def _listed(*lists: str) -> dict[str, bool]:
    return {w.rstrip("-") if len(w) > 1 else w: w.endswith("-") and len(w) > 1 for words in lists for w in words.split()}


#: A prefix table by language: whether a prefix holds before numbers only. Single letters, Roman numerals and ordinals by rule.
PREFIXES = {
    "en": {**dict.fromkeys(_UPPER, False), **_listed(TITLES, ENGLISH)},
    "de": {**dict.fromkeys([*_UPPER, *_LOWER, *_ROMAN, *(r.lower() for r in _ROMAN)], False), **_listed(TITLES, GERMAN), **{str(n): False for n in range(1, 100)}},
}
LANGS = ["en", "de"]

OPEN = r"""'"(\[¿¡\p{Pi}"""
CLOSE = r"""'")\]\p{Pf}"""
#: Where a line break goes, in order; \1 and \2 are what stands around it.
MORE = r"([:;])([^\p{Nd})(/\-])"
BREAKS = [
    r'([?!]+)([^?!\p{Pe}\p{Pf}"])',
    rf"(\.\.+) +([{OPEN}]*\p{{L}})",
    rf"([?!.] *[{CLOSE}]+) +([{OPEN}]* *\p{{Lu}})",
    rf"([?!.]) +([{OPEN}]+ *\p{{L}})",
]
#: The strict mode starts sentences with upper case only and breaks at every colon.
STRICT_MORE = r"([:;])()"
STRICT_BREAKS = [rf"([?!]) +([{OPEN}]*\p{{Lu}})", rf"(\.\.+) +([{OPEN}]*\p{{Lu}})", rf"([?!.] *[{CLOSE}]+) +([{OPEN}]* *\p{{Lu}})", rf"([?!.]) +([{OPEN}]+ *\p{{Lu}})"]
ALNUM = r"[\p{L}\p{M}\p{Nl}\p{Nd}.\-]"
ENDING = rf"""({ALNUM}*)(['")\]%\p{{Pf}}]*)(\.+)$"""
ACRONYM = r"\.[\p{Lu}\-]+\.+$"
STARTER = rf"^ *[{OPEN}]* *[\p{{L}}0-9]"
STRICT_STARTER = rf"^ *[{OPEN}]* *[\p{{Lu}}0-9]"


def read_prefixes(lines: list[str]) -> dict[str, bool]:
    """A prefix list: ``#`` begins a comment, ``#NUMERIC_ONLY#`` after a word restricts it; later entries win."""
    kind: dict[str, bool] = {}
    for line in lines:
        line = line.strip()
        if line and not line.startswith("#"):
            word = line.removesuffix("#NUMERIC_ONLY#")
            kind[word.strip()] = word != line
    return kind


def clean_spaces(text: Column) -> Column:
    text = F.regexp_replace(text, " +", " ")
    text = F.replace(F.replace(text, F.lit("\n "), F.lit("\n")), F.lit(" \n "), F.lit("\n"))
    return F.btrim(text, F.lit(" \n\t\r"))


def prefixes(langs: list[str] = LANGS, own: dict[str, bool] | None = None) -> tuple[list[str], list[str]]:
    """(always, before numbers only), of a user's ``own`` table if given, else of all languages, the later ones winning; unknown languages have none."""
    table: dict[str, bool] = {}
    for part in [own] if own is not None else [PREFIXES.get(x, {}) for x in langs]:
        table.update(part)
    return sorted(w for w, n in table.items() if not n), sorted(w for w, n in table.items() if n)


def _periods(words: Column, table: tuple[list[str], list[str]], strict: bool) -> Column:
    """Words joined again, with a break after those whose period ends a sentence: a look ahead of one word."""
    always, numeric = table

    def word(w: Column, after: Column) -> Column:
        prefix, closed = F.regexp_extract(w, ENDING, 1), F.regexp_extract(w, ENDING, 2) != ""
        held = prefix.isin(always) & ~closed
        number = prefix.isin(numeric) & ~closed & after.rlike("^[0-9]") if numeric else F.lit(False)
        ends = F.endswith(w, F.lit(".")) & after.isNotNull() & after.rlike(STRICT_STARTER if strict else STARTER) & ~w.rlike(ACRONYM) & ~held & ~number
        return F.when(ends, F.concat(w, F.lit("\n"))).otherwise(w)

    return let(words, lambda ws: F.array_join(F.transform(ws, lambda w, i: word(w, F.get(ws, i + 1))), " "))


def split_paragraph(text: Column, more: bool = True, langs: list[str] = LANGS, strict: bool = False, own: dict[str, bool] | None = None) -> Column:
    """A paragraph to an array of sentences."""
    text = clean_spaces(text)
    for pattern in ([STRICT_MORE if strict else MORE] if more else []) + (STRICT_BREAKS if strict else BREAKS):
        text = F.regexp_replace(text, pattern, "$1\n$2")
    return F.split(clean_spaces(_periods(F.split(text, " ", -1), prefixes(langs, own), strict)), "\n", -1)


def paragraphs(text: Column, keep_newlines: bool = True) -> Column:
    """Lines that aren't blank; without ``keep_newlines`` blank lines part paragraphs and others are joined."""
    if keep_newlines:
        return F.filter(F.split(text, "\n", -1), lambda p: F.btrim(p, F.lit(" \t\r\x0b\x0c")) != "")
    blocks = F.split(text, r"\n(?:[ \t\r\x0B\f]*\n)+", -1)
    return F.filter(F.transform(blocks, lambda b: F.btrim(F.replace(b, F.lit("\n"), F.lit(" ")), F.lit(" \t\r"))), lambda b: b != "")


def split(text: Column, more: bool = True, keep_newlines: bool = True, langs: list[str] = LANGS, strict: bool = False, own: dict[str, bool] | None = None) -> Column:
    """A text to an array of sentences, in order; ``own`` is a user's prefix table, in place of those of the languages."""
    return F.flatten(F.transform(paragraphs(text, keep_newlines), lambda p: split_paragraph(p, more, langs, strict, own)))


#: A line that is a mark ends a paragraph, and follows it as a sentence of its own.
MARK = r"^<.*>$"


def split_marked(text: Column, more: bool = True, lang: str = "de", own: dict[str, bool] | None = None) -> Column:
    """The strict mode over running text: paragraphs end at blank lines and at marks such as ``<p>``; marks after no text are left out."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.when(x.rlike(MARK), F.concat(F.lit("\n"), x, F.lit("\n"))).otherwise(x))
    blocks = paragraphs(F.array_join(lines, "\n"), False)
    is_mark = lambda b: F.coalesce(b.rlike(MARK), F.lit(True))
    blocks = let(blocks, lambda bs: F.filter(bs, lambda b, i: ~is_mark(b) | ~is_mark(F.get(bs, i - 1))))
    return F.flatten(F.transform(blocks, lambda b: F.when(is_mark(b), F.array(b)).otherwise(split_paragraph(b, more, [lang], True, own))))


def split_lines(text: Column) -> Column:
    """The default splitter: lines."""
    return F.split(F.regexp_replace(text, r"\R$", ""), r"\R", -1)


def split_builtin(text: Column, lang: str = "en") -> Column:
    """The JVM's own sentence boundaries, words without punctuation, each line by itself."""
    per_line = F.transform(paragraphs(text), lambda p: F.transform(F.sentences(p, F.lit(lang), F.lit("")), lambda ws: F.array_join(ws, " ")))
    return F.flatten(per_line)
