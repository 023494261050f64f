"""Sentence rules: declarative measures and bounds compiled into boolean columns."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import let, listed

Bounds = tuple[float | None, float | None]


@dataclass(frozen=True)
class Rule:
    """One of length, find (with count or ratio) or compare; ``when_length`` and ``when_find`` guard it."""

    name: str
    length: Bounds | None = None
    find: str | None = None
    count: Bounds | None = None
    ratio: Bounds | None = None
    compare: tuple[str, str] | None = None
    when_length: Bounds | None = None
    when_find: str | None = None
    fails: tuple[str, ...] = field(default=())
    passes: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if (self.length is not None) + (self.find is not None) + (self.compare is not None) != 1:
            raise ValueError(f"{self.name}: a rule has one of length, find, compare")
        if self.find is not None and self.count is None and self.ratio is None:
            raise ValueError(f"{self.name}: find has a count or a ratio")


#: Bounds of counts that ask whether there is a match at all.
NONE_OR_SOME = {(None, 0): False, (0, 0): False, (1, None): True}


def within(value: Column, bounds: Bounds) -> Column:
    least, most = bounds
    parts = ([value >= F.lit(least)] if least is not None else []) + ([value <= F.lit(most)] if most is not None else [])
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _count(s: Column, pattern: str) -> Column:
    return F.regexp_count(s, F.lit(pattern))


def holds(rule: Rule, s: Column) -> Column:
    """Whether a sentence passes a rule. The ratio of an empty sentence is zero."""
    if rule.length is not None:
        ok = within(F.length(s), rule.length)
    elif rule.compare is not None:
        ok = within(_count(s, rule.compare[0]) / (_count(s, rule.compare[1]) + 1), rule.ratio)
    else:
        n = _count(s, rule.find)
        if rule.count in NONE_OR_SOME:  # the first match decides
            ok = s.rlike(rule.find) == NONE_OR_SOME[rule.count]
        else:
            ok = within(n, rule.count) if rule.count is not None else within(F.when(F.length(s) > 0, n / F.length(s)).otherwise(0.0), rule.ratio)
    guards = ([within(F.length(s), rule.when_length)] if rule.when_length is not None else []) + ([s.rlike(rule.when_find)] if rule.when_find is not None else [])
    return reduce(lambda a, g: ~g | a, guards, ok)


def valid(s: Column, rules: list[Rule]) -> Column:
    """Whether a sentence passes all rules.

    As a lambda, the rules stay out of the method that Spark generates for a stage, which they make too long for the JVM
    to compile: twice as fast.
    """
    return let(s, lambda x: reduce(lambda a, r: a & holds(r, x), rules, F.lit(True)))


def first_failing(s: Column, rules: list[Rule]) -> Column:
    """Name of the first rule that a sentence violates, or null."""
    return let(s, lambda x: F.coalesce(*[F.when(~holds(r, x), r.name) for r in rules]))


#: The default rules, in their order.
DEFAULT: list[Rule] = [
    Rule("max_length", length=(None, 1000)),
    Rule("min_letters", find=r"\p{L}", count=(30, None)),
    Rule("min_words", find=r"\p{L}+", count=(5, None)),
    Rule("spaces", find=" ", ratio=(0.065, 0.25)),
    Rule("non_sg_letters", find=rf"(?=[^{listed((0x00, 0x5E), (0x60, 0x7F))}äÄöÖüÜ])[\p{{L}}\p{{M}}\p{{Nl}}\p{{Pc}}]", count=(None, 2)),
    Rule("letter_density", find=r"\p{L}", ratio=(0.6, None)),
    Rule("has_tabs", find=r"\t|\s{4,}", count=(None, 0)),
    Rule("bad_chars", find=r"[|\[\]]|>>|<<|…|---|©|®|°|§|·| > |\{|\}", count=(None, 0)),
    Rule("lonelies", find=" [/=] ", count=(None, 0), fails=("So we say 3 = 3",)),
    Rule("hashtags", find=r"# ?\p{L}[^ ]+", count=(None, 1), fails=("See #this and # that",), passes=("only one#tag#here.",)),
    Rule("too_many_commas", compare=(",", r"\p{L}+"), ratio=(None, 0.25)),
    Rule("too_many_symbols", find="[/)&:]", count=(None, 7)),
    Rule("many_dots", find=r"\.", count=(None, 5), fails=("Now. Then. When. Why. Who. How.", "what ...... then")),
    Rule("dashes", find=r"[\x{AF}\x{2010}-\x{2015}\x{2212}\x{FE58}\x{FF0D}-] | [\x{AF}\x{2010}-\x{2015}\x{2212}\x{FE58}\x{FF0D}-]", count=(None, 2)),
    Rule("dashes_slashes", find=r"(?:\p{L}+[/-]){3,}", count=(None, 0)),
    Rule("arrows", find=r"[\x{2190}-\x{21FF}\x{2798}-\x{27FF}\x{2B00}-\x{2B4C}\x{2900}-\x{297F}><]", count=(None, 0)),
    Rule("word_too_long", find=r"[\p{L}#]{30,}", count=(None, 0)),
    Rule("spelled_words", find=r" (?:\p{L} ){3,}", count=(None, 0), fails=("please L I S T E N now",), passes=("a b see dee",)),
    Rule("ellipsis", find=r"(?:\.\s?){3}$", count=(None, 0), when_length=(None, 30), fails=("and more ...",)),
    Rule("caps_in_a_row", find=r"(?:\p{Lu}\p{Ll}*,? ){5}", count=(None, 0), fails=("Anna Berta Carla Dora Emma und",)),
    Rule("repeated_letters", find=r"([^?!])\1{8}", count=(None, 0), fails=("Noooooooooooo way",)),
    Rule("non_letters_in_a_row", find=r"[\p{N} :\\.,/?!-]{16}", count=(None, 0), fails=("on 2020.01.02, 10:11 !! ok",)),
    Rule("at_least_one_small_word", find=r"(?:^|\s)\p{L}{1,6}(?:\s|$)", count=(1, None), fails=("everything somewhere somebody",), passes=("it is somewhere",)),
    Rule("too_many_caps", compare=(r"(?:^| |\p{P})\p{Lu}\p{L}*", r"(?:^| |\p{P})\p{Ll}\p{L}*"), ratio=(None, 1.5)),
    Rule("http", find="@|https?:|nbsp;|a href", count=(None, 0)),
]

#: The strict profile, with the two rules that lacked a measure repaired.
STRICT: list[Rule] = [
    Rule("s01_start", find=r"^[\p{Ll}\p{Sm}\p{Pd}\p{Ps}\p{Pc}]", count=(None, 0)),
    Rule("s02_start_punct", find=r"^[*?.,/)]", count=(None, 0)),
    Rule("s03_end", find=r"[^\p{P}]$", count=(None, 0)),
    Rule("s06_double_space", find="  ", count=(None, 0)),
    Rule("s07_commas", find=",", count=(None, 9)),
    Rule("s08_periods", find=r"\.", count=(None, 7)),
    Rule("s09_spaces", find=r"\s", count=(None, 49)),
    Rule("s10_space_ratio", find=r"\s", ratio=(None, 1.4)),
    Rule("s11_brackets", find=r"[|\[\]\\]|>>|<<", count=(None, 0)),
    Rule("s12_symbols", find="[/)&:#]", count=(None, 7)),
    Rule("s13_upper_run", find=r"[\p{Lu}\s\p{P}]{22}", count=(None, 0)),
    Rule("s14_number_run", find=r"[\p{N}\p{P}]{16}", count=(None, 0)),
    Rule("s15_short_digits", find=r"[\p{N}\p{P}]{6}", count=(None, 0), when_length=(None, 45)),
    Rule("s16_short_dots", find=r"\. ?\. ?\.$", count=(None, 0), when_length=(None, 60)),
    Rule("s17_ellipsis", find=r"\.\.\.", count=(None, 0)),
    Rule("s18_marks", find=r"[?!]{2}", count=(None, 0)),
    Rule("s19_caps", find=r"(?:\p{Lu}\p{Ll}* ){8}", count=(None, 0)),
    Rule("s20_space_punct", find=r" [.,?!]", count=(None, 0)),
    Rule("s21_cut_end", find=r"(?: \p{Lu}| \p{N}+|-ing|str)[.:]$", count=(None, 0)),
    Rule("s22_length", length=(15, 255)),
    Rule("s24_tab", find=r"\t", count=(None, 0)),
    Rule("s25_encoding", find=r"[\x{80}-\x{A0}ÂÃ\x{FFFD}]", count=(None, 0)),
    Rule("s26_special_start", find=r"^[\p{S}\p{C}]", count=(None, 0)),
    Rule("s27_hash", find="#", count=(None, 0)),
    Rule("s28_equals", find="=", count=(None, 0)),
    Rule("s29_signs", find=r"[©®@\[\]{}_\x{25A0}-\x{25FF}\x{2669}-\x{266F}\x00-\x1F]", count=(None, 0)),
    Rule("s30_end_sign", find=r"[%):;,/*]$", count=(None, 0)),
    Rule("s31_runs", find=r"\*{3}|\+{3}|==|\^", count=(None, 0)),
    Rule("s32_entity", find=r"&[a-zA-Z]+;|&#[0-9]+;", count=(None, 0)),
    Rule("s33_question", find=r"\?\p{L}", count=(None, 0)),
    Rule("s34_literal", find=r", \\p\{Lu\}\.$", count=(None, 0)),
    Rule("s35_five_digits", find=r"^[0-9]{5}", count=(None, 0)),
    Rule("s36_astral", find=r"[\x{10000}-\x{10FFFF}]", count=(None, 0)),
    Rule("s37_line_separator", find=r"\x{2028}", count=(None, 0)),
    Rule("s38_joined", find=r"\p{Ll}{5}\. \p{Ll}{2}", count=(None, 0)),
    Rule("s39_two_dots", find=r"\.\.", count=(None, 0)),
    Rule("s40_digit_start", find=r"^[0-9]", count=(None, 0)),
    Rule("s3000_html", find="a href|<tr>", count=(None, 0)),
]


def from_config(entries: list[dict]) -> list[Rule]:
    """Rules from parsed YAML or JSON: a list of one-key mappings from a name to its measure, bounds and guards."""

    def bounds(x: dict | None) -> Bounds | None:
        return None if x is None else tuple(None if x.get(k, -1) == -1 else x[k] for k in ("min", "max"))

    out = []
    for entry in entries:
        ((name, e),) = entry.items()
        find, compare, guard = e.get("find") or {}, e.get("compare") or {}, e.get("if") or {}
        out.append(
            Rule(
                name,
                length=bounds(e.get("length")),
                find=find.get("pattern"),
                count=bounds(find.get("count")),
                ratio=bounds(find.get("ratio") or compare.get("ratio")),
                compare=(compare["num"], compare["denom"]) if compare else None,
                when_length=bounds(guard.get("length")),
                when_find=(guard.get("pattern") or guard.get("find") or {}).get("pattern") if isinstance(guard.get("pattern") or guard.get("find"), dict) else guard.get("pattern"),
                fails=tuple(e.get("examples") or ()),
                passes=tuple(e.get("counterexamples") or ()),
            )
        )
    return out


def examples(rules: list[Rule]) -> list[tuple[str, str, bool]]:
    """(rule, text, must fail) of the rules' own examples."""
    return [(r.name, t, f) for r in rules for f, ts in ((True, r.fails), (False, r.passes)) for t in ts]
