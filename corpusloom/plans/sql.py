"""SQL twins of the text functions, for an engine with RE2 patterns."""

from __future__ import annotations

from corpusloom.functions import normalize, rules, split


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2(pattern: str) -> str:
    """A Java pattern in RE2's dialect."""
    return pattern.replace(r"\x0B", r"\x{0B}").replace(r"\R", r"(?:\r\n|[\n\r])")


def sub(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {lit(re2(pattern))}, {lit(by)}, 'g')"


def normalized(text: str) -> str:
    text = sub(f"nfc_normalize({text})", normalize.EMOJI, " ")
    for is_pattern, what, by in normalize.REWRITES:
        text = sub(text, what, by) if is_pattern else f"replace({text}, {lit(what)}, {lit(by)})"
    return text


def clean(text: str) -> str:
    return f"trim(replace(replace({sub(text, ' +', ' ')}, chr(10) || ' ', chr(10)), ' ' || chr(10) || ' ', chr(10)), ' ' || chr(9) || chr(10) || chr(13))"


def _breaks(text: str, more: bool, strict: bool) -> str:
    for pattern in ([split.STRICT_MORE if strict else split.MORE] if more else []) + (split.STRICT_BREAKS if strict else split.BREAKS):
        text = f"regexp_replace({text}, {lit(pattern)}, '\\1' || chr(10) || '\\2', 'g')"
    return text


def split_cte(source: str, key: str = "doc_id", text: str = "t", name: str = "sent", more: bool = True, strict: bool = False, unique: bool = True) -> str:
    """CTEs from ``source`` (key, t: normalised text) to ``name`` (key, pos, sentence), distinct in their page if ``unique``."""
    always, numeric = ([lit(w) for w in ws] for ws in split.prefixes(split.LANGS))
    ends = f"""suffix(w, '.') AND i < len(ws) AND NOT (regexp_extract(w, {lit(split.ENDING)}, 1) IN ({", ".join(always)}) AND regexp_extract(w, {lit(split.ENDING)}, 2) = '')
        AND NOT regexp_matches(w, {lit(split.ACRONYM)}) AND regexp_matches(ws[i + 1], {lit(split.STRICT_STARTER if strict else split.STARTER)})
        AND NOT (regexp_extract(w, {lit(split.ENDING)}, 1) IN ({", ".join(numeric)}) AND regexp_extract(w, {lit(split.ENDING)}, 2) = '' AND regexp_matches(ws[i + 1], '^[0-9]'))"""
    return f"""{name}_p AS (SELECT {key}, unnest(l) AS p, unnest(range(len(l))) AS k FROM (SELECT {key}, list_filter(string_split({text}, chr(10)), lambda p: trim(p, ' ' || chr(9) || chr(13)) <> '') AS l FROM {source})),
    {name}_w AS (SELECT {key}, k, string_split({_breaks(clean('p'), more, strict)}, ' ') AS ws FROM {name}_p),
    {name}_j AS (SELECT {key}, k, array_to_string(list_transform(ws, lambda w, i: CASE WHEN {ends} THEN w || chr(10) ELSE w END), ' ') AS t FROM {name}_w),
    {name}_s AS (SELECT {key}, k, unnest(l) AS sentence, unnest(range(len(l))) AS j FROM (SELECT {key}, k, string_split({clean('t')}, chr(10)) AS l FROM {name}_j)),
    {name}_d AS (SELECT {key}, sentence, k, j, row_number() OVER (PARTITION BY {key}, sentence ORDER BY k, j) AS r FROM {name}_s),
    {name} AS (SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY k, j) - 1 AS INTEGER) AS pos, sentence FROM {name}_d{" WHERE r = 1" if unique else ""})"""


def count(s: str, pattern: str) -> str:
    if pattern.startswith("(?="):  # no look-ahead there: letters and the like, but for those of the target alphabet
        return f"({count(s, pattern[pattern.index(')') + 1 :])} - {count(s, '[äÄöÖüÜa-zA-Z]')})"
    return f"len(regexp_extract_all({s}, {lit(re2(pattern))}))"


def _within(value: str, bounds: rules.Bounds) -> str:
    parts = ([f"{value} >= {bounds[0]}"] if bounds[0] is not None else []) + ([f"{value} <= {bounds[1]}"] if bounds[1] is not None else [])
    return "(" + " AND ".join(parts or ["TRUE"]) + ")"


def holds(rule: rules.Rule, s: str) -> str:
    if rule.name == "repeated_letters":  # no back-references there
        ok = f"len(list_filter(range(1, length({s}) - 7), lambda i: {s}[i:i+8] = repeat({s}[i:i], 9) AND {s}[i:i] NOT IN ('?', '!'))) = 0"
    elif rule.length is not None:
        ok = _within(f"length({s})", rule.length)
    elif rule.compare is not None:
        ok = _within(f"({count(s, rule.compare[0])} / ({count(s, rule.compare[1])} + 1))", rule.ratio)
    elif rule.count is not None:
        ok = _within(count(s, rule.find), rule.count)
    else:
        ok = _within(f"(CASE WHEN length({s}) > 0 THEN {count(s, rule.find)} / length({s}) ELSE 0 END)", rule.ratio)
    guards = ([f"NOT {_within(f'length({s})', rule.when_length)}"] if rule.when_length is not None else []) + ([f"NOT {count(s, rule.when_find)} > 0"] if rule.when_find is not None else [])
    return "(" + " OR ".join([*guards, ok]) + ")"


def valid(s: str, profile: list[rules.Rule]) -> str:
    return " AND ".join(holds(r, s) for r in profile)


def first_failing(s: str, profile: list[rules.Rule]) -> str:
    return "CASE " + " ".join(f"WHEN NOT {holds(r, s)} THEN {lit(r.name)}" for r in profile) + " END"
