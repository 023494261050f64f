"""Secret scans with multipart credential linking.

Patterns find the parts of credentials: access identifiers, secrets and endpoints. Assignments, access keys and long
hexadecimal runs are strong and always reported. Weak parts (tokens that look random, assignments of short values,
account names) are reported only when complementary parts lie in the same scope, a scope being lines between blank
ones: an interval join of parts and scopes. Each scope keeps of each sort of part the least end and the greatest start,
which tell at once whether it has one beside a given span. Texts are judged in place, so nothing is shuffled and a
text's parts are the only state.

Defined cases: a null text counts as empty and has no spans; ids may be null and rows repeated; spans are code points,
end exclusive; long texts and long scopes are taken whole; a weak part that overlaps a strong one is left out, and a
part that overlaps a span doesn't complete it; an empty table gives an empty result; other columns are passed on, but
for names that the results take.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import beside, through, whole

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Weak secrets: tokens of 20 characters or more; weak accounts; endpoints.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
ACCOUNT = re.compile(r"""\b(?:client|account|user|access)[_ -]?(?:id|name|key)?["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{4,})""", re.I | re.A)
ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|\b(?:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[A-Za-z]{2,}""", re.I | re.A)

KINDS = ["assign", "access", "hex", "secret", "account"]
BASE = KINDS[:3]
MIN_ENTROPY, MIN_ASSIGNED = 3.5, 12
BREAK = re.compile(r"\n[\x20\t]*\n")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """Strong parts as (start, kind's place in KINDS, end)."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _random(token: str) -> bool:
    n = len(token)
    return bool(re.search("[a-z]", token) and re.search("[A-Z]", token)) and -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= MIN_ENTROPY


def weak_spans(text: str) -> list[Span]:
    """Tokens that look random, assignments of short values that hold none of them, and accounts."""
    tokens = [(m.start(), 3, m.end()) for m in TOKEN.finditer(text) if _random(m[0])]
    if ":" not in text and "=" not in text:
        return tokens
    short = [(m.start(), 3, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) < MIN_ASSIGNED]
    return tokens + _apart(short, tokens) + [(m.start(), 4, m.end()) for m in ACCOUNT.finditer(text)]


def _apart(spans: list[Span], others: list[Span]) -> list[Span]:
    """Those of ``spans`` that overlap none of the ``others``."""
    starts, ends = [], []  # what the others cover, as intervals apart from each other
    for s, _, e in sorted(others):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return [x for x in spans if not ((k := bisect_left(starts, x[2])) and ends[k - 1] > x[0])]


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts that have complementary parts beside them in their scope and overlap no strong one."""
    weak = _apart(weak_spans(text), base)
    if not weak:
        return []
    breaks = [m.start() for m in BREAK.finditer(text)]
    sorts = {
        "endpoint": [(m.start(), m.end()) for m in ENDPOINT.finditer(text)],
        "identifier": [(s, e) for s, k, e in base if k == 1] + [(s, e) for s, k, e in weak if k == 4],
        "secret": [(s, e) for s, k, e in base if k in (0, 2)] + [(s, e) for s, k, e in weak if k == 3],
    }
    bounds: dict[tuple[str, int], tuple[int, int]] = {}  # of a sort in a scope: the least end, the greatest start
    for sort, parts in sorts.items():
        for s, e in parts:
            at = sort, bisect_right(breaks, s)
            end, start = bounds.get(at, (e, s))
            bounds[at] = min(end, e), max(start, s)

    def beside_it(span: Span, sort: str) -> bool:
        end, start = bounds.get((sort, bisect_right(breaks, span[0])), (span[2], span[0]))
        return end <= span[0] or start >= span[2]

    # a secret needs an identifier or an endpoint beside it; an account needs a secret and an endpoint
    return [w for w in weak if (beside_it(w, "identifier") or beside_it(w, "endpoint") if w[1] == 3 else beside_it(w, "secret") and beside_it(w, "endpoint"))]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, start, end) by start, then by kind as listed."""

    def work():
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        rows = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

        def job(texts: list[str]) -> list[pa.Array]:
            base = [base_spans(t) for t in texts]
            every = [sorted(b + linked_spans(t, b)) for t, b in zip(texts, base, strict=True)]
            return [pa.array([rows(b) for b in base], kind), pa.array([rows(s) for s in every], kind)]

        return job

    span = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
    return through(docs, beside(docs, "base", "spans"), whole(docs[text]), work, StructType([StructField("base", span), StructField("spans", span)]))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    found = scan(docs.select(docs[key].alias("doc_id"), docs[text].alias("base")), "base")  # the text gives way to its spans
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
