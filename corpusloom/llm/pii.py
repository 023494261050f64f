"""Personal data by patterns and bootstrapped contexts, in Spark expressions only.

Base spans: the regular expression cuts a text into matches and the parts between them, whose running lengths give the
positions: sums within chunks of CHUNK matches, and the sums of the chunks before, so that no match is copied once for
each later one. Quantifiers are possessive and starts are anchored at token starts, so that long runs cost linear time.
What overlaps what is told by windows over a text's spans and tokens in order, a running maximum of ends.

Bootstrapping: base spans, whole, are the seeds of their kind (of those that overlap, the first); candidates are the tokens beside them that hold a digit or
an @, adjoining ones of digits and punctuation taken together. The two words before a candidate, however far and in lower
case with digits as 0, are its lexical pattern, a candidate among them counting as MARK; an instance is its text in lower case, numbers without the signs that group them. Each round scores the
graph of patterns and instances: a pattern's confidence is the part of its instances that is known to be of a kind, an
unknown instance's score is one minus the product of what its confident patterns doubt; instances at MIN_INSTANCE or
more join the known ones, until a round adds none. Spans of known instances in a confident pattern are added to the base ones. Counts are partial aggregates over
all texts, so a pattern or an instance that a third of all rows share is a row for each task.

Defined cases: a null text counts as empty; ids may be null and rows repeated, as texts are told apart by a number of
their own; spans are code points, end exclusive; an empty table gives an empty result; of the input only id and text
are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, saved, small, whole, words_of

_MAIL = "[A-Za-z0-9._%+-]"
#: What each base kind looks like, as listed; each starts where the last match ended or where a token starts.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
#: A text without it has no match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Context kinds are reported under these names.
FOUND = {k: f"like_{k}" for k in KINDS}
CANDIDATE = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]++"
#: Tokens that run on with others, unless the one before ends a clause; what may stand between them.
NUMBER, GAP = r"^[^\p{L}@]*+$", r"^\x20(?:[-+./()]\x20)?$"
MIN_PATTERN, MIN_INSTANCE, MIN_SEEDS = 0.8, 0.8, 3
#: Stands for a candidate in the context of a later one; longer patterns than LONG are told apart by their SHA-256.
MARK, LONG = "@", 128
#: Matches whose places are summed up at once.
CHUNK = 256


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check."""
    from_right = F.reverse(digits)
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    values = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(i % 2 == 1, F.substring(from_right, i, F.lit(1)).cast("int")).otherwise(F.element_at(doubled, F.substring(from_right, i, F.lit(1)).cast("int") + 1)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    """What a match must fulfil beyond its pattern."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(F.split(m, r"\."), lambda p: F.coalesce(F.right(p, F.lit(3)).cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.when(F.length(_digits(m)).between(12, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _matches(t: Column, pattern: str) -> Column:
    """Leftmost matches with their places: array of (start, end, m, before), code points."""
    found, between = F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.split(t, pattern, -1)
    pairs = F.arrays_zip(found.alias("m"), F.slice(between, F.lit(1), F.size(found)).alias("b"))

    def chunks(pairs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(pairs) / CHUNK).cast("int") - 1, F.lit(0))), lambda k: F.slice(pairs, k * CHUNK + 1, F.lit(CHUNK)))

    length = lambda x: F.length(x["b"]) + F.length(x["m"])

    def starts(chunks: Column) -> Column:
        """Where each chunk begins."""
        size = lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + length(x))
        step = lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(F.transform(chunks, size), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step)["out"]

    def placed(chunk: Column, at: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["b"])
            end = start + F.length(x["m"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"), x["b"].alias("before")))).alias("out"))

        return F.aggregate(chunk, F.struct(at.alias("at"), F.array().cast(_MATCHES).alias("out")), step)["out"]

    return let(let(pairs, chunks), lambda cs: F.flatten(F.transform(F.arrays_zip(cs.alias("c"), starts(cs).alias("s")), lambda x: placed(x["c"], x["s"]))))


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_MATCHES = "array<struct<start:int,end:int,m:string,before:string>>"
_SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"
_SEEDS = "array<struct<start:int,order:int,end:int,kind:string,m:string>>"
_TOKENS = "array<struct<start:int,end:int,m:string,before:string,gap:string>>"


def _base(t: Column, kind: str) -> Column:
    spans = F.transform(F.filter(_matches(t, PATTERNS[kind]), lambda x: _holds(kind, x["m"])), lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["m"].alias("m")))
    may = F.contains(t, F.lit(NEEDS[kind])) if NEEDS[kind] else t.rlike("[0-9]")
    return F.when(may, spans).otherwise(F.array().cast(_SEEDS))


def _contexts(tokens: Column) -> Column:
    """The tokens, each with the two words before it in place of all that stands between it and the one before, and their gap.

    An earlier token is a word of its own, MARK, so that the two words lie in the last two parts between tokens.
    """
    words = F.transform(tokens, lambda x: let(words_of(x["before"]), lambda ws: F.slice(ws, F.greatest(F.size(ws) - 1, F.lit(1)), F.lit(2))))

    def of(x: Column, i: Column, ws: Column) -> Column:
        none, mark = F.array().cast("array<string>"), F.array(F.lit(MARK))
        all_ = F.concat(F.when(i >= 2, mark).otherwise(none), F.when(i >= 1, F.concat(F.get(ws, i - 1), mark)).otherwise(none), F.get(ws, i))
        two = let(all_, lambda a: F.slice(a, F.greatest(F.size(a) - 1, F.lit(1)), F.lit(2)))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("m"), F.array_join(two, " ").alias("before"), F.when(F.length(x["before"]) <= 3, x["before"]).alias("gap"))

    return let(words, lambda ws: F.transform(tokens, lambda x, i: of(x, i, ws)))


def base(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, doc_id, an array of spans for each kind, the candidates with what stands before them)."""
    t = F.col("t")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("doc_id"), whole(docs[text]).alias("t"))
    candidates = F.when(t.rlike("[0-9@]"), let(_matches(t, CANDIDATE), _contexts)).otherwise(F.array().cast(_TOKENS))
    return rows.select("row", "doc_id", *[_base(t, k).alias(k) for k in KINDS], candidates.alias("candidates"))


def _instance(m: Column) -> Column:
    """What a text is known by; numbers in groups are their digits, with the plus before them."""
    return F.when(m.rlike(r"^[+0-9\x20()-]++$"), F.regexp_replace(m, r"[\x20()-]", "")).otherwise(ascii_lower(m))


def candidates(rows: DataFrame) -> DataFrame:
    """(row, start, end, pattern, instance, kind): a span and its context; kind is that of a base span, null for a run of tokens beside them.

    Runs are free tokens of digits and punctuation joined with such ones right after them.
    """
    some = rows.filter(F.size("candidates") > 0)
    spans = some.select("row", F.explode(F.concat(*KINDS)).alias("s")).select("row", "s.start", "s.order", "s.end", "s.kind", "s.m", F.lit("").alias("before"), F.lit(None).cast("string").alias("gap"))
    tokens = some.select("row", F.explode("candidates").alias("s")).select("row", "s.start", F.lit(-1).alias("order"), "s.end", F.lit(None).cast("string").alias("kind"), "s.m", "s.before", "s.gap")
    is_span = F.col("order") >= 0
    down = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("order")).rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy("row").orderBy("start", "order")
    up = in_order.rowsBetween(Window.unboundedPreceding, -1)
    every = spans.unionByName(tokens).withColumn("ahead", F.last(F.when(is_span, F.col("start")), True).over(down))
    every = every.withColumns({"back": F.max(F.when(is_span, F.col("end"))).over(up), "token": F.last(F.when(~is_span, F.struct("end", "before")), True).over(up)})
    clear = F.coalesce(F.col("back") <= F.col("start"), F.lit(True))
    every = every.filter(clear & (is_span | F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True))))  # the first of spans that overlap, and free tokens
    every = every.withColumn("before", F.when(is_span, F.when(F.col("token.end") > F.col("start"), F.col("token.before"))).otherwise(F.col("before")))
    last = lambda c: F.lag(c).over(in_order)
    on = ~is_span & (last("order") < 0) & (last("end") + F.length("gap") == F.col("start")) & F.col("gap").rlike(GAP) & F.col("m").rlike(NUMBER) & last("m").rlike(NUMBER) & ~last("m").rlike("[.,;:!?]$")
    every = every.withColumn("on", F.coalesce(on, F.lit(False)))
    every = every.withColumn("run", F.sum(F.when(F.col("on"), 0).otherwise(1)).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    part = F.struct("start", F.when(F.col("on"), F.concat("gap", "m")).otherwise(F.col("m")).alias("m"), "before")
    runs = every.groupBy("row", "run").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("kind").alias("kind"))
    m = F.array_join(F.transform("parts", lambda p: p["m"]), "")
    m = F.when(F.col("kind").isNull(), F.regexp_replace(m, r"[.,;:!?)\]}\"']+$", "")).otherwise(m)
    first = F.get("parts", F.lit(0))
    c = runs.select("row", first["start"].alias("start"), m.alias("m"), first["before"].alias("before"), "kind")
    pattern = F.regexp_replace(ascii_lower(F.col("before")), "[0-9]+", "0")
    pattern = F.when(F.length(pattern) > LONG, F.sha2(pattern, 256)).otherwise(pattern)
    return c.select("row", "start", (F.col("start") + F.length("m")).alias("end"), pattern.alias("pattern"), _instance(F.col("m")).alias("instance"), "kind").filter("pattern != '' and instance != ''")


def _confident(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that mostly hold known instances of one kind."""
    marked = edges.join(known, "instance", "left")
    per_kind = marked.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n"))
    all_ = per_kind.groupBy("pattern").agg(F.sum("n").alias("all"), F.max(F.when(F.col("kind").isNotNull(), F.struct("n", "kind"))).alias("best"))
    return all_.select("pattern", F.col("best.kind").alias("kind"), (F.col("best.n") / F.col("all")).alias("confidence"), F.col("best.n").alias("n")).filter((F.col("n") >= MIN_SEEDS) & (F.col("confidence") >= MIN_PATTERN)).drop("n")


def bootstrap(found: DataFrame) -> DataFrame:
    """(row, start, end, kind): candidates outside base spans that the pattern-instance graph makes known."""
    edges = saved(found.groupBy("pattern", "instance").agg(F.max("kind").alias("seed")))
    known = edges.filter("seed is not null").groupBy("instance").agg(F.max("seed").alias("kind"))
    edges = edges.select("pattern", "instance")
    while True:
        patterns = _confident(edges, known)
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        scored = edges.join(known, "instance", "left_anti").join(patterns, "pattern").groupBy("instance", "kind").agg(F.round(1 - doubt, 9).alias("score"))  # whatever order it was summed in
        new = scored.filter(F.col("score") >= MIN_INSTANCE).groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b")).select("instance", "b.kind")
        new = saved(new)
        if new.isEmpty():
            break
        known = saved(known.unionByName(new))
    patterns = saved(_confident(edges, known).select("pattern", "kind"))
    patterns = small(patterns, patterns.count(), 4 * LONG)
    return found.filter("kind is null").drop("kind").join(patterns, "pattern").join(known, ["instance", "kind"]).select("row", "start", "end", "kind")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_ of each kind, base spans, and all spans with what the contexts add."""
    rows = saved(base(docs, text, key))
    more = bootstrap(saved(candidates(rows)))
    kind = reduce(lambda c, k: c.when(F.col("kind") == k, FOUND[k]), KINDS, F.when(F.lit(False), ""))
    order = reduce(lambda c, k: c.when(F.col("kind") == k, len(KINDS) + KINDS.index(k)), KINDS, F.when(F.lit(False), 0))
    extra = more.groupBy("row").agg(F.collect_list(F.struct("start", order.alias("order"), "end", kind.alias("kind"))).cast(_SPANS).alias("extra"))
    spans = F.sort_array(F.transform(F.concat(*[F.col(k) for k in KINDS]), lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
    out = rows.select("row", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], spans.alias("base")).join(extra, "row", "left")
    return out.withColumn("spans", F.sort_array(F.concat("base", F.coalesce("extra", F.array().cast(_SPANS))))).drop("row", "extra")


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    found = scan(docs, text, key)
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
