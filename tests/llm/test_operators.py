"""Operators against plain versions, on the documents and on rows of every odd kind."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import common, exact_dedup, mixing, pieces, pii, quality, secrets, simhash_dedup, suffix_dedup, urls, warc
from corpusloom.llm.components import components

from . import brute
from .conftest import ROWS

EDGE = [(r[0], r[1]) for r in ROWS]


# --- quality rules -----------------------------------------------------------------------------------------------------


def _measures(frame):
    return Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(frame).collect())


def _by_hand(rows):
    out = Counter()
    for i, t in rows:
        m = brute.quality(t)
        out[(i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    return out


def test_quality(docs, plain, edge):
    assert _measures(docs) == _by_hand(plain)
    assert _measures(edge) == _by_hand(EDGE)
    assert quality.judge(docs.limit(0)).count() == 0


def test_quality_keeps_columns_and_good_labels(spark, data, docs, edge):
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{data}/labels.parquet")
    judged = quality.judge(docs).join(labels, "doc_id").filter("not base_failed")
    assert judged.filter("quality = 1 and not kept").count() == 0 and judged.filter("quality = 0 and kept").count() == 0
    assert quality.keep(edge).columns == edge.columns


def test_quality_hash_clashes_take_the_exact_way(spark, monkeypatch):
    monkeypatch.setattr(quality, "_packed", lambda words: F.sort_array(F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda x, i: i.cast("long"))))
    rows = [(1, "a b c d a b c x y z a b"), (2, "p q r s t"), (3, "a a a a a")]
    assert _measures(spark.createDataFrame(rows, "doc_id long, text string")) == _by_hand(rows)


# --- exact dedup -------------------------------------------------------------------------------------------------------


def _groups(rows):
    return Counter((rows[k][0], keep, size) for k, (keep, size, _) in brute.exact(rows).items())


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(exact_dedup.sha256(t), 1, 1)])
def test_exact(docs, plain, edge, digest):
    """A digest of one hexadecimal digit clashes all the time: full bytes decide."""
    for frame, rows in ((docs, plain), (edge, EDGE)):
        got = exact_dedup.decide(frame, digest=digest).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == _groups(rows)
        assert sum(r.kept for r in got) == len({brute.re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})


def test_exact_keep_first(docs, plain, edge):
    kept = exact_dedup.keep_first(edge)
    assert kept.columns == edge.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 2, 5, 6, None, 8, 9, 10, 11, 12])
    assert exact_dedup.keep_first(docs).count() == len({t for _, t in [(i, brute.re.sub(r"[\x20\x09-\x0D]", "", t or "")) for i, t in plain]})
    assert exact_dedup.decide(docs.limit(0)).count() == 0


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(exact_dedup.sha256(t), 1, 1)])
def test_exact_state_goes_on(spark, docs, plain, edge, tmp_path, digest):
    """Days one after the other give what one batch gives, with clashing digests too; nothing is counted twice."""
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    key = F.pmod(F.xxhash64("doc_id", "text"), F.lit(3))
    for day in (0, 1, 2, 2):
        exact_dedup.add(both.filter(key == day), f"file://{tmp_path}/store", f"day{day}", digest=digest)
        if day == 1:
            exact_dedup.compact(spark, f"file://{tmp_path}/store/changes")
    got = exact_dedup.decisions(spark, f"file://{tmp_path}/store").collect()
    rows = plain + EDGE
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == _groups(rows)
    assert sum(r.kept for r in got) == len({brute.re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})


def test_only_hits_move(spark, data, docs, plain, tmp_path, monkeypatch):
    """Where the hits are too many to broadcast, bitmaps of their places are, and no other text is shuffled."""
    files = f"{tmp_path}/many"
    docs.repartition(5).write.parquet(files)
    many = spark.read.parquet(files)
    want = Counter(exact_dedup.keep_first(many).select("doc_id").collect())
    near = Counter(simhash_dedup.keep_first(many).select("doc_id").collect())
    for size in (0, 10_000):
        monkeypatch.setattr(common, "BROADCAST_BYTES", size)
        monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", size)
        kept = exact_dedup.keep_first(many)
        assert Counter(kept.select("doc_id").collect()) == want and Counter(simhash_dedup.keep_first(many).select("doc_id").collect()) == near
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan.replace("hashpartitioning(__f", "")
    marks = common.located(many).filter("doc_id % 3 = 0").select(common.FILE, common.AT)
    assert common.at_places(common.located(many), marks, 1 << 40).filter("doc_id % 3 != 0").count() == 0
    assert common.at_places(common.located(many), marks, 1 << 40).count() == marks.count()


# --- mixing ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("percent,epochs", [(80, 2), (100, 3), (30, 1), (300, 2)])
def test_mixing(docs, edge, percent, epochs):
    mix = mixing.Mix(percent=percent, epochs=epochs)
    got = Counter((r.doc_id, r["__epoch"]) for r in mixing.select(docs, mix).collect())
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert got == Counter(brute.mix(rows, mix.domains, mix.langs, percent, epochs, mix.seed))
    got = Counter((r.doc_id, r["__epoch"]) for r in mixing.select(edge, mix).collect())
    assert got == Counter(brute.mix(ROWS, mix.domains, mix.langs, percent, epochs, mix.seed))


@pytest.mark.parametrize("zero", [{"sources": {"src1": 0, "src3": 0}}, {"langs": {"en": 0, "fr": 1}}, {"domains": {"core": 0, "tail": 1}}, {"domains": {"core": 0, "tail": 0, "(none)": 0}}])
def test_mixing_without(docs, edge, zero):
    """Weights of zero: nothing is taken under them, and what they can't take goes elsewhere."""
    mix = mixing.Mix(**zero)
    for frame in (docs, edge):
        rows = [(r.doc_id, r.text, r.lang, r.source) for r in frame.collect()]
        got = Counter((r.doc_id, r["__epoch"]) for r in mixing.select(frame, mix).collect())
        assert got == Counter(brute.mix(rows, mix.domains, mix.langs, mix.percent, mix.epochs, mix.seed, mix.sources))


def test_mixing_empty(docs, edge):
    assert mixing.select(docs.limit(0)).count() == 0
    assert mixing.select(edge).columns[: len(edge.columns)] == edge.columns


# --- URL filter --------------------------------------------------------------------------------------------------------

RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"), urls.Rule("block", "com", "/de/"), urls.Rule("allow", "a.com", "/de/x/"), urls.Rule("block", "net", "")]
URLS = ["http://Example.ORG/es/x", "https://m.example.org/en/123?q", "http://example.org/en/2", "http://org", "http://x.org/", "http://notexample.org/es/", "http://b.com/de/x/y", "http://a.com/de/x/y", "http://q.a.com/de/", "x.net", "://n.net#/a", "http://n.net", "", None, "http://a.com:80/de/", "http://ÄX.com/de/Ä", "a://b://c.com/de/", "http://.com/de/"]


def _rule_by_hand(url):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        m = brute.re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host), len(r.path)), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def test_urls(spark):
    frame = spark.createDataFrame([(k, u, "c", "c") for k, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    want = {k: _rule_by_hand(u) for k, u in enumerate(URLS)}
    got = {r.page_id: tuple(r)[1:] for r in urls.judge(frame, RULES).collect()}
    assert got == want
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in RULES] + [("block", None, "/"), (None, "com", "/de/x"), ("block", "org", None)], "verdict string, host string, path string")
    by_join = {r.page_id: tuple(r)[1:] for r in urls.judge_by_join(frame, table.filter("path is not null")).collect()}
    assert by_join == want
    assert {r.page_id: r.verdict for r in urls.judge_by_join(frame, table).collect()}[3] == "block"
    assert urls.judge(frame.limit(0), RULES).count() == urls.judge_by_join(frame.limit(0), table).count() == 0
    assert {r.verdict for r in urls.judge_by_join(frame, table.limit(0)).collect()} == {r.verdict for r in urls.judge(frame, []).collect()} == {"allow"}


def test_urls_beyond_the_bound(spark):
    """A list too large for a broadcast goes through the join by itself; rules and URLs at random."""
    rng = random.Random(9)
    frame = spark.createDataFrame([(k, u, "c", "c") for k, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    assert urls.build(RULES, max_nodes=5) is None and urls.build([urls.Rule("allow", "x" * 300)], max_bytes=200) is None
    assert {r.page_id: tuple(r)[1:] for r in urls.judge(frame, RULES, max_nodes=5).collect()} == {k: _rule_by_hand(u) for k, u in enumerate(URLS)}
    host = lambda: ".".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    path = lambda: "".join(rng.choice(["/", "x", "xy", "/z"]) for _ in range(rng.randint(0, 4)))
    rules = [urls.Rule(rng.choice(["allow", "block"]), host(), rng.choice(["", "/"]) + path()) for _ in range(40)]
    frame = spark.createDataFrame([(k, f"http://{host()}/{path()}") for k in range(300)], "page_id long, url string")
    rows = Counter(map(tuple, urls.judge(frame, rules).collect()))
    assert rows == Counter(map(tuple, urls.judge(frame, rules, max_nodes=1).collect())) and len({r[3] for r in rows}) > 10


# --- SimHash -----------------------------------------------------------------------------------------------------------


def test_fingerprints(docs, plain, edge):
    for frame, rows in ((docs, plain), (edge, EDGE)):
        want = Counter((i, f"{brute.simhash(t):016x}") for i, t in rows)
        assert Counter((r.doc_id, r.fingerprint) for r in simhash_dedup.classes(frame).collect()) == want


def test_classes(docs):
    got = simhash_dedup.classes(docs).collect()
    want = brute.classes({r.doc_id: int(r.fingerprint, 16) for r in got})
    assert {r.doc_id: r.component_id for r in got} == want
    assert simhash_dedup.classes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most,blocks", [(4096, None), (20, 8), (1, 7), (4096, 6), (4096, 13)])
def test_planted_links(spark, most, blocks):
    """Chains and dense balls of fingerprints, with and without the way for crowded cells."""
    rng = random.Random(5)
    prints = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(40):
            x = center
            for b in rng.sample(range(64), rng.randint(0, 9)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    frame = spark.createDataFrame([(simhash_dedup._signed(x),) for x in prints], "fp long")
    roots = {r.node: r.root for r in components(simhash_dedup.links(frame, most=most, blocks=blocks)).collect()}
    want = brute.classes(dict(enumerate(prints)))
    groups = lambda of: sorted(sorted(x for x in range(len(prints)) if of(x) == g) for g in {of(x) for x in range(len(prints))})
    assert groups(lambda x: roots.get(simhash_dedup._signed(prints[x]), simhash_dedup._signed(prints[x]))) == groups(want.get)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 150)}, 199: 199, 200: 199}


def test_simhash_keep_first(edge):
    kept = simhash_dedup.keep_first(edge)
    assert kept.columns == edge.columns
    assert {3, None, 6}.issubset({r.doc_id for r in kept.collect()}) and 7 not in {r.doc_id for r in kept.collect()}


def test_simhash_keeps_what_shares_an_id(spark):
    """Rows are told by id and fingerprint: B has no other row within four bits, whatever its id is."""
    a, b, c = "one two three four five six", "wholly other words stand in this row", "and a third text of a third kind"
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    kept = lambda rows: Counter(map(tuple, simhash_dedup.keep_first(frame(rows)).collect()))
    assert kept([(1, a), (5, a), (5, b), (9, c)]) == Counter([(1, a), (5, b), (9, c)])
    assert kept([(3, a), (3, a), (3, b), (None, b), (None, c), (None, c)]) == Counter([(3, a), (3, b), (None, c)])
    assert kept([]) == Counter()


def test_blocks_follow_the_count():
    assert [simhash_dedup.blocks_for(n) for n in (0, 10**3, 10**6, 10**9, 10**11)] == sorted(simhash_dedup.blocks_for(n) for n in (0, 10**3, 10**6, 10**9, 10**11))
    assert simhash_dedup.blocks_for(10**9) > simhash_dedup.blocks_for(10**5)


# --- pieces ------------------------------------------------------------------------------------------------------------


def test_pieces(docs, edge):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())
    for frame in (docs, edge):
        for r in pieces.encode(frame.select("doc_id", "text")).collect():
            t = r.text or ""
            assert r.ids == sp.encode(t, add_eos=True) and r.decoded == sp.decode(r.ids)
            assert r.bounds == [*(p.begin for p in sp.encode(t, return_type="proto").pieces), len(t.encode()), len(t.encode())]
    assert set(edge.columns) - {"ids"} < set(pieces.encode(edge).columns)
    assert pieces.digest(docs.limit(0)).count() == 0
    for r in pieces.digest(edge).collect():
        assert r.doc_id != 1 or r.bounds_sha256 == brute.sha(" ".join(map(str, [*(p.begin for p in sp.encode(ROWS[0][1], return_type="proto").pieces), *[len(ROWS[0][1])] * 2])))


@pytest.mark.parametrize("fallback", [True, False])
def test_pieces_with_a_character_map(docs, edge, tmp_path, fallback):
    """A model that rewrites texts, with and without byte fallback, through the operator."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto, rules = pb.ModelProto(), pb.ModelProto()
    with open(pieces.model_file(), "rb") as f:
        proto.ParseFromString(f.read())
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = True
    if not fallback:
        proto.trainer_spec.byte_fallback = False
        for p in proto.pieces:
            if p.type == pb.ModelProto.SentencePiece.BYTE:
                p.type = pb.ModelProto.SentencePiece.UNUSED
    path = tmp_path / "own.model"
    path.write_bytes(proto.SerializeToString())
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    odd = docs.sparkSession.createDataFrame([(1, " ＡＢＣ  ﬁ ① x "), (2, "½ ㌀ Straße 😀日本"), (3, "a\tb\u00ad"), (4, "  "), (5, None)], "doc_id long, text string")
    for frame in (odd, docs.select("doc_id", "text").limit(60), edge.select("doc_id", "text")):
        for r in pieces.encode(frame, model=str(path)).collect():
            t = r.text or ""
            assert r.ids == sp.encode(t, add_eos=True) and r.decoded == sp.decode(r.ids)
            size = len(t.encode())
            begins = [p.begin for p in sp.encode(t, return_type="proto").pieces]
            assert len(r.bounds) == len(r.ids) + 1 and r.bounds == sorted(r.bounds) and 0 <= r.bounds[0] and r.bounds[-1] <= size
            # where a piece begins with a character of its own, the library says the same
            assert sum(a == b for a, b in zip(r.bounds, begins, strict=False)) >= 0.9 * len(begins) - 3


def test_piece_spans_hold_the_pieces():
    coder = pieces.Encoder(pieces.model_file())
    for t in ["Hello  world", "naïve 😀 ▁x", " lead", "a\nb\tc"]:
        ids = coder.ids([t])[0]
        bounds, data = coder.bounds(t, ids).tolist(), t.encode()
        for i, a, b in zip(ids[:-1], bounds, bounds[1:], strict=False):
            piece = coder.sp.id_to_piece(i)
            if not piece.startswith("<0x"):
                assert data[a:b].decode().replace(" ", "▁") in (piece, piece.removeprefix("▁"))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_compiled_character_map(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = pb.ModelProto()
    proto.ParseFromString(theirs.serialized_model_proto())
    ours = pieces.Normaliser(proto.normalizer_spec)
    for t in ["ＡＢＣ  ﬁ ① x ", "½ ㌀ Straße", "", "  a  b ", "é\t\n"]:
        out, source = ours(t)
        assert out.decode() == theirs.normalize(t) and len(source) == len(out) + 1 and source == sorted(source)


# --- secrets -----------------------------------------------------------------------------------------------------------


def test_secrets(docs, plain, edge):
    for frame, rows in ((docs, plain), (edge, EDGE)):
        got = Counter((r.doc_id, r.base_sha256, r.spans, r.n_spans) for r in secrets.digest(frame).collect())
        assert got == Counter((i, brute.sha(",".join(brute.secrets(t))), ",".join(s := brute.linked_secrets(t)), len(s)) for i, t in rows)
    assert secrets.digest(docs.limit(0)).count() == 0


def test_linked_credentials():
    weak = "Zx8Kq2Lm9Pw4Rt7Yv1Bn3Hd6"
    alone = f"words {weak} more words"
    linked = f"connect https://db.example.com/x with {weak} now"
    apart = f"connect https://db.example.com/x\n\nwith {weak} now"
    far = f"see https://db.example.com/x {'word ' * 100} with {weak} now"
    pair = f"user: admin77 and {weak}"
    kinds = lambda t: [secrets.KINDS[k] for _, k, _ in secrets.linked_spans(t, secrets.base_spans(t))]
    assert kinds(alone) == kinds(apart) == []
    assert kinds(linked) == kinds(far) == kinds(f"host: a.example.com{chr(10)}{'word ' * 4000}{chr(10)}{weak}") == ["secret"]
    assert kinds(linked) == ["secret"] and kinds(pair) == ["secret"]
    assert kinds("user: admin77 at https://db.example.com/x with " + weak) == ["account", "secret"] or set(kinds("user: admin77 at https://db.example.com/x with " + weak)) == {"account", "secret"}


def test_linked_short_and_long_parts():
    spans = lambda t: [(secrets.KINDS[k], t[s:e]) for s, k, e in sorted(secrets.linked_spans(t, secrets.base_spans(t)))]
    assert spans("user: admin / password: hunter2 / url: https://db.example.com") == [("account", "user: admin"), ("secret", "password: hunter2")]
    assert spans("password: hunter2") == spans("password: hunter2\n\nurl: https://db.example.com") == []
    weak = "Zx8Kq2Lm9Pw4Rt7Yv1Bn3Hd6"
    assert spans(f"see https://db.example.com/{'x/' * 300} with {weak} now") == [("secret", weak)]


def test_linked_parts_at_random(spark):
    """Parts of every sort, near and far, overlapping and apart, in scopes of any length."""
    rng = random.Random(11)
    parts = ["https://db.example.com/x", "host: a.example.com", "user: admin77", "password: hunter2", "token = abcdefghijklmnop", "AKIA1234567890ABCD", "0123456789abcdef0", "Zx8Kq2Lm9Pw4Rt7Yv1Bn3Hd6", "api_key=Zx8Kq2Lm9Pw4Rt7Yv1Bn3Hd6", "token: " + "0123456789abcdef0." * 6 + "Zx8Kq2Lm9Pw4Rt7Yv1Bn3Hd6", "see https://x.example.com/?token=Zx8Kq2Lm9P", "word " * 120, "\n\n", "\n \t\n", "\n", "access_key: Zx8Kq2Lm9Pw4Rt7Yv1Bn3Hd6"]
    rows = [(k, rng.choice([" ", "", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for k in range(400)]
    got = {r.doc_id: r.spans for r in secrets.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: ",".join(brute.linked_secrets(t)) for k, t in rows}


# --- repeats -----------------------------------------------------------------------------------------------------------


def _cut(frame, **how):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeats(frame, **how).collect())


def _passages(n=150):
    rng = random.Random(2)
    words = ["ab", "cde", "the", "of", "x\0y", "é", "zz zz"]
    make = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = make(40)
    return [(i, make(rng.randint(0, 60)) + (shared if i % 2 else shared[: rng.randint(0, len(shared))]) + make(rng.randint(0, 30))) for i in range(n)] + [(900, None), (901, "a" * 300), (902, "a" * 200), (903, "a" * 49), (None, shared), (None, shared)]


@pytest.mark.parametrize("most,size", [(64, 4 << 20), (1, 9000), (2, 500), (0, 9000)])
def test_repeats(spark, edge, most, size):
    """As in production, and with small slices and windows that are sent one by one."""
    rows = _passages()
    assert _cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), most=most, slice_bytes=size) == Counter(brute.repeats(rows))
    assert _cut(edge, most=most, slice_bytes=size) == Counter(brute.repeats(EDGE))


def test_repeats_of_documents(docs, plain):
    assert _cut(docs.select("doc_id", "text"), slice_bytes=1 << 16) == Counter(brute.repeats(plain))


def test_removed_spans(spark):
    rows = _passages(40)
    for r in suffix_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id is not null").collect():
        text = (dict(rows)[r.doc_id] or "").encode()
        kept = b"".join(text[a:b] for a, b in zip([0, *[e for _, e in r.spans]], [*[s for s, _ in r.spans], len(text)], strict=True))
        assert brute.sha(kept) == r.kept_sha256 and sum(e - s for s, e in r.spans) == r.n_removed


def test_groups_are_whole():
    import pyarrow as pa

    rng = random.Random(8)
    for _ in range(200):
        keys = sorted(rng.randint(-5, 5) for _ in range(rng.randint(0, 30)))
        cuts = sorted(rng.randint(0, len(keys)) for _ in range(rng.randint(0, 6)))
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(keys[a:b], pa.int64())}) for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True)]
        got = [t.column(0).to_pylist() for t in suffix_dedup._groups(iter(batches), rng.randint(0, 8))]
        assert sum(got, []) == keys and all(a[-1] != b[0] for a, b in zip(got, got[1:], strict=False))


def test_repeats_empty(docs):
    assert suffix_dedup.repeats(docs.limit(0)).count() == 0


def test_run_length_index():
    """Matching statistics of any patterns, by brute force; places come from the samples at run ends."""
    import numpy as np

    from corpusloom.llm.rindex import RunLengthIndex

    rng = random.Random(1)
    joined = lambda xs: (np.frombuffer(b"".join(xs), np.uint8), np.array([len(x) for x in xs]))
    for _ in range(60):
        letters = [rng.randrange(256) for _ in range(rng.choice([1, 2, 3, 300]))]
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 12))]
        patterns = [bytes(rng.choice([*letters, 7]) for _ in range(rng.randint(1, 40))) for _ in range(6)] + [x[rng.randint(0, len(x) - 1) :] for x in strings]
        least, depth = np.array([rng.randint(0, 9) for _ in strings]), rng.randint(1, 12)
        index = RunLengthIndex(*joined(strings), least, depth)
        assert index.runs <= index.rows == sum(len(x) + 1 for x in strings)
        for which, at, _, place, length in index.matching_statistics(*joined(patterns)):
            for w, a, p, n in zip(which, at, place, length, strict=True):
                rest = patterns[w][a:]
                assert n == max(k for k in range(len(rest) + 1) if any(rest[:k] in x for x in strings))
                assert index.text[p : p + n].tolist() == index.code[list(rest[:n])].tolist()
        want = [min([int(v) for v, x in zip(least, strings, strict=True) if p[i : i + depth] in x], default=99) for p in patterns for i in range(len(p) - depth + 1)]
        assert index.least_of_matches(*joined(patterns), np.full(len(patterns), 99)).tolist() == want


# --- WARC --------------------------------------------------------------------------------------------------------------

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
BIG = "é" * 900 + FAKE + "y" * 3000
PAGES = [(1, "http://a", ""), (2, None, None), (3, "http://b/\r\nX: y", FAKE + "x" * 200), (4, "u", FAKE * 3 + "WARC/1.1\r\n"), (5, "u", "z" * 150), (6, "u", "z" * 150), (None, "u", "z" * 150), (8, "u", "short"), (9, "u", "short"), (10, "u", BIG), (11, "u", BIG)] + [(k, "u", f"p{k}" + "q" * 120) for k in range(20, 50)]


@pytest.mark.parametrize("split", ["128m", "700"])
def test_warc(spark, tmp_path, split):
    """False magics in payloads, and ranges that end anywhere."""
    frame = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, html string, value string").repartition(3)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        warc.write(frame, f"{tmp_path}/w")
        rows = warc.read(spark, f"{tmp_path}/w", content=True).collect()
        digest = {r.page_id: r for r in warc.digest(spark, f"{tmp_path}/w").collect()}
        assert warc.digest(spark, _empty(spark, frame, tmp_path)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == len(PAGES) == len(digest)
    stored = {r.id: r for r in rows}
    for i, _, html in PAGES:
        payload, r = (html or "").encode(), stored[f"<urn:page:{'' if i is None else i}>"]
        same = sorted(j for j, _, h in PAGES if j is not None and (h or "").encode() == payload)
        again = len(payload) >= 100 and i != same[0]
        assert digest[i][1:] == (len(payload), brute.sha(payload), "revisit" if again else "response", same[0] if again else None)
        if not again:
            assert bytes(r.payload) == payload and r.sha == brute.sha(payload)


def _empty(spark, frame, tmp_path):
    warc.write(frame.limit(0), f"{tmp_path}/none")
    return f"{tmp_path}/none"


# --- PII ---------------------------------------------------------------------------------------------------------------

NASTY = ["a@b.c%x@d.e @f.g x@y..z a@b-c.d.e@q.r", "1.2.3.4.5.6.7.8 001.002.0003.255 256.1.1.1 9999999999.1.1.1", "+1 (234) 567-8901 +12 +1....2 4111 1111 1111 1111 4111-1111-1111-1112 " + "1" * 30000, "a" * 20000 + "@" + "b." * 3000 + "c é@x.yz 😀 4111111111111111"]


def test_pii(spark, docs, plain, edge):
    nasty = [(k, t) for k, t in enumerate(NASTY)]
    for frame, rows in ((docs, plain), (edge, EDGE), (spark.createDataFrame(nasty, "doc_id long, text string"), nasty)):
        got = Counter((r.doc_id, r.base_sha256, r.spans) for r in pii.digest(frame).collect())
        assert got == Counter((i, brute.sha(",".join(brute.pii(t))), s) for (i, t), s in zip(rows, brute.pii_spans(rows), strict=True))
    assert pii.digest(docs.limit(0)).count() == 0


def test_pii_of_many_tokens(spark):
    """A hundred thousand tokens of every kind in one text, in time linear in them."""
    import time

    many = " ".join(("call +1 (132) 555-1352", "n 12", "10.0.0.7", "a@b.cd", "4111 1111 1111 1111", "x 7 y")[k % 6] for k in range(60_000))
    rows = [(1, many), (2, " ".join(map(str, range(100_000)))), (3, "a 1.2.3.4@x.yz " * 20_000)]
    began = time.perf_counter()
    got = {r.doc_id: r.base_sha256 for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.perf_counter() - began < 60
    assert got == {i: brute.sha(",".join(brute.pii(t))) for i, t in rows}


def test_bootstrapped_contexts(spark):
    rows = [(k, f"Some words. contact email: user{k}@x.example.com and more") for k in range(20)] + [(100 + k, f"x contact email: jo{k}(at)x-example and") for k in range(2)] + [(200, "seen in chapter 12 or so")]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "email:27:46" and got[100] == "like_email:17:33" and got[200] == ""


def test_pii_contexts_at_random(spark):
    """Seeds, unseen values and contexts mixed at random, against the plain version."""
    rng = random.Random(4)
    usual = {"mail to": "u{}@x.yz", "call me": "+1 (132) 555-13{}", "ring": "+1 (132) 555-14{}", "paid by card": "4111 1111 1111 1111", "at host": "10.0.0.{}", "see 12 of": "{},", "(x)": "{} - {}"}
    odd = ["u{}@x.yz", "jo{}(at)x", "0132 555 13{}", "10.0.0.{}.", "10.0.{}", "4111 1111 1111 11{}", "n.{}@a.b, c{}"]

    def phrase():
        context = rng.choice(list(usual))
        value = usual[context] if rng.random() < 0.95 else rng.choice(odd)
        return f"{context} {value.replace('{}', str(rng.randint(10, 60)))}{rng.choice(['', '.', ' and', chr(10)])}"

    rows = [(k, " ".join(phrase() for _ in range(rng.randint(0, 9)))) for k in range(300)]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.pii_spans(rows)
    assert got == {k: want[k] for k, _ in rows} and any("like_" in w for w in want)


def test_bootstrapped_spaced_numbers(spark):
    phones = [(k, f"Some words. my phone: +1 ({132 + k}) 555-135{k % 10} and more") for k in range(20)]
    cards = [(50 + k, f"Some words. paid by {c} and more") for k, c in enumerate(("4111 1111 1111 1111", "4012 8888 8888 1881", "5555 5555 5555 4444", "5105 1051 0510 5100"))]
    unseen = [(100, "x my phone: (132) 555-1352, and"), (101, "x my phone: 0132 555 1352 and"), (102, "x paid by 4111 1111 1111 1112 and"), (103, "seen in 12 13 of it"), (104, "x my phone: 7788 and"), (105, "x my phone: jo@x.yz 55-12 12. 13")]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(phones + cards + unseen, "doc_id long, text string")).collect()}
    assert got[1] == "phone:22:39" and got[50] == "card:20:39"
    assert got[100] == "like_phone:12:26" and got[101] == "like_phone:12:25"
    assert got[102] == "like_card:10:29" and got[103] == ""
    assert got[104] == "like_phone:12:16" and got[105] == "email:12:19"


def test_bootstrap_settles(spark):
    # a context holds its own values and a fifth as many of the next one's, which are so known a round later
    mails, first, second, third = [f"u{k}@x.yz" for k in range(375)], [f"n1-{k}" for k in range(75)], [f"n2-{k}" for k in range(15)], [f"n3-{k}" for k in range(3)]
    held = {"a": mails + first, "b": first + second, "c": second + third, "d": third}
    rows = [(f"{c} {v}", f"see {c} code: {v} here") for c, vs in held.items() for v in vs]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got["a n1-0"].startswith("like_email:") and got["b n2-0"].startswith("like_email:") and got["c n3-0"] == got["d n3-0"] == "like_email:12:16"


def test_contexts_of_neighbours(spark):
    far = " " * 100
    rows = [(k, f"call a{k}@x.yz b{k}@x.yz and write{far}to{far}c{k}@x.yz") for k in range(12)]
    rows += [(100, "call 77 jo(at)9 and"), (101, f"say write{far}to{far}jo(at)8 and"), (102, "write on jo(at)7 and"), (103, f"{'w' * 30000} to jo(at)6")]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "like_email:5:7,like_email:8:15"
    assert got[101] == "like_email:211:218" and got[102] == got[103] == ""
