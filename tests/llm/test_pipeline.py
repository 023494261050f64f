"""The registered queries, their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

from collections import Counter

import pytest

from corpusloom.llm import mixing, quality
from corpusloom.llm.queries import ORACLE_SQL, QUERIES

from ..oracle import connect, rows_of, rows_of_sql
from . import brute


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    got = rows_of(QUERIES[name](spark, data))
    assert got[1]
    if name in ORACLE_SQL:
        assert got == rows_of_sql(connect(data), ORACLE_SQL[name])


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 11)]


def test_pipeline(spark, data):
    import sentencepiece

    import corpus_pipeline
    from corpusloom.llm import pieces

    assert len(corpus_pipeline.STAGES) == 5
    rows = {r.doc_id: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    good = {r.doc_id for r in quality.judge(spark.read.parquet(f"{data}/documents.parquet")).filter("kept").collect()}
    plain = [(i, rows[i].text) for i in sorted(good)]
    unique = {keep for keep, _, _ in brute.exact(plain).values()}
    classes = brute.classes({i: brute.simhash(rows[i].text) for i in unique})
    left = [i for i in sorted(unique) if classes[i] == i]
    mix = mixing.Mix()
    taken = brute.mix([(i, rows[i].text, rows[i].lang, rows[i].source) for i in left], mix.domains, mix.langs, mix.percent, mix.epochs, mix.seed)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())

    def coded(i):
        ids = sp.encode(rows[i].text, add_eos=True)
        return i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(sp.decode(ids))

    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, data).collect())
    assert got == Counter(coded(i) for i, _ in taken)


def test_stages_take_clashing_columns(spark, edge):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge, "").columns == corpus_pipeline.COLUMNS, name
