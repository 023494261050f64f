"""Rows that no operator may stumble over."""

from __future__ import annotations

import pytest

LONG = "the quick of brown fox jumps and over lazy dogs in a row " * 3000
ROWS = [
    (1, "The cat of the house and the dog sat in the sun for a long time with us. " * 6, "en", "src1"),
    (2, "the cat  of the house and the dog sat in the sun for a long time with us.\n" * 6, "en", "src1"),
    (3, None, "en", "src2"),
    (4, "", None, "src12"),
    (5, " \t\n\x0b\x0c\r ", "de", None),
    (6, LONG, "en", "src1"),
    (7, LONG, "en", "src1"),
    (7, LONG, "en", "src1"),
    (None, "no id here, but some words of a text with a number 42", "fr", "src3"),
    (None, "no id here, but some words of a text with a number 42", "fr", "src3"),
    (8, "Ünïcödé ﬁ \u2581 😀 \u0085 \u00a0 x\u0000y", "xx", "src9"),
    (9, "token = abcdefghijklmnop AKIA1234567890ABCD 0123456789abcdef0 mail a@b.co 1.2.3.4 4111 1111 1111 1111 +1 (234) 567-8901", "es", "src3"),
    (10, "one", "en", "src1"),
    (11, "x" * 70 + " y", "en", "src1"),
    (12, "z" + "x" * 70 + " w", "en", "src14"),
]
CLASH = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest string, ids string, whole string, spans string, row string, fp string, value string, n_words string, base string, `out` string, slice string"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), *["c"] * 12) for r in ROWS], CLASH).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
