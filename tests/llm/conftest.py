"""Fixtures of the training-data operators' tests; the session comes from tests/conftest.py."""

import re

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_TO_Z = {i: i + 32 for i in range(65, 91)}


def lower(text):
    return (text or "").translate(A_TO_Z)


def words(text):
    return WORD.findall(lower(text))


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def sf0001_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
