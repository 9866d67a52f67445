import random

import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def corpus(spark):
    """(doc_id, text) of the smallest test table, as a dictionary."""
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long and repeated texts, and characters beyond the BMP."""
    return [None, "", " \n\t", "a" * 30000, "word " * 4000, "9" * 5000, "é𝒳Σ İ ſ", "same text here", "same text here", "\x00\x0b\x0c", "a." * 3000 + "@b.c"]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """Odd texts with clashing column names, a null id and a repeated row."""
    rows = [Row(doc_id=i, text=t, n_words=1, kept="x", spans=None, _counts="y", node=2, doc=3, row=4) for i, t in enumerate(odd_texts)]
    rows += [rows[7], Row(doc_id=None, text="no id", n_words=None, kept=None, spans=None, _counts=None, node=None, doc=None, row=None)]
    kinds = "doc_id bigint, text string, n_words int, kept string, spans string, _counts string, node int, doc int, row int"
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
