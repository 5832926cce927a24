"""Token counts and prefix tables against the tokenizers library."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmill.llm import token_counts as TC
from textmill.llm.prefix_tokens import counter


@pytest.fixture(scope="module")
def library(vocabulary):
    t = Tokenizer.from_file(vocabulary)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t'abcdlrsvetmé日🎉19.,!|<>endoftx\x1c\xa0")), max_size=40))
def test_every_prefix(vocabulary_path, text):
    c, lib = counter(vocabulary_path[0]), vocabulary_path[1]
    assert c.table(text).tolist() == [lib(text[:i + 1]) for i in range(len(text))]


@pytest.fixture(scope="module")
def vocabulary_path(vocabulary, library):
    return vocabulary, library


def test_budgets(vocabulary, library):
    rng = random.Random(3)
    c = counter(vocabulary)
    for _ in range(30):
        text = "".join(rng.choice([" ", "  ", "word", "'ll", "\n", "éa", "<|endoftext|>", "12", "x!"]) for _ in range(30))
        for budget in (0, 1, 5, 17, 200):
            n, fit = c.count_and_fit([text], budget)[0]
            assert n == library(text)
            assert fit == max((i for i in range(len(text) + 1) if (library(text[:i]) if i else 0) <= budget))


def test_documents(spark, documents, vocabulary, library):
    got = TC.count_tokens(documents, vocabulary).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in got:
        n = library(texts[r["doc_id"]])
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 512, len(texts[r["doc_id"]].encode()))
    assert len(got) == len(texts)


def test_edges(edge, nothing, vocabulary, library):
    got = TC.count_tokens(edge, vocabulary).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["n_tokens"], by[1]["n_bytes"], by[2]["n_tokens"]) == (0, 0, 0)
    assert by[6]["n_tokens"] == library("it's they'll <|endoftext|> naïve 日本語  \n x")
    assert TC.count_tokens(nothing, vocabulary).collect() == []


def test_stored_tables(spark, edge, vocabulary, library):
    docs = edge.where("doc_id in (4, 6, 8)")
    tables = TC.prefix_tables(docs, vocabulary, segment=64).cache()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ask = [(d, n) for d, t in texts.items() for n in (1, 5, len(t)) if n <= len(t)]
    got = TC.tokens_of_prefix(tables, spark.createDataFrame(ask, "doc_id long, n_chars int"), segment=64).collect()
    assert len(got) == len(ask)
    assert all(r["n_tokens"] == library(texts[r["doc_id"]][:r["n_chars"]]) for r in got)
    fit = {r["doc_id"]: r["fit_chars"] for r in TC.fitting_prefix(tables, 20, segment=64).collect()}
    for d, t in texts.items():
        assert fit[d] == max(i for i in range(1, len(t) + 1) if library(t[:i]) <= 20)
    tables.unpersist()
    assert docs.select(F.max(F.length("text"))).first()[0] > 64  # more than one segment
