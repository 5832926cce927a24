"""Byte-pair windows against a second tokenizer library and a plain slicing of its ids."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from tables import SF_SMALL
from textmill.functions.text import collapse_runs
from textmill.operators.bpe import Vocabulary, bpe_windows, given_vocabulary, window_ranges
from textmill.operators.chunking import chunk_pages
from textmill.sources.documents import scan_pages


@pytest.fixture(scope="module")
def other():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True  # their strings are ordinary text here
    return t


@pytest.fixture(scope="module")
def token_bytes():
    import base64
    return {int(r): base64.b64decode(t) for t, r in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}


def windows(ids, token_bytes, size, overlap):
    """(index, token count, first byte, last byte, text) by slicing the ids."""
    out, step = [], size - overlap
    for i, s in enumerate(range(0, len(ids), step)):
        part = ids[s:s + size]
        at = sum(len(token_bytes[x]) for x in ids[:s])
        data = b"".join(token_bytes[x] for x in part)
        out.append((i, len(part), at, at + len(data), data.decode("utf-8", errors="replace")))
    return out


TEXTS = ["", None, "one", "naïve 日本語 🙂🙂 test " * 9, "<|endoftext|> a<|endoftext|>", "a" * 3000, "\x00nul\x00 " * 20,
         "line\nbreaks\n\n and  runs\t", "🙂" * 50]


@pytest.mark.parametrize("size,overlap", [(7, 2), (1, 0), (600, 50)])
def test_windows_of_odd_texts(spark, other, token_bytes, size, overlap):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "k int, text string, note string").repartition(3)
    got = bpe_windows(df, given_vocabulary(), size, overlap, with_ids=True).collect()
    for i, t in enumerate(TEXTS):
        ids = other.encode(t or "", add_special_tokens=False).ids
        mine = sorted((r for r in got if r.k == i), key=lambda r: r.chunk_index)
        assert [(r.chunk_index, r.token_count, r.byte_start, r.byte_end, r.content) for r in mine] == windows(ids, token_bytes, size, overlap)
        step = size - overlap
        assert [r.token_ids for r in mine] == [ids[s:s + size] for s in range(0, len(ids), step)]
        assert all(r.note == "x" for r in mine)


def test_window_ends_inside_a_character(spark):
    """Windows of one token cut 🙂 into its byte tokens: replaced in the text, exact in the range."""
    df = spark.createDataFrame([(1, "🙂🙂")], "k int, text string")
    got = sorted(bpe_windows(df, given_vocabulary(), 1, 0).collect(), key=lambda r: r.chunk_index)
    assert any("�" in r.content for r in got)
    assert [r.byte_start for r in got] == [0, *[r.byte_end for r in got[:-1]]] and got[-1].byte_end == 8


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 300), st.integers(1, 60), st.integers(0, 59))
def test_ranges_cover_all_tokens(n, size, overlap):
    if overlap >= size:
        return
    a, b = window_ranges(n, size, overlap)
    assert sorted({t for s, e in zip(a, b) for t in range(s, e)}) == list(range(n))
    a, b = window_ranges(n, size, overlap, drop_contained_tail=True)
    assert sorted({t for s, e in zip(a, b) for t in range(s, e)}) == list(range(n))


def test_arguments(spark):
    df = spark.createDataFrame([(1, "x", 0)], "k int, text string, Token_Count int")
    with pytest.raises(ValueError, match="names"):
        bpe_windows(df, given_vocabulary(), 5, 1)
    with pytest.raises(ValueError, match="exceed"):
        bpe_windows(df.drop("Token_Count"), given_vocabulary(), 5, 5)
    with pytest.raises(ValueError, match="at most"):
        Vocabulary(b"x" * ((64 << 20) + 1))
    with pytest.raises(ValueError, match="vocabulary"):
        chunk_pages(df.select(F.lit("d").alias("document_id"), F.lit(1).alias("page_number"), "text"), mode="bpe")


def test_query_counts_the_library_s_tokens(spark, other, token_bytes):
    """All windows of all documents, text by text, and the tagged chunk table."""
    import hashlib
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pages = scan_pages(docs, "doc_id", "text", delimiter="\f").withColumn("text", collapse_runs("text")).collect()
    want = []
    for p in pages:
        ids = other.encode(p.text, add_special_tokens=False).ids
        want += [(p.document_id, p.page_number, i, n, s, e, hashlib.md5(t.encode()).hexdigest())
                 for i, n, s, e, t in windows(ids, token_bytes, 600, 50)]
    got = E.queries()["chunk_windows_bpe"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    tagged = chunk_pages(scan_pages(docs, "doc_id", "text", delimiter="\f"), mode="bpe", vocabulary=given_vocabulary())
    assert tagged.columns[-2:] == ["section_title", "system_category"]
    assert tagged.agg(F.sum("token_count")).first()[0] == sum(w[3] for w in want)
