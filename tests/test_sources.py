"""File discovery, tokenizer modes and window options."""

import pytest
from pyspark.sql import functions as F

from textmill.functions.text import tokens
from textmill.operators.chunking import chunk_pages
from textmill.operators.pages import page_parts
from textmill.sources.documents import discover_documents


def test_discover_suffix_any_case_non_recursive(spark, tmp_path):
    for name in ("b.pdf", "a.PDF", "c.txt"):
        (tmp_path / name).write_bytes(b"%PDF-1.4 x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.pdf").write_bytes(b"x")
    got = sorted(r.document_id for r in discover_documents(spark, str(tmp_path)).collect())
    assert got == ["a.PDF", "b.pdf"]
    one = discover_documents(spark, str(tmp_path / "b.pdf")).collect()
    assert [r.document_id for r in one] == ["b.pdf"]
    with pytest.raises(FileNotFoundError):
        discover_documents(spark, str(tmp_path / "sub" / "none"), suffix=".pdf")


def test_drop_contained_tail(spark):
    text = " ".join(f"w{i}" for i in range(560))   # windows 0-599 and 550-559 (inside the first)
    pages = spark.createDataFrame([("d", 1, text)], "document_id string, page_number int, text string")
    assert chunk_pages(pages, tag=False).count() == 2
    assert chunk_pages(pages, tag=False, drop_contained_tail=True).count() == 1
    text = " ".join(f"w{i}" for i in range(700))   # tail 550-699 reaches past the first window
    pages = spark.createDataFrame([("d", 1, text)], "document_id string, page_number int, text string")
    assert chunk_pages(pages, tag=False, drop_contained_tail=True).count() == 2


def test_pretoken_mode_lossless(spark):
    s = "Hello, world's 12345 tokens\n  ok"
    got = spark.createDataFrame([(s,)], "s string").select(tokens("s", "pretoken").alias("t")).first().t
    assert "".join(got) == s
    assert "123" in got and "45" in got


def test_page_parts(spark):
    pages = spark.createDataFrame([("m", p) for p in range(1, 251)], "document_id string, page_number int")
    got = sorted((r.part_name, r.pages) for r in page_parts(pages).collect())
    assert got == [("m_pages_1-100", 100), ("m_pages_101-200", 100), ("m_pages_201-250", 50)]


def test_insert_batches_and_part_folders(spark, tmp_path):
    from textmill.operators.sinks import insert_batches, write_page_parts
    df = spark.range(0, 230).select(F.col("id").alias("k"), (F.col("id") == 120).alias("bad"))
    rep = insert_batches(df, ["k"], str(tmp_path / "t"), size=50, failed=F.col("bad"))
    r = sorted(tuple(x) for x in rep.collect())
    assert r == [(0, 50, 50, 0), (1, 50, 50, 0), (2, 50, 0, 50), (3, 50, 50, 0), (4, 30, 30, 0)]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 180
    pages = spark.createDataFrame([("m", p, "x") for p in range(1, 151)], "document_id string, page_number int, text string")
    out = write_page_parts(pages, str(tmp_path / "p"))
    back = spark.read.parquet(out)
    assert sorted((r.part, r["count"]) for r in back.groupBy("part").count().collect()) == [(0, 100), (1, 50)]


def test_embed_incremental(spark, tmp_path):
    from textmill.operators.embed import embed_incremental
    pages = spark.createDataFrame([("d1", 1, "alpha beta gamma " * 300), ("d2", 1, "delta epsilon")],
                                  "document_id string, page_number int, text string")
    chunks = chunk_pages(pages, tag=False)
    n = chunks.count()
    path = str(tmp_path / "emb")
    t1, _ = embed_incremental(chunks, path)
    assert t1.count() == n
    t2, _ = embed_incremental(chunks, path)
    assert t2.count() == n                       # nothing new
    changed = chunk_pages(pages.withColumn("text", F.concat("text", F.lit(" omega"))), tag=False)
    t3, _ = embed_incremental(changed, path)
    assert t3.count() > n                        # changed tails embedded again
