"""Literal edge cases of the string, title, window and category operators."""

import math
import re

from pyspark.sql import functions as F

from textmill.functions import tagging
from textmill.functions.frontmatter import is_front_matter, split_list
from textmill.functions.text import (collapse_all, collapse_runs, drop_nul, first_nonempty,
                                     output_name, py_strip, section_title, slug, tokens)
from textmill.operators.chunking import chunk_pages


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_strip_matches_python(spark):
    s = "\x1c \n\tabc\n \x85"
    assert one(spark, py_strip("s"), s) == s.strip() == "abc"


def test_collapse_keeps_single_newline(spark):
    s = "a\xa0\xa0b \n c\nd"
    assert one(spark, collapse_runs("s"), s) == "a b c\nd"
    assert one(spark, collapse_all("s"), "a \n\n b") == "a b"


def test_drop_nul(spark):
    assert one(spark, drop_nul("s"), "a\x00b\x00") == "ab"


def test_word_tokens_lossless(spark):
    s = "Alpha  beta\ngamma delta"
    toks = one(spark, tokens("s"), s)
    assert "".join(toks) == s and len(toks) == 4


def test_section_title_cases(spark):
    assert one(spark, section_title("s"), "Chapter 5 Hydraulic Power\nbody text") == "Hydraulic Power"
    assert one(spark, section_title("s"), "lower only") == "Unknown Section"
    assert one(spark, section_title("s"), "intro line\n 12-3 Fuel Tank") == "Fuel Tank"


def _windows(spark, n):
    text = " ".join(f"w{i}" for i in range(n))
    pages = spark.createDataFrame([("d", 1, text)], "document_id string, page_number int, text string")
    return chunk_pages(pages, tag=False).orderBy("chunk_index").collect()


def test_window_counts(spark):
    for n, expect in [(0, 0), (1, 1), (550, 1), (551, 2), (560, 2), (600, 2), (1101, 3)]:
        rows = _windows(spark, n)
        assert len(rows) == expect, n
        assert len(rows) == math.ceil(n / 550)
    rows = _windows(spark, 560)
    assert [r.token_count for r in rows] == [560, 10]


def test_windows_rebuild_page(spark):
    n = 1300
    rows = _windows(spark, n)
    toks = []
    for i, r in enumerate(rows):
        parts = r.content.split(" ")
        parts = [p for p in parts if p]
        toks.extend(parts if i == 0 else parts[50:])
    assert toks == [f"w{i}" for i in range(n)]


def _label(spark, body, title=None):
    df = spark.createDataFrame([(body, title)], "b string, t string")
    return tagging.with_categories(df, "b", "t" if title is not None else None).first()["system_category"]


def test_category_rules(spark):
    assert _label(spark, "one servo here") == "General"          # 1.5 < 2.0
    assert _label(spark, "the engine runs") == "Powerplant"      # 2.0 reaches the threshold
    assert _label(spark, "electric motor") == "General"          # 'electric' alone matches nothing
    assert _label(spark, "landing gear and hydraulic") == "Hydraulic"  # tie: declared first
    assert _label(spark, "x", "Fuel System") == "Fuel System"   # title counts three times


def test_category_topk_general_is_array(spark):
    df = tagging.score_frame(spark.createDataFrame([("nothing",)], "b string"), "b")
    assert df.select(tagging.category_topk(3).alias("k")).first()["k"] == ["General"]


def test_front_matter(spark):
    assert one(spark, is_front_matter("s"), "") is True
    assert one(spark, is_front_matter("s"), "call the telephone desk") is True
    long = "call the telephone desk " + "x" * 240
    assert one(spark, is_front_matter("s"), long) is False


def test_first_nonempty_zero(spark):
    df = spark.createDataFrame([(0, 3, 7)], "a int, b int, c int")
    assert df.select(first_nonempty("a", "b", "c", zero_is_missing=True).alias("r")).first()["r"] == 3


def test_split_list_and_slugs(spark):
    assert one(spark, split_list("s"), "Header, Footer,,") == ["Header", "Footer"]
    assert one(spark, slug("s"), "BAAI/bge-base-en-v1.5") == "baai_bge_base_en_v1_5"
    assert one(spark, output_name("s"), "/a/b/Manual.v2.PDF") == "Manual.v2.chunks.json"


def test_split_tokens_equal_extracted_tokens(spark):
    """Both word tokenisers agree on stripped text (Unicode blanks included)."""
    import random
    from textmill.functions.text import word_tokens, word_tokens_stripped
    rnd = random.Random(5)
    alphabet = ["a", "b", "é", "1", ".", " ", "\n", "\xa0", " ", "\x1c", "\t"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))).strip() for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select(word_tokens("s").alias("a"), word_tokens_stripped("s").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_word_windows_are_cut_without_a_regex_a_character(spark):
    """The JVM's split by look-around took most of a load's time; windows are cut in Arrow
    batches, with the blanks of Python and pieces that join back to the text."""
    import io
    from contextlib import redirect_stdout
    text = " a\x1cb c \n d\x85e\x00fé \U0001F600g　h " * 3
    pages = spark.createDataFrame([(1, 1, text), (2, 1, None), (3, 1, " \n ")], "document_id long, page_number int, text string")
    chunks = chunk_pages(pages, size=5, overlap=2, tag=False, cleanup=False)
    with redirect_stdout(io.StringIO()) as plan:
        chunks.explain()
    assert "split(" not in plan.getvalue() and "MapInArrow" in plan.getvalue()
    words = re.findall(r"\S+\s*", re.sub(r"\s{2,}", " ", text).strip())
    want = [(1, i, "".join(words[s:s + 5]), len(words[s:s + 5])) for i, s in enumerate(range(0, len(words), 3))]
    got = [tuple(r) for r in chunks.orderBy("chunk_index").select("document_id", "chunk_index", "content", "token_count").collect()]
    assert got == want
    clean = chunk_pages(pages, size=5, overlap=2, tag=False).orderBy("chunk_index")
    assert [r["content"] for r in clean.collect()] == [w[2].replace("\x00", "") for w in want]
