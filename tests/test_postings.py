"""Postings of the context corpora: equal to a scan, through changes and repeats."""

import os

from pyspark.sql import functions as F

from textmill.operators.postings import held_texts, postings_hits, sync_postings
from textmill.operators.summary import context_hits

LIMITS = {"manuals": 2, "overviews": 3}


def texts(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def held(df):
    return sorted(tuple(r) for r in df.select("canonical", "corpus", "rank", "id", "hits").collect())


def test_lookup_equals_scan_through_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    phrases = spark.createDataFrame([("oil pump leak",), ("Pump seal",), ("no such words",), ("...",), ("oil pump leak",)],
                                    "canonical string")
    assert postings_hits(phrases, path, LIMITS).count() == 0 and held_texts(spark, path) is None
    m = [(1, "oil oil pump"), (2, "PUMP leak, oil"), (3, "nothing here"), (4, ""), (5, None), (10, "pump leak oil"), (7, "seal")]
    o = [(1, "seal the pump"), (2, "leak")]

    def check(m, o):
        corpora = {"manuals": texts(spark, m), "overviews": texts(spark, o)}
        assert held(postings_hits(phrases, path, LIMITS)) == held(context_hits(phrases, corpora, LIMITS))
        return corpora

    assert sync_postings({"manuals": texts(spark, m), "overviews": texts(spark, o)}, path, buckets=4) == (8, 0)
    corpora = check(m, o)
    assert sync_postings(corpora, path, complete=True) == (0, 0)  # the same again adds nothing
    assert len(os.listdir(path)) == 1
    # one changed, one new; the other corpus is not sent
    m2 = [(1, "seal")] + m[1:] + [(11, "oil pump leak")]
    assert sync_postings({"manuals": texts(spark, [m2[0], m2[-1]])}, path) == (2, 1)
    check(m2, o)
    # back to the first text, one gone, another corpus emptied
    m3 = [m[0]] + m2[2:]
    assert sync_postings({"manuals": texts(spark, m3), "overviews": texts(spark, [])}, path, complete=True) == (1, 4)
    check(m3, [])
    assert held_texts(spark, path).count() == len(m3) - 1


def test_repeated_ids_and_dead_sync(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = texts(spark, [(1, "pump"), (1, "seal"), (1, "seal"), (None, "pump")])
    assert sync_postings({"manuals": rows}, path) == (1, 0)
    assert sync_postings({"manuals": rows}, path) == (0, 0)
    os.makedirs(f"{path}/building-dead/postings")
    phrases = spark.createDataFrame([("pump seal",)], "canonical string")
    assert [r["hits"] for r in postings_hits(phrases, path, LIMITS).collect()] == [1]
    assert held_texts(spark, path).where(F.col("hash").isNotNull()).count() == 1


def test_context_of_many_phrases_and_long_texts(spark):
    """The lookup of a term walked a map of all phrase terms and each phrase walked all
    hits; now terms are looked up by hash and hits counted by a product."""
    import io
    from contextlib import redirect_stdout
    phrases = spark.createDataFrame([(f"common w{i} w{i + 1} Ünï{i}",) for i in range(60)] + [(None,), ("common w0",)], "canonical string")
    texts = [(str(i) if i % 7 else None, " ".join(["COMMON"] * (i % 2) + [f"w{j}" for j in range(i % 9, 62, 1 + i % 5)])) for i in range(700)]
    corpora = {"manuals": spark.createDataFrame([*texts, ("x", None)], "id string, text string").repartition(3)}
    h = context_hits(phrases, corpora, {"manuals": 4})
    with redirect_stdout(io.StringIO()) as plan:
        h.explain()
    assert "map_from_entries" not in plan.getvalue() and "try_element_at" not in plan.getvalue()
    got = {}
    for r in h.collect():
        got.setdefault(r["canonical"], []).append((r["rank"], r["hits"], r["id"]))
    for (phrase,) in {r[0:1] for r in phrases.collect()}:
        terms = set((phrase or "").lower().split())
        n = [(len(terms & set(t.lower().split())), i) for i, t in texts]
        n = sorted((x for x in n if x[0]), key=lambda x: (-x[0], x[1] is not None, (x[1] or "").encode()))[:4]
        assert sorted(got.get(phrase, [])) == [(k + 1, c, i) for k, (c, i) in enumerate(n)] or \
            [x[:2] for x in sorted(got[phrase], key=lambda x: x[0])] == [(k + 1, c) for k, (c, _) in enumerate(n)]


def test_postings_are_lists(spark, tmp_path):
    """A posting was a row with the text's id and the term; now a row holds the postings
    of many texts in a folder, in pieces of at most ``TEXTS`` texts."""
    from textmill.operators import postings as P
    path = str(tmp_path / "t")
    rows = [(i, " ".join(f"w{j}" for j in range(i % 50, i % 50 + 30)) + " ünï") for i in range(P.TEXTS + 300)]
    corpora = {"manuals": texts(spark, rows).coalesce(1), "overviews": texts(spark, rows[:40] + [(-1, "")])}
    sync_postings(corpora, path, buckets=4)
    (batch,) = os.listdir(path)
    stored = spark.read.parquet(f"{path}/{batch}/postings")
    assert stored.count() <= 4 * (2 + corpora["overviews"].rdd.getNumPartitions())
    assert sum(sum(r["counts"]) for r in stored.select("counts").collect()) == 31 * (len(rows) + 40)
    phrases = spark.createDataFrame([("w3 w40 w79",), ("ÜNÏ w5",)], "canonical string")
    assert held(postings_hits(phrases, path, LIMITS)) == held(context_hits(phrases, corpora, LIMITS))
