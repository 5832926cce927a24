"""Writes that can be repeated: bucketed merges, resumable inserts, observed counters."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from textmill.operators.issues import refresh_issues
from textmill.operators.keyed import clean_keyed, layout, merge_keyed, read_keyed
from textmill.operators.loads import insert_resumable
from textmill.operators.pages import observed_chunks


def held(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs}


def table(spark, rows, schema="k string, v int, w string"):
    return spark.createDataFrame(rows, schema)


def test_merge_touches_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_keyed(spark, path) is None and merge_keyed(table(spark, []), path, "k") == []
    first = [(f"k{i}", i, "x") for i in range(200)]
    assert len(merge_keyed(table(spark, first), path, "k", buckets=16)) == 16
    before, old = files(path), layout(spark, path)[1]
    touched = merge_keyed(table(spark, [("k7", 70, "y"), ("new", 1, "z")]), path, "k")
    assert 1 <= len(touched) <= 2
    now = files(path)
    assert all(now[f] == t for f, t in before.items())  # nothing moved or rewritten
    n, after = layout(spark, path)
    assert n == 16 and {b for b in after if after[b] != old[b]} == set(touched)
    want = [r for r in first if r[0] != "k7"] + [("k7", 70, "y"), ("new", 1, "z")]
    assert held(read_keyed(spark, path)) == sorted(want, key=repr)
    assert clean_keyed(spark, path) == len(touched)
    assert held(read_keyed(spark, path)) == sorted(want, key=repr)


def test_merge_nulls_types_unsent_and_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_keyed(table(spark, [(None, 1, "a"), ("b", 2, None), ("c", 3, "c")]), path, "k", order="v", buckets=4)
    # a long for an int, no column w, a null key, a key twice
    again = spark.createDataFrame([(None, 5), ("b", 6), ("b", 7), ("d", 8)], "k string, v long")
    for _ in range(2):
        merge_keyed(again, path, "k", order="v")
        assert held(read_keyed(spark, path)) == sorted([(None, 5, "a"), ("b", 6, None), ("c", 3, "c"), ("d", 8, None)], key=repr)
    assert read_keyed(spark, path).schema["v"].dataType.typeName() == "integer"
    with pytest.raises(ValueError, match="no columns"):
        merge_keyed(table(spark, [("a", 1)], "k string, extra int"), path, "k")


def test_dead_merge_leaves_the_table_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_keyed(table(spark, [(f"k{i}", i, "x") for i in range(20)]), path, "k", buckets=4)
    want = held(read_keyed(spark, path))
    root = os.path.join(path, "buckets-4")
    # one died while it wrote, one was moved without its mark of success
    shutil.copytree(os.path.join(root, "merge-000001"), os.path.join(root, "building-dead"))
    shutil.copytree(os.path.join(root, "merge-000001"), os.path.join(root, "merge-000002"))
    os.remove(os.path.join(root, "merge-000002", "_SUCCESS"))
    assert held(read_keyed(spark, path)) == want
    merge_keyed(table(spark, [("k3", 33, "y")]), path, "k")
    assert os.path.isdir(os.path.join(root, "merge-000003"))
    assert held(read_keyed(spark, path)) == sorted([r for r in want if r[0] != "k3"] + [("k3", 33, "y")], key=repr)


def report(df):
    return {r["batch"]: (r["rows"], r["ok"], r["failed"], r["present"]) for r in df.collect()}


def test_insert_appends_what_is_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i // 3, None if i % 4 else f"t{i}", "x") for i in range(25)]  # ties in the order, nulls
    df = spark.createDataFrame(rows, "k int, t string, w string")
    assert report(insert_resumable(df.limit(0), ["k"], path, "none", size=10)) == {}
    first = report(insert_resumable(df, ["k"], path, "a", size=10, failed=F.col("k") == 4))
    assert first == {0: (10, 10, 0, 0), 1: (10, 0, 10, 0), 2: (5, 5, 0, 0)}
    # the same rows in another order and partitioning are the same load
    again = df.orderBy(F.rand(1)).repartition(3)
    assert report(insert_resumable(again, ["k"], path, "a", size=10)) == {0: (10, 0, 0, 10), 1: (10, 10, 0, 0), 2: (5, 0, 0, 5)}
    assert report(insert_resumable(df, ["k"], path, "a", size=10)) == {b: (n, 0, 0, n) for b, n in ((0, 10), (1, 10), (2, 5))}
    assert held(spark.read.parquet(path).select("k", "t", "w")) == sorted(rows, key=repr)
    # a batch lies in one file
    where = spark.read.parquet(path).select("batch", F.input_file_name().alias("f")).distinct()
    assert where.count() == 3
    # another load appends; other rows under a known name are refused
    insert_resumable(df, ["k"], path, "b", size=10)
    assert spark.read.parquet(path).count() == 50
    for other in (df.filter("k <> 2"), df.limit(10), df.withColumn("w", F.lit("y"))):
        with pytest.raises(ValueError, match="not a batch of this input"):
            insert_resumable(other, ["k"], path, "a", size=10)
    assert spark.read.parquet(path).count() == 50
    with pytest.raises(ValueError, match="own"):
        insert_resumable(df.withColumn("batch", F.lit(1)), ["k"], path, "a")


def test_observed_totals_need_no_second_pass(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def size(t):
        calls.add(1)
        return len(t)

    pages = spark.createDataFrame([("a", "one two"), ("b", "three")], "document_id string, text string").repartition(2)
    out, seen, made = observed_chunks(pages, lambda p: p.withColumn("token_count", size("text")), name="probe")
    out.write.parquet(str(tmp_path / "c"))
    assert seen.get == {"pages": 2, "longest_page": 7} and made.get == {"chunks": 2, "tokens": 12}
    assert calls.value == 2
    none, seen, made = observed_chunks(pages.limit(0), lambda p: p.withColumn("token_count", size("text")), name="none")
    none.write.parquet(str(tmp_path / "n"))
    assert seen.get == {"pages": 0, "longest_page": None} and made.get == {"chunks": 0, "tokens": 0}


def test_issue_texts_stay_out_of_the_clustering(spark, tmp_path, monkeypatch):
    """Texts went through every sort and join of the clustering.  Blank first rows are
    examples, but no phrase; a cluster of blanks has the placeholder."""
    from textmill.operators import issues as I
    seen, real = [], I.cluster

    def spy(df, *a, **kw):
        seen.extend(df.columns)
        return real(df, *a, **kw)
    monkeypatch.setattr(I, "cluster", spy)
    texts = [" "] * 12 + [f"Leak at valve number {i:02d}" for i in range(11)] + ["Leak"] + [" \t"] * 20
    rows = [(i % 3, i, t, [float(i >= 24) * 9, i * 0.001]) for i, t in enumerate(texts)]  # ids repeat
    df = spark.createDataFrame(rows, "id long, pos long, text string, embedding array<float>")
    got = refresh_issues(df, str(tmp_path / "t"), method="density").select("canonical_squawk", "frequency", "rank", "sample_examples")
    assert held(got) == [("leak at valve number 00", 24, 1, [" "] * 5), ("noisy placeholder", 20, 2, [" \t"] * 5)]
    assert "text" not in seen and "embedding" in seen


def test_issue_run_keeps_earlier_issues(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, i, f"Leak  at valve {i % 2}" if i < 30 else f"Cracked lens {i}", [float(i >= 30) * 9, i * 0.001]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, pos long, text string, embedding array<float>")
    t = refresh_issues(df, path, method="density")
    assert held(t.select("canonical_squawk", "frequency")) == [("cracked lens 30", 30), ("leak at valve 0", 30)]
    # a later run over other rows, by the other method
    later = df.filter("pos >= 30").withColumn("text", F.concat(F.lit("Worn tyre "), F.col("pos").cast("string")))
    t = refresh_issues(later, path, method="kmeans", k=2).select("canonical_squawk", "frequency")
    worn = t.filter(F.col("canonical_squawk").startswith("worn tyre"))
    assert held(t.join(worn, "canonical_squawk", "left_anti").select("canonical_squawk", "frequency")) == [
        ("cracked lens 30", 30), ("leak at valve 0", 30)]
    assert sorted(r["frequency"] for r in worn.collect()) == [15, 15]
