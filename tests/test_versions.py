"""Versioned embeddings: what is read back is what the last input held."""

import pytest
from pyspark.sql import functions as F

from textmill.operators import embed as EM
from textmill.operators.versions import compact, current, events, generation, sync_embeddings

SCHEMA = "document_id string, page_number int, chunk_index int, content string"


def chunks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(df):
    return sorted((r["document_id"], r["page_number"], r["chunk_index"], r["content"]) for r in df.collect())


def counts(report):
    return report.first().asDict()


FIRST = [("a", 1, 0, "alpha beta"), ("a", 1, 1, "gamma"), ("b", 1, 0, "delta"), ("c", 2, 0, "same text")]
SECOND = [("a", 1, 0, "alpha changed"), ("b", 1, 0, "delta"), ("c", 2, 0, "same text"), ("d", 1, 0, "new")]


def test_change_delete_add(spark, tmp_path):
    path = str(tmp_path / "t")
    assert generation(spark, path) is None and current(spark, path) is None
    rows, report = sync_embeddings(chunks(spark, FIRST), path)
    assert held(rows) == sorted(FIRST) and counts(report) == {"embedded": 4, "closed": 0, "rejected": 0, "unchanged": 0}
    rows, report = sync_embeddings(chunks(spark, SECOND), path)
    assert held(rows) == sorted(SECOND) and counts(report) == {"embedded": 2, "closed": 1, "rejected": 0, "unchanged": 2}
    rows, report = sync_embeddings(chunks(spark, SECOND), path)
    assert held(rows) == sorted(SECOND) and counts(report) == {"embedded": 0, "closed": 0, "rejected": 0, "unchanged": 4}
    # text that comes back, and a position closed and opened again
    rows, _ = sync_embeddings(chunks(spark, FIRST), path)
    assert held(rows) == sorted(FIRST)
    assert rows.filter(F.size("embedding") != 64).count() == 0
    before = events(spark, path).count()
    folder = compact(spark, path)
    assert generation(spark, path) == folder and held(current(spark, path)) == sorted(FIRST)
    assert events(spark, path).count() == 4 < before
    rows, report = sync_embeddings(chunks(spark, SECOND), path)
    assert held(rows) == sorted(SECOND) and counts(report)["embedded"] == 2


def test_scope_of_some_documents(spark, tmp_path):
    path = str(tmp_path / "t")
    sync_embeddings(chunks(spark, FIRST), path)
    rows, report = sync_embeddings(chunks(spark, [("a", 1, 0, "only this")]), path, scope="document_id")
    assert held(rows) == sorted([("a", 1, 0, "only this"), *FIRST[2:]])
    assert counts(report) == {"embedded": 1, "closed": 1, "rejected": 0, "unchanged": 0}


def test_failed_embedding_closes_the_old_text(spark, tmp_path):
    def provider(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("down")
        return [[1.0, 2.0]] * len(texts)

    path = str(tmp_path / "t")
    EM.register_provider("moody", provider)
    try:
        sync_embeddings(chunks(spark, FIRST), path, provider="moody")
        rows, report = sync_embeddings(chunks(spark, [("a", 1, 0, "bad text"), *FIRST[1:]]), path, provider="moody")
        assert held(rows) == sorted(FIRST[1:]) and counts(report)["rejected"] == 1
    finally:
        EM._PROVIDERS.pop("moody")
    rows, report = sync_embeddings(chunks(spark, [("a", 1, 0, "bad text"), *FIRST[1:]]), path)
    assert held(rows) == sorted([("a", 1, 0, "bad text"), *FIRST[1:]]) and counts(report)["embedded"] == 1


def test_crashes_leave_a_readable_table(spark, tmp_path):
    """A compaction that died leaves its folder unread; rows of half a run are completed."""
    path = tmp_path / "t"
    sync_embeddings(chunks(spark, FIRST), str(path))
    (path / "building-dead").mkdir()
    (path / "generation-000007").mkdir()  # never finished: no _SUCCESS
    assert held(current(spark, str(path))) == sorted(FIRST)
    half = events(spark, str(path)).filter("document_id = 'b'").withColumn("version", F.lit(2).cast("long")).withColumn(
        "content", F.lit("half")).withColumn("content_hash", F.sha2(F.lit("half"), 256))
    half.write.mode("append").parquet(generation(spark, str(path)))
    rows, _ = sync_embeddings(chunks(spark, SECOND), str(path))
    assert held(rows) == sorted(SECOND)


def test_models_repeats_and_empty_inputs(spark, tmp_path):
    path = str(tmp_path / "t")
    rows, _ = sync_embeddings(chunks(spark, []), path)
    assert rows.count() == 0
    with pytest.raises(FileNotFoundError):
        compact(spark, str(tmp_path / "none"))
    twice = [("a", 1, 0, "x"), ("a", 1, 0, "x"), ("a", 1, 0, "y")]
    rows, report = sync_embeddings(chunks(spark, twice), path)
    assert rows.count() == 1 and counts(report)["embedded"] == 1
    rows, report = sync_embeddings(chunks(spark, twice), path, model="another")
    assert counts(report)["embedded"] == 1 and [r["embedding_model"] for r in rows.collect()] == ["another"]
    rows, report = sync_embeddings(chunks(spark, []), path, model="another")
    assert rows.count() == 0 and counts(report)["closed"] == 1


def exchanges(df):
    import io
    from contextlib import redirect_stdout
    with redirect_stdout(io.StringIO()) as plan:
        df.explain()
    return plan.getvalue().count("Exchange")


def test_texts_stay_where_they_are(spark, tmp_path):
    """Texts and vectors were shuffled to find each position's last event, also where
    every position had one row; now only positions and versions move."""
    path = str(tmp_path / "t")
    sync_embeddings(chunks(spark, FIRST), path)
    sync_embeddings(chunks(spark, SECOND), path)
    assert held(current(spark, path)) == sorted(SECOND)
    folder = compact(spark, path)
    assert exchanges(current(spark, path)) == 0 and held(current(spark, path)) == sorted(SECOND)
    sync_embeddings(chunks(spark, FIRST), path)  # appends: the compacted mark goes
    assert generation(spark, path) == folder and held(current(spark, path)) == sorted(FIRST)
    # two runs that wrote the same version: one row a position is left
    twice = events(spark, path).filter("alive and version = 3").withColumn("event", F.concat(F.lit("~"), "event"))
    assert twice.count() > 0
    twice.write.mode("append").parquet(folder)
    assert held(current(spark, path)) == sorted(FIRST)
    sync_embeddings(chunks(spark, []), path)
    assert current(spark, path).count() == 0
