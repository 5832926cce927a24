"""Nothing is lost: numbering, inserts, upserts, readers and the embedding hook."""

import pytest
from pyspark.sql import functions as F

from textmill.functions.records import iso_or_null, iso_timestamp
from textmill.functions.vectors import cosine
from textmill.operators import embed as EM
from textmill.operators.records import embed_records, map_records
from textmill.operators.sinks import insert_batches, number_rows, upsert, write_document_json, write_json, write_upsert
from textmill.schemas import RECORD, RECORD_HEADERS
from textmill.sources.files import read_chunks_json, read_records_csv


@pytest.mark.parametrize("partitions,adaptive", [("8", "true"), ("200", "true"), ("8", "false"), ("200", "false")])
def test_number_rows_of_wide_rows(spark, partitions, adaptive):
    n = 2_000_000
    df = spark.range(0, n, 1, 16).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        got = number_rows(df, ["k"]).agg(F.count(F.lit(1)), F.count_if(F.col("row_index") != F.col("k")),
                                         F.count_distinct("row_index")).first()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert tuple(got) == (n, 0, n)


@pytest.mark.parametrize("n", [0, 1, 50_000])
def test_insert_stores_what_it_reports(spark, tmp_path, n):
    df = spark.range(0, n, 1, 16).select((F.col("id") * 7919 % max(n, 1)).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("w"))
    report = insert_batches(df, ["k"], str(tmp_path / "t"), failed=F.col("k") == 70)
    r = report.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("ok"), F.lit(0))).first()
    assert r[0] == n and r[1] == max(n - (50 if n > 70 else 0), 0)
    assert spark.read.parquet(str(tmp_path / "t")).select("k").distinct().count() == r[1]


def test_upsert_touches_only_sent_columns(spark, tmp_path):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, n int, created string")
    source = spark.createDataFrame([("a", 5, 1), ("c", 7, 2)], "k string, n int, rank int").select("k", "n", "rank")
    want = [("a", 5, "old"), ("b", 2, "old"), ("c", 7, None)]
    merged = upsert(target, source, "k")
    assert sorted(tuple(r) for r in merged.select("k", "n", "created").collect()) == want
    path = str(tmp_path / "table")
    target.write.parquet(path)
    for _ in range(2):  # swapped in place; a second run changes nothing
        assert write_upsert(spark, path, source, "k", path) == path
        assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "n", "created").collect()) == want
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["table"]


def test_json_reader_reads_what_the_writer_wrote(spark, tmp_path):
    df = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("content"), F.col("id").cast("int").alias("page_number"))
    path = write_json(df.repartition(2), str(tmp_path / "lines"))
    assert read_chunks_json(spark, path).count() == 1000
    with pytest.raises(ValueError, match="lines"):
        read_chunks_json(spark, path, layout="array")


def test_one_name_per_document(spark, tmp_path):
    rows = [(f"d{i % 30}.v2", 1, i // 30, "x") for i in range(90)]
    c = spark.createDataFrame(rows, "document_id string, page_number int, chunk_index int, content string")
    back = spark.read.json(write_document_json(c, str(tmp_path / "j"), buckets=4))
    by = {r["file_name"]: r["n"] for r in back.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(by) == 30 and set(by.values()) == {3} and "d0.chunks.json" in by
    assert back.select("file_name", "bucket").distinct().count() == 30


def test_csv_goes_by_header_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Issue,Extra,Discrepancy ID,Logged on\n"two\nlines",x,1,12/31/70 10:00\n')
    (tmp_path / "b.csv").write_text("Discrepancy ID,Issue\n2,plain\n")
    got = read_records_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert got.columns == RECORD_HEADERS
    rows = sorted(got.select("`Discrepancy ID`", "Issue", "`Logged on`", "Aircraft").collect())
    assert [tuple(r) for r in rows] == [("1", "two\nlines", "12/31/70 10:00", None), ("2", "plain", None, None)]


def test_record_has_both_vectors(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Discrepancy ID,Issue,Corrective action\n1,leak at pump,\n2,,replaced\n")
    rec = embed_records(map_records(read_records_csv(spark, str(tmp_path / "a.csv"))))
    assert rec.columns == RECORD.fieldNames() and len(rec.columns) == 19
    got = {r["discrepancy_id"]: r for r in rec.collect()}
    assert len(got["1"]["issue_embedding_vector"]) == 64 and got["1"]["corrective_embedding_vector"] is None
    assert got["2"]["issue_embedding_vector"] is None and len(got["2"]["corrective_embedding_vector"]) == 64


def test_cosine_of_a_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([2.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(cosine("a", "b")).collect()] == [None, 1.0]


def test_year_zero_is_no_timestamp(spark):
    df = spark.createDataFrame([("1/2/0000 3:04",), ("1/2/0001 3:04",)], "s string")
    assert [r[0] for r in df.select(iso_timestamp(iso_or_null("s"))).collect()] == [None, "0001-01-02T03:04:00"]


def test_provider_runs_once_and_failing_rows_are_rejected(spark, tmp_path):
    log = str(tmp_path / "calls")

    def provider(texts):
        with open(log, "a") as f:
            f.write("".join(f"{t}\n" for t in texts))
        if any(t == "bad" for t in texts):
            raise RuntimeError("one row fails")
        return [[1.0, float(len(t))] for t in texts]

    EM.register_provider("logging", provider)
    try:
        df = spark.createDataFrame([(i, "bad" if i == 7 else f"text {i}") for i in range(100)], "i int, content string")
        ok, rejects = EM.embed(df, "content", provider="logging", normalize=False)
        assert ok.count() == 99 and [r["i"] for r in rejects.collect()] == [7]
    finally:
        EM._PROVIDERS.pop("logging")
    calls = open(log).read().splitlines()
    # once for each row; the rows of the one batch that failed were tried one by one
    assert len(calls) <= 2 * 100 and sum(c.startswith("text 1") for c in set(calls)) == 11


def test_tokens_are_stripped_of_any_white_space(spark):
    df = spark.createDataFrame([(1, "fuel\n"), (2, "fuel ")], "i int, content string")
    ok, _ = EM.embed(df, "content")
    a, b = (r["embedding"] for r in ok.orderBy("i").collect())
    assert a == b


def test_incremental_embedding_needs_its_key_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    c = spark.createDataFrame([("d", 1, 0, "x")], "document_id string, page_number int, chunk_index int, content string")
    EM.embed_incremental(c, path)
    spark.read.parquet(path).drop("content_hash").write.parquet(path + "-old")
    with pytest.raises(Exception, match="content_hash"):
        EM.embed_incremental(c, path + "-old")
    assert spark.read.parquet(path + "-old").count() == 1
