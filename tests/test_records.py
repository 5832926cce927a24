"""Timestamp parsing, sentinels, vectors, k rule, canonical text, upsert."""

from pyspark.sql import functions as F

from textmill.functions.records import iso_or_null, iso_timestamp, null_if_na
from textmill.functions.vectors import l2_normalize
from textmill.operators import summary as SM
from textmill.operators.sinks import number_rows, upsert
from textmill.sources.tables import read_cluster_rows


def test_timestamp_cases(spark):
    cases = [("12/31/70 10:00", "1970-12-31T10:00:00"), ("12/31/68 1:00", "2068-12-31T01:00:00"),
             (" 1/2/24  3:4 ", "2024-01-02T03:04:00"), ("1/2/2024 3:04:05", None),
             ("2/30/24 1:00", None), ("1/2/24 3:04:60", None), ("1/ 2/24 3:04", "2024-01-02T03:04:00"),
             ("N/A", None), (" na ", None), ("", None), (None, None), ("01/02/2024 13:05", "2024-01-02T13:05:00")]
    df = spark.createDataFrame([(a,) for a, _ in cases], "s string")
    got = [r[0] for r in df.select(iso_timestamp(iso_or_null("s"))).collect()]
    assert got == [b for _, b in cases]


def test_null_sentinel(spark):
    df = spark.createDataFrame([("N/A",), (" Na ",), ("",), ("ok",)], "s string")
    assert [r[0] for r in df.select(null_if_na("s")).collect()] == [None, None, None, "ok"]


def test_l2(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r[0] for r in df.select(l2_normalize("v")).collect()]
    assert [round(x, 6) for x in got[0]] == [0.6, 0.8] and got[1] == [0.0, 0.0]


def test_k_rule():
    assert [SM.kmeans_k(n) for n in (5, 29, 30, 89, 90, 9000, 100000)] == [5, 10, 2, 2, 3, 300, 300]
    assert SM.kmeans_k(5, clamp=False) == 10


def test_canonical(spark):
    rows = [(0, 0, "  LONG text here"), (0, 1, "Oil   Leak"), (0, 2, "oil")]
    rows += [(1, i, f"long example number {i}") for i in range(10)] + [(1, 10, "x")]
    rows += [(2, 0, "   "), (2, 1, "")]
    df = spark.createDataFrame(rows, "cluster_label int, pos int, text string")
    got = {r.cluster_label: r.canonical for r in SM.canonical_text(df).collect()}
    assert got == {0: "oil", 1: "long example number 0", 2: "noisy placeholder"}


def test_examples_and_rank(spark):
    rows = [(1, 0, "a"), (2, 1, "b"), (2, 2, "c"), (1, 3, "d"), (-1, 4, "n"), (3, 5, "e")]
    df = spark.createDataFrame(rows, "cluster_label int, pos int, text string")
    r = [(x.cluster_label, x.frequency, x.rank) for x in SM.rank_clusters(df).orderBy("rank").collect()]
    assert r == [(1, 2, 1), (2, 2, 2), (3, 1, 3)]
    st = SM.label_stats(df).first()
    assert (st.n_clusters, st.n_noise) == (3, 1)


def test_upsert_idempotent(spark):
    tgt = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, frequency long, rank int")
    src = spark.createDataFrame([("b", 5, 1), ("c", 3, 2), ("c", 9, 3)], "k string, frequency long, rank int")
    once = upsert(tgt, src, "k")
    twice = upsert(once, src, "k")
    rows = sorted(tuple(r) for r in twice.collect())
    assert rows == sorted(tuple(r) for r in once.collect()) == [("a", 1, 1), ("b", 5, 1), ("c", 3, 2)]


def test_limit_before_filter(spark):
    rows = [("1", "x", [1.0]), ("2", "", [1.0]), ("3", "y", [1.0]), ("4", "z", [1.0])]
    df = spark.createDataFrame(rows, "id string, text string, embedding array<float>")
    assert [r.id for r in read_cluster_rows(df, limit=3).orderBy("id").collect()] == ["1", "3"]


def test_number_rows_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    got = number_rows(df, ["k"]).select("k", "row_index")
    bad = got.filter(F.col("row_index") != F.col("k")).count()
    assert bad == 0 and got.count() == 5000


def test_chunk_json_array_files(spark, tmp_path):
    """Reference layout: a folder of files that each hold one JSON array;
    other suffixes are skipped, absent keys read as null."""
    import json
    from textmill.sources.files import read_chunks_json
    (tmp_path / "a.json").write_text(json.dumps([{"content": "x", "page_number": 1, "token_count": 3},
                                                 {"content": "é", "page_number": 2}]))
    (tmp_path / "b.JSON").write_text(json.dumps([{"content": "y", "page_number": 7, "token_count": 1}]))
    (tmp_path / "notes.txt").write_text("ignored")
    rows = sorted((r.content, r.page_number, r.token_count)
                  for r in read_chunks_json(spark, str(tmp_path)).collect())
    assert rows == [("x", 1, 3), ("y", 7, 1), ("é", 2, None)]


def test_canonical_from_model(spark):
    df = spark.createDataFrame([(0, 0, "Oil leak"), (0, 1, "oil  leaking")], "cluster_label int, pos int, text string")
    prompts = SM.canonical_prompt(df)
    assert "\n- Oil leak\n- oil  leaking\n" in prompts.first().prompt
    out = SM.canonical_from_model(prompts, lambda s: ["  Engine oil\n leak  " for _ in s]).first()
    assert out.canonical == "Engine oil leak"


def test_rank_all_clusters_distributed(spark):
    rows = [(c, i * 10 + c, "t") for c in range(30) for i in range(c % 7 + 1)]
    df = spark.createDataFrame(rows, "cluster_label int, pos int, text string")
    a = [(r.cluster_label, r.rank) for r in SM.rank_clusters(df, top=None).orderBy("rank").collect()]
    b = [(r.cluster_label, r.rank) for r in SM.rank_clusters(df, top=200).orderBy("rank").collect()]
    assert a == b and len(a) == 30


def test_embed_records_reads_its_input_once(spark, tmp_path):
    """Each text's rejects were split off and joined again: four reads of the records."""
    import io
    from contextlib import redirect_stdout
    from textmill.operators.records import embed_records
    from textmill.schemas import RECORD
    names = [f for f in RECORD.fields if not f.name.endswith("_vector")]
    rows = [("1", "Pump leak", "seal"), ("2", None, "seal"), ("3", "", None), ("3", "", None)]
    df = spark.createDataFrame(rows, "discrepancy_id string, issue string, corrective_action string")
    df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in names]).write.parquet(str(tmp_path / "r"))
    out = embed_records(spark.read.parquet(str(tmp_path / "r")))
    with redirect_stdout(io.StringIO()) as plan:
        out.explain()
    assert plan.getvalue().count("FileScan") == 1
    got = sorted((r["discrepancy_id"], r["issue_embedding_vector"] and sum(x > 0 for x in r["issue_embedding_vector"]),
                  r["corrective_embedding_vector"] and len(r["corrective_embedding_vector"])) for r in out.collect())
    assert [g[0] for g in got] == ["1", "2", "3", "3"] and got[0][1:] == (2, 64) and got[1][1:] == (None, 64)
    assert got[2][1:] == got[3][1:] == (0, None) and [f.name for f in out.schema.fields] == [f.name for f in RECORD.fields]


def test_norm_is_taken_once_a_vector(spark):
    """The norm stood inside the loop over components: once for each of them."""
    df = spark.createDataFrame([([float(i % 7) for i in range(64)],), ([0.0] * 64,), (None,)], "v array<float>")
    plan = df.select(l2_normalize("v").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    got = [r[0] for r in df.select(l2_normalize("v")).collect()]
    assert abs(sum(x * x for x in got[0]) - 1) < 1e-6 and got[1] == [0.0] * 64 and got[2] is None
