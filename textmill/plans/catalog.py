"""The registered queries: one per operator family, each over whole tables.

Every entry is ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` holds the DuckDB
SQL that states the same result independently.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textmill.functions import tagging
from textmill.functions.text import (collapse_runs, drop_nul, section_title,
                                     word_tokens)
from textmill.operators.bpe import bpe_windows, given_vocabulary
from textmill.operators.chunking import CHUNK_OVERLAP, CHUNK_SIZE, chunk_pages
from textmill.operators.pages import page_stats as _page_stats
from textmill.plans import fixtures as FX
from textmill.plans import sqlparts as S
from textmill.session import spread
from textmill.sources.documents import (documents_without_pages, dropped_pages,
                                        scan_pages)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _long(c):
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


def _docs(spark, sf):
    return FX.documents(spark, sf).select("doc_id", "text")


NL = "\n"
FF = "\f"

# ---------------------------------------------------------------- M1 pages


@register("page_scan", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(10)')}
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(page_number AS BIGINT) AS page_number,
       CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS md5
FROM pages""")
def q_page_scan(spark, sf):
    p = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=NL)
    return p.select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"),
                    _long(F.length("text")).alias("n_chars"), F.md5("text").alias("md5"))


@register("sparse_pages", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(10)')}
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(page_number AS BIGINT) AS page_number
FROM raw_pages WHERE length({S.strip('raw')}) <= 50 AND (page_number - 1) % 50 = 0""")
def q_sparse_pages(spark, sf):
    d = dropped_pages(_docs(spark, sf), "doc_id", "text", delimiter=NL, every=50)
    return d.select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"))


@register("docs_without_pages", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(10)')}
SELECT CAST(doc_id AS BIGINT) AS document_id FROM documents
WHERE doc_id NOT IN (SELECT document_id FROM pages)""")
def q_docs_without_pages(spark, sf):
    docs = _docs(spark, sf)
    pages = scan_pages(docs, "doc_id", "text", delimiter=NL)
    return documents_without_pages(docs, pages, "doc_id").select(_long("document_id").alias("document_id"))


@register("normalize_text", f"""
SELECT CAST(doc_id AS BIGINT) AS document_id, md5({S.collapse('text')}) AS md5 FROM documents""")
def q_normalize_text(spark, sf):
    return _docs(spark, sf).select(_long("doc_id").alias("document_id"),
                                   F.md5(collapse_runs("text")).alias("md5"))


NUL_INJECT = "concat(char(0), replace(text, ' a ', concat(' a', char(0), ' ')), char(0))"


@register("strip_nul", f"""
SELECT CAST(doc_id AS BIGINT) AS document_id,
       CAST(length(replace(concat(chr(0), replace(text, ' a ', concat(' a', chr(0), ' ')), chr(0)), chr(0), '')) AS BIGINT) AS n_chars,
       md5(replace(concat(chr(0), replace(text, ' a ', concat(' a', chr(0), ' ')), chr(0)), chr(0), '')) AS md5
FROM documents""")
def q_strip_nul(spark, sf):
    d = _docs(spark, sf).select("doc_id", F.expr(NUL_INJECT).alias("t"))
    clean = drop_nul("t")
    return d.select(_long("doc_id").alias("document_id"), _long(F.length(clean)).alias("n_chars"),
                    F.md5(clean).alias("md5"))


@register("page_stats", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(10)')}, {S.chunks_cte(tagged=False)},
p AS (SELECT document_id, count(*) AS pages FROM pages GROUP BY document_id),
c AS (SELECT document_id, count(*) AS chunks, sum(token_count) AS tokens FROM chunks GROUP BY document_id)
SELECT CAST(p.document_id AS BIGINT) AS document_id, CAST(pages AS BIGINT) AS pages,
       CAST(coalesce(chunks, 0) AS BIGINT) AS chunks, CAST(coalesce(tokens, 0) AS BIGINT) AS tokens
FROM p LEFT JOIN c ON p.document_id = c.document_id""")
def q_page_stats(spark, sf):
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=NL)
    chunks = chunk_pages(pages, tag=False)
    return _page_stats(pages, chunks).withColumn("document_id", _long("document_id"))


# ---------------------------------------------------------------- M2 chunks


@register("tokenize_words", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')},
t AS (SELECT document_id, {S.word_tokens(S.collapse('text'))} AS toks FROM pages)
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(len(toks) AS BIGINT) AS n_tokens,
       md5(array_to_string(toks, '')) AS md5 FROM t""")
def q_tokenize_words(spark, sf):
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    t = pages.select("document_id", word_tokens(collapse_runs("text")).alias("toks"))
    return t.select(_long("document_id").alias("document_id"), _long(F.size("toks")).alias("n_tokens"),
                    F.md5(F.array_join("toks", "")).alias("md5"))


@register("chunk_windows", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)}
SELECT CAST(document_id AS BIGINT) AS document_id, chunk_index, token_count, md5(content) AS md5
FROM chunks""")
def q_chunk_windows(spark, sf):
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    c = chunk_pages(pages, tag=False)
    return c.select(_long("document_id").alias("document_id"), _long("chunk_index").alias("chunk_index"),
                    _long("token_count").alias("token_count"), F.md5("content").alias("md5"))


@register("chunk_windows_bpe")
def q_chunk_windows_bpe(spark, sf):
    """Windows of 600 byte-pair tokens, 50 shared, over whole documents; a tokenizer
    has no SQL form, the tests hold it against another library."""
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    c = bpe_windows(pages.withColumn("text", collapse_runs("text")), given_vocabulary(), CHUNK_SIZE, CHUNK_OVERLAP)
    return c.select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"),
                    _long("chunk_index").alias("chunk_index"), _long("token_count").alias("token_count"),
                    "byte_start", "byte_end", F.md5("content").alias("md5"))


@register("section_titles", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)}
SELECT CAST(document_id AS BIGINT) AS document_id, chunk_index, {S.title('content')} AS section_title
FROM chunks""")
def q_section_titles(spark, sf):
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    c = chunk_pages(pages, tag=False)
    return c.select(_long("document_id").alias("document_id"), _long("chunk_index").alias("chunk_index"),
                    section_title("content").alias("section_title"))


VOCAB_SQL = f"(SELECT doc_id, {FX.vocab_text_sql()} AS text, lang FROM documents)"


def chunk_documents(spark, sf):
    """Flagship: vocabulary documents -> pages -> windows -> title -> category
    -> chunks and tokens per category."""
    pages = scan_pages(FX.vocab_documents(spark, sf), "doc_id", "text", delimiter=FF)
    c = chunk_pages(pages, tag=True, constants={"aircraft_model": "DA42"})
    return (c.groupBy(F.col("system_category").alias("category"))
            .agg(F.count(F.lit(1)).alias("chunks"), F.sum("token_count").cast("long").alias("tokens")))


register("chunk_documents", f"""
WITH {S.pages_cte(VOCAB_SQL, 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=True)}
SELECT system_category AS category, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS tokens
FROM tagged GROUP BY system_category""")(chunk_documents)

# ---------------------------------------------------------------- M3 categories

SCORE_COLS = [tagging.score_column_name(n) for n in tagging.CATEGORIES]


def _vocab_scored(spark, sf):
    d = spread(FX.vocab_documents(spark, sf))
    return tagging.score_frame(d, "text", keep=["doc_id"])


@register("category_scores", f"""
WITH s AS (SELECT doc_id, {', '.join(S.score_exprs('text'))} FROM {VOCAB_SQL})
SELECT CAST(doc_id AS BIGINT) AS document_id, {', '.join(f'round({c}, 6) AS {c}' for c in SCORE_COLS)} FROM s""")
def q_category_scores(spark, sf):
    s = _vocab_scored(spark, sf)
    return s.select(_long("doc_id").alias("document_id"), *[F.round(c, 6).alias(c) for c in SCORE_COLS])


@register("category_label", f"""
WITH s AS (SELECT doc_id, {', '.join(S.score_exprs('text'))} FROM {VOCAB_SQL})
SELECT CAST(doc_id AS BIGINT) AS document_id, {S.label_expr()} AS category FROM s""")
def q_category_label(spark, sf):
    s = _vocab_scored(spark, sf)
    return s.select(_long("doc_id").alias("document_id"), tagging.category_label().alias("category"))


def _topk_sql(k: int) -> str:
    cols = SCORE_COLS
    structs = ", ".join(f"{{'score': {c}, 'neg_rank': {-i}, 'name': {S.q(n)}}}"
                        for i, (c, n) in enumerate(zip(cols, tagging.CATEGORIES)))
    best = f"greatest({', '.join(cols)})"
    ranked = f"list_reverse(list_sort([{structs}]))"
    return (f"CASE WHEN {best} < 2.0 THEN 'General' ELSE "
            f"array_to_string(list_transform(list_slice({ranked}, 1, {k}), lambda x: x.name), ',') END")


@register("category_topk", f"""
WITH s AS (SELECT doc_id, {', '.join(S.score_exprs('text'))} FROM {VOCAB_SQL})
SELECT CAST(doc_id AS BIGINT) AS document_id, {_topk_sql(3)} AS categories FROM s""")
def q_category_topk(spark, sf):
    s = _vocab_scored(spark, sf)
    return s.select(_long("doc_id").alias("document_id"),
                    F.array_join(tagging.category_topk(3), ",").alias("categories"))

# ---------------------------------------------------------------- M4 front matter
from textmill.functions.frontmatter import is_front_matter  # noqa: E402
from textmill.operators.frontmatter import (exclude_elements as _exclude,  # noqa: E402
                                            preview as _preview, resolved_fields,
                                            skip_front_matter)

FOREIGN_SQL = ("(SELECT conv_id * 1000 + turn AS id, conv_id AS document_id, turn AS pos, "
               + ", ".join(f"{v} AS {k}" for k, v in FX.FOREIGN_SQL.items()) + " FROM conversations)")
FRONT_SQL = f"(SELECT conv_id AS document_id, turn AS pos, role, {FX.FRONT_TEXT_SQL} AS content FROM conversations)"
_TXT = S.first_nonempty("content", "text", "''")
_PAGE = S.first_nonempty("page_number", "page", "page_index", zero=True)
_TITLE = S.first_nonempty("section_title", "title", "section")
_TYPE = S.first_nonempty("element_type", "type")


@register("field_fallback", f"""
SELECT CAST(id AS BIGINT) AS id, {S.strip(_TXT)} AS text, CAST({_PAGE} AS BIGINT) AS page,
       {_TITLE} AS title, {_TYPE} AS type FROM {FOREIGN_SQL}""")
def q_field_fallback(spark, sf):
    r = resolved_fields(FX.foreign_chunks(spark, sf))
    return r.select(_long("id").alias("id"), F.col("_text").alias("text"), _long("_page").alias("page"),
                    F.col("_title").alias("title"), F.col("_type").alias("type"))


@register("front_matter_flag", f"""
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(pos AS BIGINT) AS pos,
       {S.front_matter('content')} AS flag FROM {FRONT_SQL}""")
def q_front_matter_flag(spark, sf):
    c = FX.front_chunks(spark, sf)
    return c.select(_long("document_id").alias("document_id"), _long("pos").alias("pos"),
                    is_front_matter("content").alias("flag"))


@register("front_matter_skip", f"""
WITH c AS {FRONT_SQL},
s AS (SELECT document_id, coalesce(min(CASE WHEN {S.starts_content('content')} THEN pos END), min(pos)) AS start
      FROM c GROUP BY document_id)
SELECT CAST(c.document_id AS BIGINT) AS document_id, CAST(pos AS BIGINT) AS pos, CAST(start AS BIGINT) AS start
FROM c JOIN s ON c.document_id = s.document_id WHERE pos >= start""")
def q_front_matter_skip(spark, sf):
    k = skip_front_matter(FX.front_chunks(spark, sf))
    return k.select(_long("document_id").alias("document_id"), _long("pos").alias("pos"),
                    _long("start").alias("start"))


@register("chunk_preview", f"""
WITH c AS {FOREIGN_SQL},
s AS (SELECT document_id, coalesce(min(CASE WHEN {S.starts_content(_TXT)} THEN pos END), min(pos)) AS start
      FROM c GROUP BY document_id),
v AS (SELECT c.*, row_number() OVER (PARTITION BY c.document_id ORDER BY pos) AS rn
      FROM c JOIN s ON c.document_id = s.document_id WHERE pos >= start),
p AS (SELECT *, substring({S.collapse_all(S.strip(_TXT))}, 1, 800) AS pv FROM v WHERE rn <= 6)
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(pos AS BIGINT) AS pos,
       CAST({_PAGE} AS BIGINT) AS page, {_TITLE} AS title, {_TYPE} AS type,
       CASE WHEN pv = '' THEN '(empty)' ELSE pv END AS preview FROM p""")
def q_chunk_preview(spark, sf):
    p = _preview(FX.foreign_chunks(spark, sf), n=6, width=800, skip=True)
    return p.select(_long("document_id").alias("document_id"), _long("pos").alias("pos"),
                    _long("page").alias("page"), "title", "type", "preview")


@register("exclude_elements", f"""
SELECT CAST(id AS BIGINT) AS id, element_type FROM {FOREIGN_SQL}
WHERE element_type IS NULL OR element_type NOT IN ('Header', 'Footer')""")
def q_exclude_elements(spark, sf):
    e = _exclude(FX.foreign_chunks(spark, sf), "Header, Footer,")
    return e.select(_long("id").alias("id"), "element_type")

# ---------------------------------------------------------------- M5 records, files, names
from textmill.functions.records import iso_or_null, iso_timestamp, null_if_na  # noqa: E402
from textmill.functions.text import output_name, path_slug, slug  # noqa: E402
from textmill.operators.records import cluster_input, embed_records, map_records  # noqa: E402
from textmill.session import cut_lineage, scratch_path  # noqa: E402
from textmill.sources.files import read_chunks_json, read_records_csv  # noqa: E402

_FT = FX.ftime_sql("event_id")


def _sql_iso(raw: str) -> str:
    t = f"trim({raw})"
    parsed = (f"coalesce(try_strptime({t}, '%m/%d/%y %H:%M'), try_strptime({t}, '%m/%d/%Y %H:%M'), "
              f"try_strptime({t}, '%m/%d/%y %H:%M:%S'))")
    return (f"CASE WHEN {raw} IS NULL OR {raw} = '' OR lower({t}) IN ('n/a', 'na') THEN NULL "
            f"ELSE strftime({parsed}, '%Y-%m-%dT%H:%M:%S') END")


@register("null_sentinel", f"""
SELECT CAST(event_id AS BIGINT) AS event_id,
       CASE WHEN raw IS NULL OR raw = '' OR lower(trim(raw)) IN ('n/a', 'na') THEN NULL ELSE raw END AS value
FROM (SELECT event_id, {_FT} AS raw FROM events)""")
def q_null_sentinel(spark, sf):
    t = FX.time_strings(spark, sf)
    return t.select(_long("event_id").alias("event_id"), null_if_na("raw").alias("value"))


@register("timestamp_parse", f"""
SELECT CAST(event_id AS BIGINT) AS event_id, {_sql_iso('raw')} AS iso
FROM (SELECT event_id, {_FT} AS raw FROM events)""")
def q_timestamp_parse(spark, sf):
    t = FX.time_strings(spark, sf)
    return t.select(_long("event_id").alias("event_id"), iso_timestamp(iso_or_null("raw")).alias("iso"))


_CSV = FX.csv_columns("duckdb")
RECORD_COLS = ["discrepancy_id", "org", "tail_number", "aircraft_type", "aircraft", "aircraft_serial",
               "logged_on", "issue", "corrective_action", "status", "mel_category", "mel_location",
               "mel_company", "signoff_by", "signoff_on", "signoff_license", "work_completed_on"]


@register("csv_records", f"""
WITH r AS (SELECT {', '.join(f'{v} AS "{k}"' for k, v in _CSV.items())} FROM events)
SELECT "Discrepancy ID" AS discrepancy_id, 'squawk' AS org, "Aircraft" AS tail_number,
       "Aircraft Serial" AS aircraft_type, "Aircraft" AS aircraft, "Aircraft Serial" AS aircraft_serial,
       {_sql_iso('"Logged on"')} AS logged_on, {S.strip('"Issue"')} AS issue,
       {S.strip('"Corrective action"')} AS corrective_action, "Status" AS status,
       "MEL category" AS mel_category, "MEL location" AS mel_location, "MEL company" AS mel_company,
       "Sign-off by" AS signoff_by, {_sql_iso('"Sign-off on"')} AS signoff_on,
       "Sign-off license" AS signoff_license, {_sql_iso('"Work completed on"')} AS work_completed_on
FROM r""")
def q_csv_records(spark, sf):
    path = FX.write_records_csv(spark, sf, scratch_path(spark, "records-csv"))
    rec = map_records(read_records_csv(spark, path))
    return rec.select(*[iso_timestamp(c).alias(c) if c in ("logged_on", "signoff_on", "work_completed_on")
                        else F.col(c) for c in RECORD_COLS])


@register("json_roundtrip", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)}
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(page_number AS BIGINT) AS page_number,
       chunk_index, token_count, md5(content) AS md5 FROM chunks""")
def q_json_roundtrip(spark, sf):
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    c = chunk_pages(pages, tag=False)
    from textmill.operators.sinks import write_json
    path = write_json(c, scratch_path(spark, "chunks-json"))
    back = read_chunks_json(spark, path)
    return back.select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"),
                       _long("chunk_index").alias("chunk_index"), _long("token_count").alias("token_count"),
                       F.md5("content").alias("md5"))


@register("json_arrays", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)}
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(page_number AS BIGINT) AS page_number,
       chunk_index, token_count, md5(content) AS md5 FROM chunks""")
def q_json_arrays(spark, sf):
    """The chunk table as array files, read back in parallel ranges of them."""
    from textmill.operators.sinks import write_json_array
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    path = write_json_array(chunk_pages(pages, tag=False), scratch_path(spark, "chunks-arrays"))
    back = read_chunks_json(spark, path, layout="array")
    return back.select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"),
                       _long("chunk_index").alias("chunk_index"), _long("token_count").alias("token_count"),
                       F.md5("content").alias("md5"))


@register("json_by_document", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)}
SELECT concat(document_id, '.chunks.json') AS file_name, count(*) AS rows, CAST(sum(token_count) AS BIGINT) AS tokens
FROM chunks GROUP BY document_id""")
def q_json_by_document(spark, sf):
    """JSON output by document file name; read back and counted."""
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    c = chunk_pages(pages, tag=False)
    from textmill.operators.sinks import write_document_json
    path = write_document_json(c, scratch_path(spark, "chunks-by-doc"))
    back = spark.read.schema("file_name string, token_count long").json(path)
    return back.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("token_count").alias("tokens"))

_MODEL_SQL = "concat(source, '/', lang, '-base-v1.5')"
_PATH_SQL = "concat(source, '/manual.', doc_id, '.v2.PDF')"


@register("name_slugs", f"""
SELECT CAST(doc_id AS BIGINT) AS document_id, {_MODEL_SQL} AS input,
       lower(translate({_MODEL_SQL}, '/-.', '___')) AS slug, replace({_MODEL_SQL}, '/', '_') AS path_slug,
       concat(regexp_replace(regexp_extract({_PATH_SQL}, '[^/]*$'), '(.)\\.[^.]*$', '\\1'), '.chunks.json') AS file_name
FROM documents""")
def q_name_slugs(spark, sf):
    d = FX.documents(spark, sf).select("doc_id", F.expr(_MODEL_SQL).alias("input"),
                                       F.expr(_PATH_SQL).alias("path"))
    return d.select(_long("doc_id").alias("document_id"), "input", slug("input").alias("slug"),
                    path_slug("input").alias("path_slug"), output_name("path").alias("file_name"))


# ---------------------------------------------------------------- M6 vectors
from textmill.functions.vectors import cosine, inner_product, l2_norm, l2_normalize  # noqa: E402
from textmill.operators.embed import embed, embedding_dims, vector_rows  # noqa: E402

_SCALE = "transform(embedding, x -> x * CASE WHEN vec_id % 50 = 0 THEN 0 ELSE 1 + vec_id % 7 END)"
_SCALE_SQL = "list_transform(embedding, lambda x: x * CASE WHEN vec_id % 50 = 0 THEN 0 ELSE 1 + vec_id % 7 END)"
_NORM_SQL = "sqrt(list_sum(list_transform({v}, lambda x: CAST(x AS DOUBLE) * x)))"


@register("l2_normalize", f"""
WITH s AS (SELECT vec_id, {_SCALE_SQL} AS v FROM embeddings),
n AS (SELECT vec_id, v, {_NORM_SQL.format(v='v')} AS nv FROM s),
u AS (SELECT vec_id, CASE WHEN nv > 0 THEN list_transform(v, lambda x: CAST(CAST(x AS DOUBLE) / nv AS FLOAT)) ELSE v END AS u FROM n)
SELECT CAST(vec_id AS BIGINT) AS vec_id, round({_NORM_SQL.format(v='u')}, 4) + 0.0 AS norm,
       round(CAST(u[1] AS DOUBLE), 4) + 0.0 AS first FROM u""")
def q_l2_normalize(spark, sf):
    e = FX.read_table(spark, sf, "embeddings").select("vec_id", F.expr(_SCALE).alias("v"))
    u = e.select("vec_id", l2_normalize("v").alias("u"))
    return u.select(_long("vec_id").alias("vec_id"), (F.round(l2_norm("u"), 4) + 0.0).alias("norm"),
                    (F.round(F.col("u")[0].cast("double"), 4) + 0.0).alias("first"))


@register("cosine_equals_ip", f"""
WITH s AS (SELECT vec_id, {_SCALE_SQL} AS v FROM embeddings),
n AS (SELECT vec_id, v, {_NORM_SQL.format(v='v')} AS nv FROM s),
m AS (SELECT vec_id, v, nv, list_transform(v, lambda x: CAST(CASE WHEN nv > 0 THEN CAST(x AS DOUBLE) / nv ELSE x END AS FLOAT)) AS u FROM n),
p AS (SELECT CASE WHEN a.nv > 0 AND b.nv > 0 THEN list_cosine_similarity(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) END AS cs,
             list_inner_product(CAST(a.u AS DOUBLE[]), CAST(b.u AS DOUBLE[])) AS ip
      FROM m a JOIN m b ON b.vec_id = a.vec_id + 1)
SELECT CAST(count(*) AS BIGINT) AS pairs, CAST(count(*) - count(cs) AS BIGINT) AS undefined,
       max(abs(cs - ip)) < 1e-5 AS equal FROM p""")
def q_cosine_equals_ip(spark, sf):
    """Neighbouring rows: cosine is the inner product of the unit vectors, and
    undefined (null) beside a zero vector."""
    e = FX.read_table(spark, sf, "embeddings").select("vec_id", F.expr(_SCALE).alias("v"))
    n = e.select("vec_id", "v", l2_normalize("v").alias("u"))
    a, b = n.alias("a"), n.alias("b")
    p = a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1).select(
        cosine("a.v", "b.v").alias("cs"), inner_product("a.u", "b.u").alias("ip"))
    return p.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("cs").isNull()).alias("undefined"),
                 (F.max(F.abs(F.col("cs") - F.col("ip"))) < 1e-5).alias("equal"))


@register("embedding_dims", """
SELECT CAST(len(embedding) AS BIGINT) AS dimension, count(*) AS rows FROM embeddings GROUP BY 1""")
def q_embedding_dims(spark, sf):
    e = embedding_dims(FX.read_table(spark, sf, "embeddings"))
    return e.select(_long("dimension").alias("dimension"), "rows")


@register("hash_embed", """
SELECT CAST(doc_id AS BIGINT) AS document_id, CAST(64 AS BIGINT) AS dimension, CAST(1.0 AS DOUBLE) AS norm
FROM documents WHERE text IS NOT NULL""")
def q_hash_embed(spark, sf):
    """Offline provider over every document: dimension and norm per row."""
    ok, _rej = embed(_docs(spark, sf), text_col="text", provider="hashing", prefix="passage: ")
    return ok.select(_long("doc_id").alias("document_id"), _long(F.size("embedding")).alias("dimension"),
                     F.round(l2_norm("embedding"), 3).alias("norm"))



@register("vector_rows", f"""
WITH {S.pages_cte(VOCAB_SQL, 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=True)}
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(page_number AS BIGINT) AS page_number,
       token_count, 'AFM' AS document_type, system_category, md5(content) AS md5 FROM tagged""")
def q_vector_rows(spark, sf):
    pages = scan_pages(FX.vocab_documents(spark, sf), "doc_id", "text", delimiter=FF)
    c = chunk_pages(pages, tag=True, constants={"aircraft_model": "DA42"})
    ok, _rej = embed(c, "content", provider="hashing")
    v = vector_rows(ok, "AFM")
    return v.select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"),
                    _long("metadata.token_count").alias("token_count"), "document_type",
                    "system_category", F.md5("content").alias("md5"))


@register("cluster_adapter", f"""
SELECT CAST(event_id AS VARCHAR) AS id, {S.strip("concat('  ', event_type, ' fault  ')")} AS text,
       CAST(64 AS BIGINT) AS dimension FROM events""")
def q_cluster_adapter(spark, sf):
    path = FX.write_records_csv(spark, sf, scratch_path(spark, "records-csv"))
    rec = map_records(read_records_csv(spark, path))
    ok, _rej = embed(rec, "issue", provider="hashing", normalize=False)
    ci = cluster_input(ok.withColumnRenamed("embedding", "issue_embedding_vector"))
    return ci.select("id", "text", _long(F.size("embedding")).alias("dimension"))

# ---------------------------------------------------------------- M7 cluster summaries
from textmill.operators import summary as SM  # noqa: E402
from textmill.operators.postings import postings_hits, sync_postings  # noqa: E402

FC = FX.cluster_rows_sql()
_RANKED_SQL = f"""c AS {FC},
g AS (SELECT cluster_label, count(*) AS frequency, min(pos) AS first_pos FROM c
      WHERE cluster_label <> -1 GROUP BY cluster_label),
r AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY frequency DESC, first_pos) AS rank FROM g)
      WHERE rank <= 200)"""


def _pool_sql(pool: int) -> str:
    return f"""nb AS (SELECT cluster_label, pos, {S.strip('text')} AS s FROM c
       WHERE cluster_label IN (SELECT cluster_label FROM r) AND {S.strip('text')} <> ''),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_label ORDER BY pos) AS rn FROM nb)
      WHERE rn <= {pool})"""


def _canon_sql(pool: int = 10, name: str = "canon") -> str:
    return f"""{_pool_sql(pool).replace('nb AS', f'nb_{name} AS').replace('FROM nb)', f'FROM nb_{name})').replace('p AS (', f'p_{name} AS (')},
b_{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_label ORDER BY length(s), pos) AS k
       FROM p_{name}) WHERE k = 1),
{name} AS (SELECT r.cluster_label, coalesce(substring({S.strip(S.collapse_all('lower(b.s)'))}, 1, 120),
       'noisy placeholder') AS canonical FROM r LEFT JOIN b_{name} b ON r.cluster_label = b.cluster_label)"""


def _cluster_df(spark, sf):
    return FX.cluster_rows(spark, sf)


@register("label_stats", f"""
SELECT CAST(count(DISTINCT CASE WHEN cluster_label <> -1 THEN cluster_label END) AS BIGINT) AS n_clusters,
       CAST(sum(CASE WHEN cluster_label = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_noise FROM {FC}""")
def q_label_stats(spark, sf):
    return SM.label_stats(_cluster_df(spark, sf))


@register("cluster_rank", f"""
WITH {_RANKED_SQL}
SELECT CAST(cluster_label AS BIGINT) AS cluster_label, frequency, CAST(rank AS BIGINT) AS rank FROM r""")
def q_cluster_rank(spark, sf):
    r = SM.rank_clusters(_cluster_df(spark, sf))
    return r.select(_long("cluster_label").alias("cluster_label"), "frequency", _long("rank").alias("rank"))


@register("cluster_examples", f"""
WITH {_RANKED_SQL},
x AS (SELECT * FROM (SELECT cluster_label, text, row_number() OVER (PARTITION BY cluster_label ORDER BY pos) AS example
      FROM c WHERE cluster_label IN (SELECT cluster_label FROM r)) WHERE example <= 5)
SELECT CAST(cluster_label AS BIGINT) AS cluster_label, CAST(example AS BIGINT) AS example, md5(text) AS md5 FROM x""")
def q_cluster_examples(spark, sf):
    df = _cluster_df(spark, sf)
    x = SM.examples(df, SM.rank_clusters(df))
    return x.select(_long("cluster_label").alias("cluster_label"), _long("example").alias("example"),
                    F.md5("text").alias("md5"))


@register("canonical_text", f"""
WITH {_RANKED_SQL}, {_canon_sql()}
SELECT CAST(cluster_label AS BIGINT) AS cluster_label, canonical FROM canon""")
def q_canonical_text(spark, sf):
    df = _cluster_df(spark, sf)
    c = SM.canonical_text(df, SM.rank_clusters(df))
    return c.select(_long("cluster_label").alias("cluster_label"), "canonical")


_HEAD, _TAIL = SM.CANON_PROMPT.split("{s}")


@register("canonical_prompt", f"""
WITH {_RANKED_SQL}, {_pool_sql(10)},
l AS (SELECT cluster_label, string_agg(s, concat(chr(10), '- ') ORDER BY rn) AS items FROM p GROUP BY cluster_label)
SELECT CAST(r.cluster_label AS BIGINT) AS cluster_label,
       md5(concat({S.q(_HEAD)}, chr(10), '- ', coalesce(items, 'Noisy placeholder'), {S.q(_TAIL)})) AS md5
FROM r LEFT JOIN l ON r.cluster_label = l.cluster_label""")
def q_canonical_prompt(spark, sf):
    df = _cluster_df(spark, sf)
    p = SM.canonical_prompt(df, SM.rank_clusters(df))
    return p.select(_long("cluster_label").alias("cluster_label"), F.md5("prompt").alias("md5"))


@register("common_issues", f"""
WITH {_RANKED_SQL}, {_canon_sql()}
SELECT canon.canonical AS canonical, r.frequency AS frequency,
       CAST(least(r.frequency, 5) AS BIGINT) AS n_examples, CAST(r.rank AS BIGINT) AS rank
FROM r JOIN canon ON r.cluster_label = canon.cluster_label""")
def q_common_issues(spark, sf):
    ci = SM.common_issues(_cluster_df(spark, sf))
    return ci.select(F.col("canonical_squawk").alias("canonical"), "frequency",
                     _long(F.size("sample_examples")).alias("n_examples"), _long("rank").alias("rank"))


@register("kmeans_k_rule", """
WITH g AS (SELECT CAST(label AS BIGINT) AS grp, count(*) AS n FROM embeddings GROUP BY label
           UNION ALL SELECT -1 AS grp, count(*) AS n FROM embeddings),
k AS (SELECT grp, n, least(300, greatest(2, CASE WHEN n // 30 = 0 THEN 10 ELSE n // 30 END)) AS raw FROM g)
SELECT grp, CAST(n AS BIGINT) AS n, CAST(raw AS BIGINT) AS raw_k, CAST(least(raw, n) AS BIGINT) AS k FROM k""")
def q_kmeans_k_rule(spark, sf):
    e = FX.read_table(spark, sf, "embeddings")
    g = e.groupBy(_long("label").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    g = g.unionByName(e.agg(F.count(F.lit(1)).alias("n")).select(F.lit(-1).cast("long").alias("grp"), "n"))
    return g.select("grp", _long("n").alias("n"), SM.kmeans_k(F.col("n"), clamp=False).alias("raw_k"),
                    SM.kmeans_k(F.col("n")).alias("k"))


def _context_corpora(spark, sf):
    d = FX.documents(spark, sf).select(F.col("doc_id").alias("id"), "text")
    b = FX.read_table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    c = (FX.read_table(spark, sf, "conversations")
         .select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"))
    return {"manuals": d, "overviews": b, "past_squawks": c}


def _ctx_sql() -> str:
    parts = []
    src = {"manuals": "SELECT doc_id AS id, text FROM documents",
           "overviews": "SELECT item_id AS id, text FROM benchmark",
           "past_squawks": "SELECT conv_id * 1000 + turn AS id, text FROM conversations"}
    terms = "list_distinct(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]+'))"
    for name, lim in SM.CONTEXT_LIMITS.items():
        parts.append(f"""
SELECT * FROM (
  SELECT canonical, '{name}' AS corpus, id, hits,
         row_number() OVER (PARTITION BY canonical ORDER BY hits DESC, id) AS rank
  FROM (SELECT pt.canonical, ct.id, count(*) AS hits
        FROM (SELECT CAST(id AS VARCHAR) AS id, unnest({terms.format(x='text')}) AS term FROM ({src[name]})) ct
        JOIN pt ON ct.term = pt.term GROUP BY pt.canonical, ct.id))
WHERE rank <= {lim}""")
    return "\nUNION ALL".join(parts), terms


_CTX_UNION, _TERMS = _ctx_sql()


_CTX_SQL = f"""
WITH {_RANKED_SQL}, {_canon_sql()},
pt AS (SELECT DISTINCT canonical, unnest({_TERMS.format(x='canonical')}) AS term FROM (SELECT DISTINCT canonical FROM canon)),
h AS ({_CTX_UNION})
SELECT canonical, corpus, CAST(rank AS BIGINT) AS rank, id, CAST(hits AS BIGINT) AS hits FROM h"""


@register("research_context", _CTX_SQL)
def q_research_context(spark, sf):
    df = _cluster_df(spark, sf)
    phrases = SM.canonical_text(df, SM.rank_clusters(df)).select("canonical").distinct()
    h = SM.context_hits(phrases, _context_corpora(spark, sf), SM.CONTEXT_LIMITS)
    return h.select("canonical", "corpus", _long("rank").alias("rank"), "id", _long("hits").alias("hits"))


@register("research_postings", _CTX_SQL)
def q_research_postings(spark, sf):
    """The same context from a postings table: an earlier edition of the corpora is held
    first (longer documents as drafts, each document also as a withdrawn one), then brought up to date."""
    df = _cluster_df(spark, sf)
    phrases = SM.canonical_text(df, SM.rank_clusters(df)).select("canonical").distinct()
    corpora, path = _context_corpora(spark, sf), scratch_path(spark, "postings")
    draft = F.when(F.length("text") > 500, F.concat("text", F.lit(" draft"))).otherwise(F.col("text"))
    old = corpora["manuals"].withColumn("text", draft)
    gone = old.withColumn("id", F.concat(F.lit("withdrawn "), F.col("id")))
    sync_postings({"manuals": old.withColumn("id", F.col("id").cast("string")).unionByName(gone),
                   "overviews": corpora["overviews"]}, path)
    sync_postings(corpora, path, complete=True)
    h = postings_hits(phrases, path, SM.CONTEXT_LIMITS)
    return h.select("canonical", "corpus", _long("rank").alias("rank"), "id", "hits")

# ---------------------------------------------------------------- M9 sinks, batches, incremental
from textmill.operators.chunking import chunk_hash  # noqa: E402
from textmill.operators.pages import page_parts as _page_parts  # noqa: E402
from textmill.operators.sinks import (append as _append, batch_report as _batch_report,  # noqa: E402
                                      insert_batches, number_batches, pending as _pending, upsert as _upsert)
from textmill.sources.documents import discover_documents, page_rows  # noqa: E402
from textmill.sources.files import check_schema  # noqa: E402
from textmill import schemas  # noqa: E402


@register("upsert_merge", f"""
WITH {_RANKED_SQL}, {_canon_sql(5, 'old')}, {_canon_sql(10, 'new')},
t AS (SELECT * FROM (SELECT old.canonical AS k, r.frequency, r.rank,
        row_number() OVER (PARTITION BY old.canonical ORDER BY r.rank) AS d
      FROM r JOIN old ON r.cluster_label = old.cluster_label) WHERE d = 1),
s AS (SELECT * FROM (SELECT new.canonical AS k, r.frequency, r.rank,
        row_number() OVER (PARTITION BY new.canonical ORDER BY r.rank) AS d
      FROM r JOIN new ON r.cluster_label = new.cluster_label) WHERE d = 1)
SELECT k AS canonical_squawk, frequency, CAST(rank AS BIGINT) AS rank FROM t WHERE k NOT IN (SELECT k FROM s)
UNION ALL SELECT k, frequency, CAST(rank AS BIGINT) FROM s""")
def q_upsert_merge(spark, sf):
    """Merge this run's common issues (pool of 10 examples) into a table
    written by a run with a pool of 5; merging twice changes nothing."""
    df = _cluster_df(spark, sf)
    old = SM.common_issues(df, pool=5).select("canonical_squawk", "frequency", "rank")
    new = SM.common_issues(df, pool=10).select("canonical_squawk", "frequency", "rank")
    from textmill.operators.sinks import dedupe
    merged = _upsert(dedupe(old, "canonical_squawk"), new, "canonical_squawk")
    return merged.select("canonical_squawk", "frequency", _long("rank").alias("rank"))


_MODEL = "hashing-tf-64"


@register("pending_chunks", f"""
WITH {S.pages_cte(VOCAB_SQL, 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)},
now AS (SELECT * FROM chunks),
{S.pages_cte('documents', 'doc_id', 'text', 'chr(12)').replace('raw_pages', 'raw_pages0').replace('pages AS', 'pages0 AS')},
toks0 AS (SELECT document_id, page_number, {S.word_tokens(S.collapse('text'))} AS t FROM pages0),
wins0 AS (SELECT document_id, page_number, t, unnest(generate_series(0, len(t) - 1, 550)) AS s FROM toks0 WHERE len(t) > 0),
done AS (SELECT document_id, page_number, CAST(s // 550 AS BIGINT) AS chunk_index,
         replace(array_to_string(list_slice(t, s + 1, s + 600), ''), chr(0), '') AS content FROM wins0)
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(page_number AS BIGINT) AS page_number, chunk_index
FROM now WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.document_id = now.document_id
  AND done.page_number = now.page_number AND done.chunk_index = now.chunk_index AND done.content = now.content)""")
def q_pending_chunks(spark, sf):
    """Chunks of the current documents not embedded by an earlier run over
    the previous text (row-level incremental key: position + content hash +
    model)."""
    prev = chunk_hash(chunk_pages(scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF), tag=False))
    done, _ = embed(prev, "content", provider="hashing", model=_MODEL)
    cur = chunk_hash(chunk_pages(scan_pages(FX.vocab_documents(spark, sf), "doc_id", "text", delimiter=FF),
                                 tag=False)).withColumn("embedding_model", F.lit(_MODEL))
    p = _pending(cur, done)
    return p.select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"),
                    _long("chunk_index").alias("chunk_index"))


@register("reembed_chunks", f"""
WITH {S.pages_cte(VOCAB_SQL, 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)}
SELECT CAST(document_id AS BIGINT) AS document_id, CAST(page_number AS BIGINT) AS page_number, chunk_index,
       md5(content) AS md5, CAST(64 AS BIGINT) AS dims FROM chunks WHERE document_id % 5 <> 0""")
def q_reembed_chunks(spark, sf):
    """A table of embedded chunks after two runs: the first without a third of the
    documents, the second with changed texts and without every fifth document.  It
    holds the second run's chunks only, also after a compaction."""
    from textmill.operators.versions import compact, current, sync_embeddings
    path = scratch_path(spark, "embedded-versions")
    first = scan_pages(_docs(spark, sf).filter("doc_id % 3 <> 1"), "doc_id", "text", delimiter=FF)
    sync_embeddings(chunk_pages(first, tag=False), path, model=_MODEL)
    second = scan_pages(FX.vocab_documents(spark, sf).filter("doc_id % 5 <> 0"), "doc_id", "text", delimiter=FF)
    sync_embeddings(chunk_pages(second, tag=False), path, model=_MODEL)
    compact(spark, path)
    return current(spark, path).select(_long("document_id").alias("document_id"), _long("page_number").alias("page_number"),
                                       _long("chunk_index").alias("chunk_index"), F.md5("content").alias("md5"),
                                       _long(F.size("embedding")).alias("dims"))


@register("batch_report", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)},
n AS (SELECT *, (row_number() OVER (ORDER BY document_id, page_number, chunk_index) - 1) // 50 AS batch FROM chunks),
g AS (SELECT batch, count(*) AS rows, max(CASE WHEN token_count < 20 THEN 1 ELSE 0 END) AS bad FROM n GROUP BY batch)
SELECT CAST(batch AS BIGINT) AS batch, rows, CAST(CASE WHEN bad = 0 THEN rows ELSE 0 END AS BIGINT) AS ok,
       CAST(CASE WHEN bad = 1 THEN rows ELSE 0 END AS BIGINT) AS failed FROM g""")
def q_batch_report(spark, sf):
    """Insert batches of 50 in chunk order; a batch holding a row the sink
    rejects (fewer than 20 tokens here) fails whole."""
    c = chunk_pages(scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF), tag=False)
    b = number_batches(c, ["document_id", "page_number", "chunk_index"], size=50)
    return _batch_report(b, F.col("token_count") < 20)


@register("page_parts", """
WITH p AS (SELECT doc_id AS document_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS page_number
           FROM documents),
t AS (SELECT document_id, max(page_number) AS total FROM p GROUP BY document_id),
g AS (SELECT document_id, (page_number - 1) // 100 AS part, count(*) AS pages FROM p GROUP BY 1, 2)
SELECT CAST(g.document_id AS BIGINT) AS document_id, CAST(part AS BIGINT) AS part,
       CAST(part * 100 + 1 AS BIGINT) AS start_page, CAST(least(part * 100 + 100, total) AS BIGINT) AS end_page,
       concat(g.document_id, '_pages_', part * 100 + 1, '-', least(part * 100 + 100, total)) AS part_name,
       CAST(pages AS BIGINT) AS pages
FROM g JOIN t ON g.document_id = t.document_id""")
def q_page_parts(spark, sf):
    p = page_rows(_docs(spark, sf), "doc_id", "text", delimiter=NL)
    parts = _page_parts(p)
    return parts.select(_long("document_id").alias("document_id"), _long("part").alias("part"),
                        _long("start_page").alias("start_page"), _long("end_page").alias("end_page"),
                        "part_name", _long("pages").alias("pages"))


@register("usable_rows", f"""
SELECT id FROM {FC} WHERE len(embedding) > 0 AND text <> ''""")
def q_usable_rows(spark, sf):
    """Clustering input: rows with a vector and a text."""
    from textmill.sources.tables import read_cluster_rows
    return read_cluster_rows(_cluster_df(spark, sf), order="pos").select("id")


@register("discover_documents", """
SELECT CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS bytes, true AS in_path_order, true AS text_files FROM documents""")
def q_discover_documents(spark, sf):
    """Write the documents as text files, list them by suffix in path order."""
    path = scratch_path(spark, "docs-text")
    _docs(spark, sf).select("text").write.mode("overwrite").text(path)
    # one row for each file; the listing's own order is checked against the paths
    f = discover_documents(spark, path, suffix=".txt").select("path", "length")
    f = f.withColumn("place", F.monotonically_increasing_id())
    after = F.lag("path").over(Window.orderBy("place"))
    f = f.withColumn("up", after.isNull() | (after < F.col("path")))
    return f.agg(F.sum("length").alias("bytes"), F.min("up").alias("in_path_order"),
                 F.min(F.col("path").endswith(".txt")).alias("text_files"))


_RECORD_SQL = ORACLE["csv_records"]


@register("append_rows", f"SELECT * FROM ({_RECORD_SQL}) UNION ALL SELECT * FROM ({_RECORD_SQL})")
def q_append_rows(spark, sf):
    """Plain appends of the record table: a second run adds the rows again."""
    path = FX.write_records_csv(spark, sf, scratch_path(spark, "records-csv"))
    rec = map_records(read_records_csv(spark, path))
    out = scratch_path(spark, "records-table")
    _append(rec, out)
    _append(rec, out)
    return spark.read.parquet(out).select(*[iso_timestamp(c).alias(c) if c in (
        "logged_on", "signoff_on", "work_completed_on") else F.col(c) for c in RECORD_COLS])


@register("record_vectors", f"""
SELECT discrepancy_id, CAST(19 AS BIGINT) AS fields, CASE WHEN issue IS NOT NULL THEN CAST(64 AS BIGINT) END AS issue_dims,
       CASE WHEN corrective_action IS NOT NULL THEN CAST(64 AS BIGINT) END AS action_dims FROM ({_RECORD_SQL})""")
def q_record_vectors(spark, sf):
    """The full record: 17 mapped fields and the vectors of both texts."""
    path = FX.write_records_csv(spark, sf, scratch_path(spark, "records-csv"))
    rec = embed_records(map_records(read_records_csv(spark, path)))
    dims = [F.when(F.col(v).isNotNull(), _long(F.size(v))).alias(a) for v, a in
            (("issue_embedding_vector", "issue_dims"), ("corrective_embedding_vector", "action_dims"))]
    return rec.select("discrepancy_id", F.lit(len(rec.columns)).cast("long").alias("fields"), *dims)


@register("insert_batches", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)},
n AS (SELECT *, (row_number() OVER (ORDER BY document_id, page_number, chunk_index) - 1) // 50 AS batch FROM chunks),
g AS (SELECT batch, count(*) AS rows, CAST(sum(token_count) AS BIGINT) AS tokens,
             max(CASE WHEN token_count < 20 THEN 1 ELSE 0 END) AS bad FROM n GROUP BY batch)
SELECT CAST(batch AS BIGINT) AS batch, rows AS reported, CASE WHEN bad = 0 THEN rows ELSE 0 END AS stored,
       CASE WHEN bad = 0 THEN tokens ELSE 0 END AS tokens FROM g""")
def q_insert_batches(spark, sf):
    """Insert in batches, read the table back: what the report counts is stored."""
    c = chunk_pages(scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF), tag=False)
    out = scratch_path(spark, "vector-table")
    report = insert_batches(c, ["document_id", "page_number", "chunk_index"], out, size=50, failed=F.col("token_count") < 20)
    stored = spark.read.parquet(out).groupBy("batch").agg(F.count(F.lit(1)).alias("stored"),
                                                          F.sum("token_count").cast("long").alias("tokens"))
    return report.join(stored, "batch", "left").select(
        "batch", F.col("rows").alias("reported"), F.coalesce("stored", F.lit(0)).alias("stored"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"))


@register("schema_check", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)}
SELECT * FROM (VALUES ('page_number', 'int', 'string'), ('section_title', 'string', NULL), ('extra', NULL, 'bigint')) t(column_name, expected, actual),
       (SELECT count(*) AS rows FROM chunks)""")
def q_schema_check(spark, sf):
    """Contract check of a written table with three seeded faults: one column of
    another type, one missing, one too many."""
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF)
    c = chunk_pages(pages, tag=True, constants={"aircraft_model": "DA42"})
    ok, _ = embed(c, "content")
    out = scratch_path(spark, "vector-rows")
    (vector_rows(ok, "AFM").withColumn("page_number", F.col("page_number").cast("string")).drop("section_title")
     .withColumn("extra", F.lit(1).cast("long")).write.parquet(out))
    table = spark.read.parquet(out)
    faults = check_schema(table, schemas.VECTOR_ROW).withColumnRenamed("column", "column_name")
    return faults.join(table.agg(F.count(F.lit(1)).alias("rows")))  # one row of counts

# ---------------------------------------------------------------- M8 clustering
from textmill.operators.cluster import cluster_density, cluster_kmeans, kmeans_invariants  # noqa: E402


@register("kmeans_invariants", """
WITH c AS (SELECT count(*) AS n FROM embeddings)
SELECT CAST(n AS BIGINT) AS n, CAST(least(n, least(300, greatest(2, CASE WHEN n // 30 = 0 THEN 10 ELSE n // 30 END))) AS BIGINT) AS k,
       CAST(least(n, least(300, greatest(2, CASE WHEN n // 30 = 0 THEN 10 ELSE n // 30 END))) AS BIGINT) AS clusters,
       CAST(n AS BIGINT) AS size_sum, true AS nearest_ok FROM c""")
def q_kmeans_invariants(spark, sf):
    """MLlib k-means with the k rule on the embeddings: size sum equals n and
    every row's centre is its nearest."""
    e = FX.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    labelled, model = cluster_kmeans(e)
    return kmeans_invariants(labelled, model)




def partition_report(labelled):
    """Per given label: size, predicted clusters, noise rows, and how many
    other given labels share a predicted cluster with it."""
    pred = labelled.filter(F.col("cluster_label") != -1)
    pairs = (pred.select("label", "cluster_label").distinct().alias("a")
             .join(pred.select("label", "cluster_label").distinct().alias("b"), "cluster_label")
             .filter(F.col("a.label") != F.col("b.label"))
             .groupBy(F.col("a.label").alias("label")).agg(F.count_distinct("b.label").alias("shared")))
    base = labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_distinct(F.when(F.col("cluster_label") != -1, F.col("cluster_label"))).alias("clusters"),
        F.count_if(F.col("cluster_label") == -1).alias("noise"))
    return (base.join(pairs, "label", "left")
            .select(_long("label").alias("label"), _long("size").alias("size"), _long("clusters").alias("clusters"),
                    _long("noise").alias("noise"), F.coalesce("shared", F.lit(0)).cast("long").alias("shared")))


@register("density_partition", """
SELECT CAST(label AS BIGINT) AS label, CAST(count(*) AS BIGINT) AS size, CAST(1 AS BIGINT) AS clusters,
       CAST(0 AS BIGINT) AS noise, CAST(0 AS BIGINT) AS shared FROM embeddings GROUP BY label""")
def q_density_partition(spark, sf):
    """Density clustering recovers the label partition of separable vectors."""
    return partition_report(cluster_density(FX.separable(spark, sf)))


@register("density_noise", f"""
WITH g AS (SELECT CASE WHEN {FX.SEP_OUTLIER} THEN -1 ELSE label END AS label FROM embeddings)
SELECT CAST(label AS BIGINT) AS label, CAST(count(*) AS BIGINT) AS size,
       CAST(CASE WHEN label = -1 THEN 0 ELSE 1 END AS BIGINT) AS clusters,
       CAST(CASE WHEN label = -1 THEN count(*) ELSE 0 END AS BIGINT) AS noise, CAST(0 AS BIGINT) AS shared
FROM g GROUP BY label""")
def q_density_noise(spark, sf):
    """Far outliers come out as noise, the rest as their label's cluster; small
    blocks and rank intervals, so that the work is spread at every size."""
    return partition_report(cluster_density(FX.separable(spark, sf, outliers=True), block_rows=200, base_edges=256))

# ---------------------------------------------------------------- whole runs and writes that can be repeated
from textmill.operators.issues import refresh_issues  # noqa: E402
from textmill.operators.keyed import merge_keyed, read_keyed  # noqa: E402
from textmill.operators.loads import insert_resumable  # noqa: E402
from textmill.operators.pages import observed_chunks  # noqa: E402
from textmill.operators.sinks import write_json  # noqa: E402


@register("keyed_merge", """
WITH t AS (SELECT concat('d', doc_id) AS item, lang, source, n_chars AS size FROM documents),
u AS (SELECT concat('d', doc_id) AS item, CAST(-1 AS BIGINT) AS size FROM documents WHERE n_chars >= 2000
      UNION ALL SELECT concat('p', page_id), CAST(length(html) AS BIGINT) FROM pages)
SELECT coalesce(t.item, u.item) AS item, t.lang AS lang, t.source AS source,
       CAST(CASE WHEN u.item IS NULL THEN t.size ELSE u.size END AS BIGINT) AS size
FROM t FULL JOIN u ON t.item = u.item""")
def q_keyed_merge(spark, sf):
    """A keyed table of all documents, then a merge that changes one column of the long
    ones and adds the pages: columns that it doesn't send stay."""
    path = scratch_path(spark, "keyed-table")
    d = FX.read_table(spark, sf, "documents")
    item = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item")
    merge_keyed(d.select(item, "lang", "source", _long("n_chars").alias("size")), path, "item")
    pages = FX.read_table(spark, sf, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("item"), _long(F.length("html")).alias("size"))
    changed = d.filter("n_chars >= 2000").select(item, F.lit(-1).cast("long").alias("size"))
    merge_keyed(changed.unionByName(pages), path, "item")
    return read_keyed(spark, path)


@register("insert_resumed", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(12)')}, {S.chunks_cte(tagged=False)},
n AS (SELECT *, (row_number() OVER (ORDER BY document_id, page_number, chunk_index) - 1) // 50 AS batch FROM chunks),
g AS (SELECT batch, count(*) AS rows, CAST(sum(token_count) AS BIGINT) AS tokens,
             max(CASE WHEN token_count < 20 THEN 1 ELSE 0 END) AS bad FROM n GROUP BY batch)
SELECT CAST(batch AS BIGINT) AS batch, rows AS stored, tokens,
       CASE WHEN bad = 0 THEN rows ELSE 0 END AS first_run, CASE WHEN bad = 1 THEN rows ELSE 0 END AS second_run,
       rows AS present_in_third FROM g""")
def q_insert_resumed(spark, sf):
    """A load that fails for some batches, run again without the failure and once more:
    every batch is stored once, by the run that could."""
    c = chunk_pages(scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=FF), tag=False)
    order, out = ["document_id", "page_number", "chunk_index"], scratch_path(spark, "resumed-table")
    first = insert_resumable(c, order, out, "chunks", failed=F.col("token_count") < 20)
    second = insert_resumable(c, order, out, "chunks")
    third = insert_resumable(c, order, out, "chunks")
    stored = spark.read.parquet(out).groupBy("batch").agg(F.count(F.lit(1)).alias("stored"),
                                                          F.sum("token_count").cast("long").alias("tokens"))
    return (stored.join(first.select("batch", F.col("ok").alias("first_run")), "batch")
            .join(second.select("batch", F.col("ok").alias("second_run")), "batch")
            .join(third.select("batch", F.col("present").alias("present_in_third")), "batch"))


@register("ingest_totals", f"""
WITH {S.pages_cte('documents', 'doc_id', 'text', 'chr(10)')}, {S.chunks_cte(tagged=False)}
SELECT (SELECT count(*) FROM pages) AS pages, (SELECT CAST(max(length(text)) AS BIGINT) FROM pages) AS longest_page,
       (SELECT count(*) FROM chunks) AS chunks, (SELECT CAST(sum(token_count) AS BIGINT) FROM chunks) AS tokens""")
def q_ingest_totals(spark, sf):
    """Totals of an ingest from counters in the pass that writes the chunks."""
    pages = scan_pages(_docs(spark, sf), "doc_id", "text", delimiter=NL)
    chunks, seen, made = observed_chunks(pages, lambda p: chunk_pages(p, tag=False))
    write_json(chunks, scratch_path(spark, "observed-chunks"))
    totals = {**seen.get, **made.get}
    names = ("pages", "longest_page", "chunks", "tokens")
    return spark.createDataFrame([tuple(totals[n] for n in names)], ", ".join(f"{n} long" for n in names))


_RUN_ROWS = (f"(SELECT e.vec_id AS pos, CASE WHEN {FX.SEP_OUTLIER} THEN -1 ELSE label END AS cluster_label, "
             "coalesce(d.text, concat('Fault ', e.vec_id)) AS text "
             "FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id "
             "WHERE coalesce(d.text, concat('Fault ', e.vec_id)) <> '')")


@register("issue_run", f"""
WITH {_RANKED_SQL.replace(FC, _RUN_ROWS)}, {_canon_sql()},
pt AS (SELECT DISTINCT canonical, unnest({_TERMS.format(x='canonical')}) AS term FROM (SELECT DISTINCT canonical FROM canon)),
h AS ({_CTX_UNION}),
m AS (SELECT canonical, string_agg(concat(corpus, ':', id), ' ' ORDER BY corpus, rank) AS found FROM h GROUP BY canonical),
x AS (SELECT cluster_label, string_agg(md5(text), ' ' ORDER BY k) AS texts FROM
      (SELECT cluster_label, text, row_number() OVER (PARTITION BY cluster_label ORDER BY pos) AS k FROM c) WHERE k <= 5 GROUP BY 1),
b AS (SELECT canon.canonical, r.frequency, r.rank, x.texts, row_number() OVER (PARTITION BY canon.canonical ORDER BY r.rank) AS d
      FROM r JOIN canon ON r.cluster_label = canon.cluster_label JOIN x ON r.cluster_label = x.cluster_label)
SELECT b.canonical AS canonical, b.frequency AS frequency, CAST(b.rank AS BIGINT) AS rank, md5(b.texts) AS examples,
       md5(coalesce(m.found, '')) AS found
FROM b LEFT JOIN m ON b.canonical = m.canonical WHERE b.d = 1""")
def q_issue_run(spark, sf):
    """Vectors to the table of common issues, twice: a first run keeps three issues, a
    second all of them; the context comes from the documents, benchmark and conversations."""
    e = FX.separable(spark, sf, outliers=True).select(F.col("id").alias("pos"), "embedding")
    d = FX.read_table(spark, sf, "documents").select(F.col("doc_id").alias("pos"), F.col("text").alias("_t"))
    rows = cut_lineage(e.join(d, "pos", "left").select(
        F.col("pos").alias("id"), "pos", "embedding",
        F.coalesce("_t", F.concat(F.lit("Fault "), F.col("pos").cast("string"))).alias("text")), "issue-input")  # read by both runs
    path, corpora = scratch_path(spark, "issues"), _context_corpora(spark, sf)
    refresh_issues(rows, path, corpora=corpora, top=3)
    t = refresh_issues(rows, path, corpora=corpora)
    ids = F.concat(*[F.expr(f"transform(sources.{k}, x -> concat('{k}:', x))") for k in sorted(SM.CONTEXT_LIMITS)])
    return t.select(F.col("canonical_squawk").alias("canonical"), "frequency", _long("rank").alias("rank"),
                    F.md5(F.array_join(F.transform("sample_examples", lambda x: F.md5(x)), " ")).alias("examples"),
                    F.md5(F.array_join(ids, " ")).alias("found"))
