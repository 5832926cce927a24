"""Registered queries of the corpus operators (``opN_<name>``) and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import read_table

from . import (chunk_recipes, filter_audit, html_extract, importance, jaccard_join, mixing, neighbours, packing, quality,
               substring_dedup, token_counts, toxicity, url_filter)
from .common import stage


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary_path(), budget=512)


def held_out(doc_id) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labels of rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    return (toxicity.fit_and_score(docs, labels)
            .select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                    "score", "predicted", "evidence"))


def page_document(url) -> Column:
    """The number that ends a page's path: the id of the document it shows."""
    number = F.regexp_extract(url_filter.url_path(url), r"/(\d{1,18})(?:\.\w+)?/?$", 1)
    return F.when(number != "", number).cast("long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights come from pages whose document is known (its text is the article)."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("article"))
    picked = stage(pages.select("page_id", page_document(F.col("url")).alias("doc_id")).where("doc_id is not null")
                   .orderBy(F.xxhash64("page_id"), "page_id", "doc_id").limit(html_extract.FIT_PAGES), "page-sample")
    # both sides of the labelled sample are bounded by FIT_PAGES rows
    shown = pages.join(F.broadcast(picked), "page_id").select("doc_id", "html")
    articles = docs.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id")
    weights = html_extract.fit_weights(shown.join(articles, "doc_id"))
    return html_extract.extract_pages(pages, weights)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(read_table(spark, sf_dir, "documents"))


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a labelled page: its document (the number that ends the path)
    is labelled toxic or of low quality."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("bad"))
    outcomes = (pages.select("url", page_document(F.col("url")).alias("doc_id"))
                .join(labels, "doc_id").select("url", "bad"))
    judged = url_filter.judge_urls(pages, outcomes, URL_RULES)
    return judged.withColumns({c: F.round(c, 9) for c in ("rate", "lower")})


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary_path(), length=2048)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove(read_table(spark, sf_dir, "documents").select("doc_id", "text"), window=20)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read_table(spark, sf_dir, "documents"), k=4, percent=85)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.groups(read_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_toxicity, op3_html_extraction, op4_mixing, op5_packing, op6_quality_rules,
    op7_substring_dedup, op8_url_filter,
    op9_neighbours, op10_jaccard_join, op11_importance_resampling, op12_exact_dedup, op13_filter_audit)}

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

_LONG = (r"regexp_matches(l2, '^(" + "|".join(url_filter.REGISTRY_LABELS) + r")\.[a-z]{2}$') OR l2 IN ("
         + ", ".join(f"'{x}'" for x in url_filter.SUFFIXES) + ")")
_RULE = " ".join(f"WHEN (p.host = '{h}' OR ends_with(p.host, '.{h}')) AND starts_with(p.path, '{p}') THEN ['{h}{p}', '{v}']"
                 for h, p, v in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1])))


def _strength_sql(rate: str) -> str:
    return f"""coalesce(least(greatest(avg({rate} * (1 - {rate})) / greatest(
        (sum(n * pow(bad / n - {rate}, 2)) - sum({rate} * (1 - {rate})))
        / CASE WHEN sum(n) - sum(n * n) / sum(n) > 0 THEN sum(n) - sum(n * n) / sum(n) END, 1e-6) - 1, 2.0), 1e4), 1e4) AS k"""


ORACLE["op8_url_filter"] = rf"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
o AS (SELECT host, (toxic = 1 OR quality = 0)::INT AS bad FROM labels JOIN
      (SELECT host, TRY_CAST(regexp_extract(path, '/(\d{{1,18}})(?:\.\w+)?/?$', 1) AS BIGINT) AS id FROM p) ON id = doc_id),
hosts AS (SELECT host, CASE WHEN {_LONG} THEN l3 ELSE l2 END AS domain, CASE WHEN {_LONG} THEN l2 ELSE l1 END AS suffix
    FROM (SELECT host, regexp_extract(host, '[^.]*$') AS l1, regexp_extract(host, '([^.]*\.)?[^.]*$') AS l2,
                 regexp_extract(host, '([^.]*\.)?([^.]*\.)?[^.]*$') AS l3 FROM (SELECT DISTINCT host FROM p WHERE host <> ''))),
seen AS (SELECT h.host, h.domain, h.suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad
         FROM o JOIN hosts h ON o.host = h.host WHERE bad IS NOT NULL GROUP BY ALL),
t AS (SELECT coalesce(sum(bad) / sum(n), 0.0) AS rate0 FROM seen),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate0) AS rate0 FROM seen, t GROUP BY suffix),
s AS (SELECT suffix, (k * rate0 + bad) / (k + n) AS rate_s FROM s0, (SELECT {_strength_sql("rate0")} FROM s0)),
d0 AS (SELECT domain, sum(n) AS n, sum(bad) AS bad, any_value(rate_s) AS rate_s FROM seen JOIN s USING (suffix) GROUP BY domain),
d AS (SELECT domain, (k * rate_s + bad) / (k + n) AS rate_d FROM d0, (SELECT {_strength_sql("rate_s")} FROM d0)),
h0 AS (SELECT seen.*, rate_d FROM seen JOIN d USING (domain)),
ab AS (SELECT hosts.host, k * coalesce(rate_d, rate_s, rate0) + coalesce(seen.bad, 0) AS a,
              k * (1 - coalesce(rate_d, rate_s, rate0)) + coalesce(seen.n, 0) - coalesce(seen.bad, 0) AS b
       FROM hosts LEFT JOIN seen USING (host) LEFT JOIN d ON d.domain = hosts.domain LEFT JOIN s ON s.suffix = hosts.suffix,
            t, (SELECT {_strength_sql("rate_d")} FROM h0)),
r AS (SELECT host, a / (a + b) AS rate,
             greatest(a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)), 0.0) AS lower FROM ab),
j AS (SELECT p.page_id, p.host, p.path, CASE {_RULE} END AS rule, rate, lower FROM p LEFT JOIN r ON p.host = r.host)
SELECT page_id, host, path, rule[1] AS rule,
       coalesce(rule[2], CASE WHEN lower > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       round(rate, 9) AS rate, round(lower, 9) AS lower FROM j"""

# crc32 byte by byte over the usual 256-entry table, which a subquery computes
ORACLE["op11_importance_resampling"] = f"""
WITH crc AS (SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v
    FROM range(256) r(i))),
d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
m AS (SELECT regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d), mw AS (SELECT unnest(ws) AS w FROM m),
vocabulary AS (SELECT w, (xor(list_reduce(
    list_prepend(4294967295::UBIGINT, [('0x' || x)::UBIGINT FOR x IN regexp_extract_all(hex(w), '..')]),
    lambda a, b: xor(a >> 8, tab[(xor(a & 255, b) + 1)::INT])), 4294967295::UBIGINT) % 10000)::BIGINT AS bucket
    FROM (SELECT w FROM dw UNION SELECT w FROM mw), crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN vocabulary USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM mw JOIN vocabulary USING (w) GROUP BY bucket),
gains AS (SELECT b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM dw) + 10000)
        / ((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM mw) + 10000)))) AS gain
    FROM (SELECT DISTINCT bucket FROM vocabulary) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*)) AS weight
      FROM dw JOIN vocabulary USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id)[1:8])::UBIGINT + 0.5::DOUBLE)
        / 4294967296::DOUBLE))))::BIGINT AS score FROM d LEFT JOIN w USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS all_fit
           FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
       CASE WHEN r <= 10 * all_fit // 100 THEN r END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""

ORACLE["op12_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, sha256({_ASCII_LOWER}) AS text_sha256, {_ASCII_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""

ORACLE["op13_filter_audit"] = """
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
f AS (SELECT doc_id, part, (len(ws) < 200)::INT
    + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INT AS mask FROM w),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS tox
          FROM f LEFT JOIN labels USING (doc_id) GROUP BY part, mask),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM l a, l b, l c, l d, l e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step - 1])::INT AS earlier FROM o, range(1, 6) r(step)),
steps AS (SELECT part, filter_order, step, bit,
    sum(n) FILTER (mask & (coalesce(earlier, 0) | bit) = 0) AS kept,
    sum(n) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit <> 0) AS removed,
    sum(n) FILTER (mask & coalesce(earlier, 0) <> 0 AND mask & bit <> 0) AS redundant,
    sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit <> 0) AS good_lost,
    sum(tox) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit <> 0) AS toxic_lost
    FROM cells, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM steps"""
