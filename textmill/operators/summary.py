"""Cluster summaries: rank, examples, canonical text, research context and the
common-issue table (A1-A5, A10, F5, F8, T1, P25, P25b, J4, C5).

Input is a labelled table ``(label, pos, text, ...)``; ``pos`` is the row
order.  Every per-cluster step cuts to a few rows with ``row_number() <= k``
(planned as a WindowGroupLimit that trims in each task before the shuffle)
or with partial aggregates, so a cluster holding a third of all rows never
lands whole in one task.  The top-cluster list is bounded (``top`` rows), so
joining it back is a broadcast of a known small size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.text import collapse_all, py_strip

NOISE = -1
TOP_N = 200
EXAMPLES = 5
CANON_POOL = 10
CANON_WIDTH = 120
PLACEHOLDER = "Noisy placeholder"
HIT_ROWS = 512  # texts whose hits one matrix product counts
CONTEXT_LIMITS = {"manuals": 5, "overviews": 3, "past_squawks": 5}

# Fixed value: the instruction text of the canonical-phrase prompt.
CANON_PROMPT = """You are normalizing aircraft maintenance "squawks" (pilot-reported issues).
Given EXAMPLES of very similar squawks, produce ONE short, generalized description (max ~8 words) that captures the common issue pattern without aircraft-specific tail numbers or extraneous detail.
Return just the phrase.

EXAMPLES:
{s}
"""


def label_stats(df: DataFrame, label: str = "cluster_label") -> DataFrame:
    """One row: clusters (distinct labels, noise excluded) and noise rows."""
    return df.agg(F.count_distinct(F.when(F.col(label) != NOISE, F.col(label))).alias("n_clusters"),
                  F.count_if(F.col(label) == NOISE).alias("n_noise"))


def rank_clusters(df: DataFrame, label: str = "cluster_label", pos: str = "pos",
                  top: int | None = TOP_N) -> DataFrame:
    """``cluster_label, frequency, first_pos, rank``: clusters by size (noise
    dropped), ties by first appearance, the first ``top`` kept."""
    g = (df.filter(F.col(label) != NOISE)
         .groupBy(F.col(label).alias("cluster_label"))
         .agg(F.count(F.lit(1)).alias("frequency"), F.min(pos).alias("first_pos")))
    order = [F.desc("frequency"), F.asc("first_pos")]
    if top:
        g = g.orderBy(*order).limit(top)
        # at most `top` rows here: a global window over them is cheap
        return g.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    # every cluster ranked: distributed numbering (range partitions + offsets)
    from textmill.operators.sinks import number_rows
    keyed = g.withColumn("_neg", -F.col("frequency"))
    return (number_rows(keyed, ["_neg", "first_pos"], out="_i")
            .select("cluster_label", "frequency", "first_pos", (F.col("_i") + 1).alias("rank")))


def _top_members(df: DataFrame, ranked: DataFrame, label: str) -> DataFrame:
    keep = ranked.select(F.col("cluster_label").alias(label))
    return df.join(F.broadcast(keep), label, "left_semi")


def examples(df: DataFrame, ranked: DataFrame | None = None, n: int = EXAMPLES,
             label: str = "cluster_label", pos: str = "pos", text: str = "text") -> DataFrame:
    """First ``n`` member texts of each cluster in row order, raw (blanks and
    duplicates kept): ``cluster_label, example, text``."""
    src = df if ranked is None else _top_members(df, ranked, label)
    w = Window.partitionBy(label).orderBy(pos)
    return (src.select(label, pos, text).withColumn("example", F.row_number().over(w))
            .filter(F.col("example") <= n)
            .select(F.col(label).alias("cluster_label"), "example", text))


def _pool(df: DataFrame, ranked: DataFrame | None, pool: int, label: str, pos: str,
          text: str) -> DataFrame:
    """First ``pool`` non-blank, stripped texts per cluster."""
    src = df if ranked is None else _top_members(df, ranked, label)
    s = py_strip(F.col(text))
    nb = src.select(label, pos, s.alias("_s")).filter(F.col("_s").isNotNull() & (F.col("_s") != ""))
    w = Window.partitionBy(label).orderBy(pos)
    return nb.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= pool)


def nonblank(text: str = "text"):
    """Whether a text holds more than blanks (those that a canonical phrase may come from)."""
    s = py_strip(F.col(text))
    return s.isNotNull() & (s != "")


def first_members(df: DataFrame, ranked: DataFrame, filled: str, n_examples: int = EXAMPLES, pool: int = CANON_POOL,
                  label: str = "cluster_label", pos: str = "pos") -> DataFrame:
    """The rows of ``df`` that describe the clusters of ``ranked``: the first ``n_examples``
    of each in row order, and the first ``pool`` of those ``filled`` (a boolean column
    such as :func:`nonblank`); a row that is both comes twice."""
    src, w = _top_members(df, ranked, label), Window.partitionBy(label).orderBy(pos)
    parts = [rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
             for rows, k in ((src, n_examples), (src.filter(filled), pool))]
    return parts[0].unionByName(parts[1])


def _with_placeholder(per_cluster: DataFrame, ranked: DataFrame | None, df: DataFrame,
                      label: str, value_col: str, placeholder) -> DataFrame:
    base = (ranked.select("cluster_label") if ranked is not None else
            df.filter(F.col(label) != NOISE).select(F.col(label).alias("cluster_label")).distinct())
    return (base.join(per_cluster, "cluster_label", "left")
            .select("cluster_label", F.coalesce(F.col(value_col), placeholder).alias(value_col)))


def canonical_text(df: DataFrame, ranked: DataFrame | None = None, pool: int = CANON_POOL,
                   width: int = CANON_WIDTH, label: str = "cluster_label", pos: str = "pos",
                   text: str = "text") -> DataFrame:
    """Offline canonical phrase: among the first ``pool`` non-blank examples,
    the shortest (first on ties), lower-cased, blanks collapsed, cut to
    ``width``; ``noisy placeholder`` for a cluster without one."""
    p = _pool(df, ranked, pool, label, pos, text)
    best = (p.groupBy(F.col(label).alias("cluster_label"))
            .agg(F.min_by("_s", F.struct(F.length("_s"), F.col(pos))).alias("_best")))
    phrase = F.substring(py_strip(collapse_all(F.lower("_best"))), 1, width)
    per = best.select("cluster_label", phrase.alias("canonical"))
    fallback = F.lit(PLACEHOLDER.lower())
    return _with_placeholder(per, ranked, df, label, "canonical", fallback)


def canonical_prompt(df: DataFrame, ranked: DataFrame | None = None, pool: int = CANON_POOL,
                     label: str = "cluster_label", pos: str = "pos", text: str = "text") -> DataFrame:
    """The language-model prompt per cluster (examples as a dash list); the
    call itself is a pluggable step, its answer is post-processed by
    :func:`clean_answer`."""
    p = _pool(df, ranked, pool, label, pos, text)
    lst = (p.groupBy(F.col(label).alias("cluster_label"))
           .agg(F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.col("_s")))).alias("_ex")))
    items = F.transform("_ex", lambda x: x["_s"])
    body = F.concat(F.lit("\n- "), F.array_join(items, "\n- "))
    head, tail = CANON_PROMPT.split("{s}")
    per = lst.select("cluster_label", F.concat(F.lit(head), body, F.lit(tail)).alias("prompt"))
    fallback = F.lit(head + "\n- " + PLACEHOLDER + tail)
    return _with_placeholder(per, ranked, df, label, "prompt", fallback)


def clean_answer(c, width: int = CANON_WIDTH):
    """Model answer -> phrase: strip, collapse blanks, cut to ``width``."""
    return F.substring(py_strip(collapse_all(py_strip(c))), 1, width)


def _terms(text_col) -> "F.Column":
    return F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(r"[\p{L}\p{N}_]+"), 0))


def research_context(phrases: DataFrame, corpora: dict[str, DataFrame] | None = None,
                     limits: dict[str, int] | None = None, mode: str = "empty",
                     key: str = "canonical") -> DataFrame:
    """Context per phrase from several corpora, as
    ``struct<manuals, overviews, past_squawks: array<string>>`` of ids.

    ``empty`` returns three empty lists (the default behaviour).  ``search``
    ranks each corpus's rows by the number of distinct phrase terms they
    contain (ties by id) and keeps the top ``limits[corpus]``; see
    :func:`context_hits` for the plan.
    """
    limits = dict(CONTEXT_LIMITS if limits is None else limits)
    if mode == "empty":
        empty = F.array().cast("array<string>")
        return phrases.select(key, F.struct(*[empty.alias(k) for k in limits]).alias("sources"))
    if mode != "search":
        raise ValueError(f"unknown context mode: {mode!r}")
    hits = context_hits(phrases, corpora or {}, limits, key)
    agg = (hits.groupBy(key, "corpus")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("_l"))
           .select(key, "corpus", F.transform("_l", lambda x: x["id"]).alias("ids")))
    pv = agg.groupBy(key).pivot("corpus", list(limits)).agg(F.first("ids"))
    empty = F.array().cast("array<string>")
    out = phrases.select(key).join(pv, key, "left")
    return out.select(key, F.struct(*[F.coalesce(F.col(k), empty).alias(k) for k in limits]).alias("sources"))


def context_hits(phrases: DataFrame, corpora: dict[str, DataFrame], limits: dict[str, int],
                 key: str = "canonical") -> DataFrame:
    """Flat ranked hits ``key, corpus, rank, id, hits`` (corpora hold
    ``id, text``).

    The phrase side is bounded (top clusters x phrase width): its terms are collected
    and go out with the corpus scan.  Each Arrow batch looks its terms up by hash,
    counts the hits of all phrases by one matrix product for many rows, and keeps each
    phrase's top rows (no join rows, no shuffle of document-phrase pairs, so frequent
    words cost nothing extra); ``row_number() <= k`` ranks what the batches kept.
    """
    held = [(r[0], r[1]) for r in phrases.select(F.col(key)).distinct().select(key, _terms(F.col(key))).collect()]
    held.sort(key=lambda r: (r[0] is not None, r[0] or ""))
    spark = phrases.sparkSession
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(held)], f"_pi int, `{key}` string")
    vocabulary = pa.array(sorted({t for _, ts in held for t in ts or []}), pa.string())
    at = {t: i for i, t in enumerate(vocabulary.to_pylist())}
    has = np.zeros((len(at), len(held)), np.float32)
    for i, (_, ts) in enumerate(held):
        has[[at[t] for t in ts or []], i] = 1.0
    out = None
    for name, corpus in corpora.items():
        rows = corpus.select(F.col("id").cast("string").alias("id"), _terms(F.col("text")).alias("_t"))
        r = rows.mapInArrow(_phrase_hits(vocabulary, has, limits[name]), "id string, _pi int, hits int")
        w = Window.partitionBy("_pi").orderBy(F.desc("hits"), F.asc("id"))
        r = (r.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limits[name])
             .withColumn("corpus", F.lit(name)))
        out = r if out is None else out.unionByName(r)
    return (out.join(F.broadcast(names), "_pi")
            .select(key, "corpus", "rank", "id", F.col("hits").cast("long").alias("hits")))


def _phrase_hits(vocabulary: pa.Array, has: np.ndarray, limit: int):
    """Arrow batches of ``id, _t`` -> ``id, _pi, hits``: of each batch the ``limit`` rows
    with most hits of every phrase (ties to the smaller id, null first).  ``has``: which
    term of ``vocabulary`` is in which phrase."""
    def run(batches):
        for batch in batches:
            lists, ids = batch.column(1), batch.column(0)
            rows, found = pc.list_parent_indices(lists).to_numpy(), pc.index_in(pc.list_flatten(lists), vocabulary)
            known = found.is_valid().to_numpy(zero_copy_only=False)
            rows, term = rows[known], found.drop_null().to_numpy()
            if not len(rows):
                continue
            # place of each id in the order of Spark's strings (bytes), equal ids by row
            place = np.empty(len(ids), np.int64)
            place[pc.sort_indices(ids.cast(pa.binary()), null_placement="at_start").to_numpy()] = np.arange(len(ids))
            hits = np.empty((len(ids), has.shape[1]), np.int64)
            for s in range(0, len(ids), HIT_ROWS):
                lo, hi = np.searchsorted(rows, (s, s + HIT_ROWS))
                one = np.zeros((min(HIT_ROWS, len(ids) - s), len(has)), np.float32)
                one[rows[lo:hi] - s, term[lo:hi]] = 1.0
                hits[s:s + HIT_ROWS] = one @ has
            order = hits * len(ids) - place[:, None]  # all different within a phrase
            if limit < len(ids):
                top = np.argpartition(order, len(ids) - limit, axis=0)[len(ids) - limit:]
            else:
                top = np.tile(np.arange(len(ids))[:, None], (1, has.shape[1]))
            n = np.take_along_axis(hits, top, 0)
            keep = n > 0
            phrase = np.broadcast_to(np.arange(has.shape[1]), top.shape)[keep]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(top[keep])), pa.array(phrase, pa.int32()), pa.array(n[keep], pa.int32())],
                names=["id", "_pi", "hits"])
    return run


def common_issues(df: DataFrame, top: int = TOP_N, n_examples: int = EXAMPLES,
                  pool: int = CANON_POOL, width: int = CANON_WIDTH, label: str = "cluster_label",
                  pos: str = "pos", text: str = "text", context: str = "empty",
                  corpora: dict[str, DataFrame] | None = None, ranked: DataFrame | None = None) -> DataFrame:
    """The common-issue table: ``canonical_squawk, cluster_label, frequency,
    sample_examples, sources, rank`` for the ``top`` largest clusters.

    Where the clusters come ``ranked`` (:func:`rank_clusters` of all rows), ``df`` need
    hold no more than their :func:`first_members`."""
    ranked = rank_clusters(df, label, pos, top) if ranked is None else ranked
    canon = canonical_text(df, ranked, pool, width, label, pos, text)
    ex = (examples(df, ranked, n_examples, label, pos, text)
          .groupBy("cluster_label")
          .agg(F.array_sort(F.collect_list(F.struct("example", text))).alias("_ex"))
          .select("cluster_label", F.transform("_ex", lambda x: x[text]).alias("sample_examples")))
    base = ranked.join(canon, "cluster_label").join(ex, "cluster_label", "left")
    ctx = research_context(base.select("canonical").distinct(), corpora, mode=context)
    out = base.join(ctx, "canonical", "left")
    return out.select(F.col("canonical").alias("canonical_squawk"),
                      F.col("cluster_label").cast("int").alias("cluster_label"),
                      F.col("frequency").cast("long").alias("frequency"),
                      "sample_examples", "sources", "rank")


def kmeans_k(n, cap: int = 300, floor: int = 2, small: int = 10, per: int = 30, clamp: bool = True):
    """k rule: ``min(cap, max(floor, n // per or small))``, clamped to n.
    Works on an int or a Column."""
    if isinstance(n, int):
        k = min(cap, max(floor, (n // per) or small))
        return min(k, n) if clamp else k
    q = F.floor(n / per)
    k = F.least(F.lit(cap), F.greatest(F.lit(floor), F.when(q == 0, F.lit(small)).otherwise(q)))
    return (F.least(k, n) if clamp else k).cast("long")


def canonical_from_model(prompts: DataFrame, answer_fn, width: int = CANON_WIDTH) -> DataFrame:
    """Model path of the canonical phrase: ``answer_fn`` maps a pandas Series
    of prompts to answers (one call per cluster, at most ``top`` rows, run
    in Arrow batches with ``mapInPandas``); answers are stripped, blanks
    collapsed and cut to ``width``."""
    schema = "cluster_label " + dict(prompts.dtypes)["cluster_label"] + ", answer string"

    def run(batches):
        for pdf in batches:
            out = pdf[["cluster_label"]].copy()
            out["answer"] = list(answer_fn(pdf["prompt"]))
            yield out
    ans = prompts.select("cluster_label", "prompt").mapInPandas(run, schema)
    return ans.select("cluster_label", clean_answer(F.col("answer"), width).alias("canonical"))
