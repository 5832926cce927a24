"""Quality rules: fixed base rules and robust multivariate outliers (DataFrame functions only).

Per language and source, a minimum-covariance-determinant estimate describes the
transformed statistics of ordinary documents: log length, log mean word length,
and the square roots of the shares of symbols, repeated lines and repeated
words.  The estimate starts from medians and MADs and takes concentration steps:
keep the share ``SUPPORT`` of the group with the smallest Mahalanobis distances,
re-estimate mean and covariance from them, repeat.  Documents beyond ``cutoff``
(squared distance) are rejected.  Shares that are zero in nearly all documents
have no spread of their own, so every variance has a floor (``FLOORS``).

Scale.  One narrow pass makes a few numbers of each text; everything after it
runs on that slim table.  Per-group quantiles are mergeable sketches and means
and covariances are sums, both combined before the shuffle, so a hot group sends
one row a task.  Parameters are a row a group; Spark broadcasts that table when
its measured size allows and else joins by shuffle.

Groups of fewer than ``min_rows`` documents share an estimate with the small
groups of their language, or with all small groups.  Defined cases: null or
blank text has no words and fails the base rules; null language or source is a
value of its own; repeated rows count each; an empty table gives an empty
result; a group of equal documents keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import source_key, stage

GAPS = " \t\n\x0b\x0c\r"
DIMS = ("x_len", "x_word", "x_symbol", "x_lines", "x_repeat")
FLOORS = (0.5, 0.08, 0.05, 0.15, 0.15)
SUPPORT = 0.75
CHI2_MEDIAN = 4.351  # median of chi-square with five degrees of freedom
WINDOW = 5


def text_stats(docs: DataFrame, *, text: Column | None = None, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` columns and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    base = docs.select(*[F.col(c) for c in keep], t.alias("_t"))
    trimmed = F.btrim("_t", F.lit(GAPS))
    base = base.select(
        *keep,
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")).alias("_w"),
        F.length(F.translate("_t", GAPS, "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    n = F.size("_w")
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)])))
    base = base.select(*keep, n.cast("long").alias("n_words"), "word_chars", "n_symbols",
                       F.size("_l").cast("long").alias("n_lines"),
                       (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                       hashes.alias("_h"))
    # most texts repeat no window; only the others sort (hash, position) pairs
    pairs = F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
                   F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    base = base.withColumn("_s", pairs).drop("_h")
    twice = F.filter("_s", lambda x, k: F.coalesce(F.get("_s", k - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get("_s", k + 1)["h"] == x["h"], F.lit(False)))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x + WINDOW - a["end"])).alias("n"),
                              (x + WINDOW).alias("end")),
        lambda a: a["n"])
    return base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_s")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vector() -> list[Column]:
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return [F.log(n + F.lit(1.0)), F.log(c / n), F.sqrt(F.col("n_symbols") / c),
            F.sqrt(F.col("n_dup_lines") / lines), F.sqrt(F.col("n_repeat_words") / n)]


def _group_keys(rows: DataFrame, min_rows: int) -> DataFrame:
    """(lang key, source key) -> group; a row a group."""
    from pyspark.sql import Window
    n = rows.groupBy("_lang", "_src").agg(F.count(F.lit(1)).alias("n"))
    small = F.sum(F.when(F.col("n") < min_rows, F.col("n")).otherwise(0)).over(Window.partitionBy("_lang"))
    # \x00 can't be in a key built from text columns of well-formed tables
    return n.withColumn("_small", small).select(
        "_lang", "_src",
        F.when(F.col("n") >= min_rows, F.concat_ws("\x00", F.lit("g"), "_lang", "_src"))
        .when(F.col("_small") >= min_rows, F.concat_ws("\x00", F.lit("l"), "_lang"))
        .otherwise(F.lit("all")).alias("_g"))


def _params(subset: DataFrame) -> DataFrame:
    """Mean and inverse Cholesky factor of the floored covariance, a row a group."""
    d = len(DIMS)
    aggs = [F.avg(x).alias(f"m{i}") for i, x in enumerate(DIMS)]
    aggs += [F.covar_pop(DIMS[i], DIMS[j]).alias(f"c{i}{j}") for i in range(d) for j in range(i + 1)]
    p = subset.groupBy("_g").agg(*aggs)
    p = p.withColumns({f"c{i}{i}": F.coalesce(F.col(f"c{i}{i}"), F.lit(0.0)) + FLOORS[i] ** 2 for i in range(d)})
    p = p.withColumns({f"c{i}{j}": F.coalesce(F.col(f"c{i}{j}"), F.lit(0.0)) for i in range(d) for j in range(i)})
    for i in range(d):  # Cholesky factor l, row by row
        for j in range(i + 1):
            s = F.col(f"c{i}{j}")
            for k in range(j):
                s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            p = p.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / F.col(f"l{j}{j}"))
    for i in range(d):  # its inverse v
        for j in range(i + 1):
            if i == j:
                e = 1.0 / F.col(f"l{i}{i}")
            else:
                s = F.lit(0.0)
                for k in range(j, i):
                    s = s + F.col(f"l{i}{k}") * F.col(f"v{k}{j}")
                e = -s / F.col(f"l{i}{i}")
            p = p.withColumn(f"v{i}{j}", e)
    return p.select("_g", *[f"m{i}" for i in range(d)], *[f"v{i}{j}" for i in range(d) for j in range(i + 1)])


def _distance() -> Column:
    total = F.lit(0.0)
    for i in range(len(DIMS)):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"v{i}{j}") * (F.col(DIMS[j]) - F.col(f"m{j}"))
        total = total + z * z
    return total


def _starting_params(rows: DataFrame) -> DataFrame:
    """Medians, and MADs as a diagonal scale, in the layout of ``_params``."""
    d = len(DIMS)
    # written, so that Spark knows the small side's size and need not deal the rows out by group
    med = stage(rows.groupBy("_g").agg(*[F.percentile_approx(x, 0.5, 10000).alias(f"m{i}") for i, x in enumerate(DIMS)]),
                "quality-medians")
    off = rows.join(med, "_g")
    mad = off.groupBy("_g").agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 10000).alias(f"a{i}")
                                  for i, x in enumerate(DIMS)])
    zero = {f"v{i}{j}": F.lit(0.0) for i in range(d) for j in range(i)}
    scale = {f"v{i}{i}": 1.0 / F.sqrt(F.pow(1.4826 * F.col(f"a{i}"), 2) + FLOORS[i] ** 2) for i in range(d)}
    return med.join(mad, "_g").withColumns({**zero, **scale}).select(
        "_g", *[f"m{i}" for i in range(d)], *[f"v{i}{j}" for i in range(d) for j in range(i + 1)])


def judge(docs: DataFrame, *, steps: int = 3, cutoff: float = 32.0, min_rows: int = 50) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance`` (squared, null where the base rules failed)."""
    rows = text_stats(docs).withColumns({"_lang": source_key(F.col("lang")), "_src": source_key(F.col("source"))})
    rows = rows.withColumn("base_failed", base_failed()).withColumns(dict(zip(DIMS, _vector(), strict=True)))
    rows = stage(rows.drop("lang", "source"), "quality-stats")
    usable = rows.where(~F.col("base_failed"))
    keys = stage(_group_keys(usable, min_rows), "quality-groups")
    fit = usable.join(keys, ["_lang", "_src"]).select("_g", *DIMS)
    params = stage(_starting_params(fit), "quality-start")
    for k in range(steps):
        scored = fit.join(params, "_g").select("_g", *DIMS, _distance().alias("_d"))
        bound = stage(scored.groupBy("_g").agg(F.percentile_approx("_d", SUPPORT, 10000).alias("_b")), f"quality-bound{k}")
        params = stage(_params(scored.join(bound, "_g").where(F.col("_d") <= F.col("_b"))), f"quality-step{k}")
    scored = fit.join(params, "_g").select("_g", _distance().alias("_d"))
    factor = scored.groupBy("_g").agg(
        F.greatest(F.percentile_approx("_d", 0.5, 10000) / CHI2_MEDIAN, F.lit(1.0)).alias("_f"))
    model = stage(keys.join(params, "_g").join(factor, "_g"), "quality-model")
    d = F.when(~F.col("base_failed"), _distance() / F.col("_f"))
    return (rows.join(model, ["_lang", "_src"], "left").withColumn("distance", d)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"),
                    "distance"))
