"""Filter interaction audit: what every order of a set of filters removes.

Each document is reduced to a mask of the filters that it fails; counts by part and
mask (at most 2**k cells a part) hold all that any order can remove.  One recursive
CTE starts from the mask cells and extends filter prefixes with unused letters,
carrying the bits applied so far; each level says, per cell, whether the step keeps,
removes or would have removed it.  The k letters bound the recursion (326 prefixes of
five letters, times 32 masks), whatever the size of the corpus; joined with the
counts it gives every step of every order, and the sums over all orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stage

MAX_FILTERS = 6  # k letters give k! orders

_STEPS = """
WITH RECURSIVE steps(prefix, letter, step, applied, mask, bit, is_kept, is_removed, is_redundant) AS (
  SELECT '', '', 0, 0, mask, 0, true, false, false FROM {masks}
  UNION ALL
  SELECT concat(s.prefix, l.letter), l.letter, s.step + 1, s.applied | l.bit, s.mask, l.bit,
         (s.mask & (s.applied | l.bit)) = 0,
         (s.mask & s.applied) = 0 AND (s.mask & l.bit) <> 0,
         (s.mask & s.applied) <> 0 AND (s.mask & l.bit) <> 0
  FROM steps s JOIN {letters} l ON (s.applied & l.bit) = 0)
SELECT * FROM steps WHERE step > 0"""


def enumerate_steps(spark, letters: str) -> DataFrame:
    """Every filter prefix with every mask: ``prefix, letter, step, applied, mask, bit,
    is_kept, is_removed, is_redundant``; bounded by the letters alone."""
    if not 1 <= len(letters) <= MAX_FILTERS or len(set(letters)) != len(letters) or not letters.isalnum():
        raise ValueError(f"need 1 to {MAX_FILTERS} different letters")
    masks = spark.range(1 << len(letters)).select(F.col("id").cast("int").alias("mask"))
    bits = spark.range(len(letters)).select(F.expr(f"substring('{letters}', cast(id AS int) + 1, 1)").alias("letter"),
                                            F.expr("shiftleft(1, cast(id AS int))").alias("bit"))
    return spark.sql(_STEPS.format(masks="{masks}", letters="{letters}"), masks=masks, letters=bits)


def audit(rows: DataFrame, letters: str) -> DataFrame:
    """``rows``: ``part`` (string), one boolean column a letter (true: fails that
    filter), booleans ``good`` and ``toxic``.  One row per part, order and step:
    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley`` (counts long).  A part with documents has all rows, zeros
    included; an empty table gives no rows."""
    spark = rows.sparkSession
    mask = sum((F.when(F.col(c), 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0))
    cells = stage(rows.groupBy("part", mask.cast("int").alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")), "mask-cells")
    steps = stage(enumerate_steps(spark, letters).coalesce(1), "filter-steps")

    def total(value: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(value)).otherwise(0)).cast("long")

    # the enumerated steps are bounded by the number of filters
    at = (cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "letter", "step").agg(
        total("n", F.col("is_kept")).alias("kept"), total("n", F.col("is_removed")).alias("removed"),
        total("n", F.col("is_redundant")).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", F.col("is_removed")).alias("good_lost"), total("toxic", F.col("is_removed")).alias("toxic_lost")))
    k = len(letters)
    orders = steps.filter((F.col("step") == k) & (F.col("mask") == 0)).select(
        F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(k))).alias("n_letters"))
    orders = orders.select("filter_order", F.expr("left(filter_order, n_letters)").alias("prefix"))
    at = stage(at, "filter-prefixes")
    full = at.join(F.broadcast(orders), "prefix")
    # a prefix stands in as many orders as its unused letters can be arranged
    arranged = F.element_at(F.array(*[F.lit(_factorial(k - s)) for s in range(1, k + 1)]), F.col("step"))
    shapley = at.groupBy("part", "letter").agg(F.sum(F.col("removed") * arranged).cast("long").alias("shapley"))
    return full.join(shapley, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _factorial(n: int) -> int:
    return 1 if n < 2 else n * _factorial(n - 1)


def document_failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Rows for :func:`audit` under letters ABCDE.  A: under 200 words; B: fewer than
    half of the words distinct; C: over 3 percent ASCII capitals; D: a character of
    ``#$%&*|``; E: the text is that of a row with a smaller id.

    Null texts count as empty, a null part as the empty string.  Rows with a null id
    come after all others (E) and have no label; rows that repeat id and text are
    documents of their own and none is smaller than the other.  A document is good
    (toxic) if any label row of its id says so.  Equal texts are found by sha256:
    the smallest id of each is a partial aggregate, and a row is looked up by hash and
    id together, so a text that fills a third of the table is no hot key."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    base = stage(docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                             text.alias("t"), words.alias("w"))
                 .select("id", "part", F.size("w").alias("n"), F.size(F.array_distinct("w")).alias("n_distinct"),
                         F.regexp_count("t", F.lit("[A-Z]")).alias("caps"), F.char_length("t").alias("chars"),
                         F.col("t").rlike(r"[#$%&*|]").alias("D"), F.unhex(F.sha2("t", 256)).alias("h"))
                 .select("id", "part", "h", (F.col("n") < 200).alias("A"), (F.col("n_distinct") * 100 < F.col("n") * 50).alias("B"),
                         (F.col("caps") * F.lit(100).cast("long") > F.col("chars") * F.lit(3).cast("long")).alias("C"), "D"),
                 "filter-base")
    first = base.groupBy("h").agg(F.min("id").alias("f")).select(F.col("h").alias("fh"), "f", F.lit(True).alias("is_first"))
    base = base.join(first, (base["h"] == first["fh"]) & base["id"].eqNullSafe(first["f"]), "left")
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    out = base.join(marks, base["id"] == marks["doc_id"], "left")
    yes = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    return out.select("part", "A", "B", "C", "D", F.col("is_first").isNull().alias("E"), *yes)


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    return audit(document_failures(docs, labels, part), "ABCDE")
