"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Targets.  The mix holds ``share`` times all words.  Sources, in code-point
order with null last, weigh ``weights`` in rotation; a source's target stops at
``max_repeat`` times its own size and what it leaves is reshared by weight
among the others (water filling, solved in closed form on the source table).

Draw.  Every document of a source expects ``target / source_size`` copies.
Documents are ranked within their source by (size class, salt, hash); with rate
r and one random offset u per source, document i is emitted
``floor(r*i + u) - floor(r*(i-1) + u)`` times: once per integer boundary that
its expected copies cross.  Ordering by size class keeps the words taken near
the target, not only the copies.

Scale.  A rank is a sum over a tree: source > size class > 256 salts > 256
salts > rows.  Windows above the leaves see at most ``CLASSES_PER_OCTAVE`` times
the octaves, or 256, rows a partition, and a leaf holds 1/65536 of one size
class, so neither a hot source nor a huge group of equal texts meets in a task.
Only the source table (one row a source) is ordered in a single task.

Defined cases: null text has size 0; a null source is a source of its own; a
source without words has target 0 and its documents are not taken; repeated
rows are ranked one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import source_key, stage, word_count

CLASSES_PER_OCTAVE = 16
FANOUT = 256


def _with_cells(docs: DataFrame, source: Column, size: Column, identity: Column, seed: int) -> DataFrame:
    return (docs.withColumn("_skey", source_key(source)).withColumn("_size", size)
            .withColumn("_h", F.xxhash64(identity, F.col("_size"), F.lit(seed)))
            .withColumn("_cls", F.floor(F.log2(F.col("_size") + 1.0) * CLASSES_PER_OCTAVE).cast("int"))
            .withColumn("_s1", F.pmod(F.col("_h"), F.lit(FANOUT)).cast("int"))
            .withColumn("_s2", F.pmod(F.shiftright("_h", 8), F.lit(FANOUT)).cast("int")))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, max_repeat: float,
                   seed: int) -> DataFrame:
    """``_skey, source_size, target, _rate, _u`` for a table of (_skey, source_size)."""
    by_name = Window.orderBy("_skey")
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = (sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * float(max_repeat))
         .withColumn("_total", F.sum("source_size").over(everything) * float(share))
         .withColumn("_allw", F.sum("_w").over(everything))
         .withColumn("_fill", F.col("_cap") / F.col("_w")))
    before = Window.orderBy("_fill", "_skey").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / (F.col("_allw") - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    t = t.withColumn("_level", level)
    # the first source in fill order that its share does not fill sets the common level
    open_level = F.max(F.when(F.col("_level") < F.col("_fill"), F.col("_level"))).over(everything)
    t = t.withColumn("_open", open_level)
    target = F.when(F.col("_open").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_open") * F.col("_w"), F.col("_cap")))
    u = F.pmod(F.xxhash64(F.col("_skey"), F.lit(seed), F.lit("offset")), F.lit(1 << 20)) / float(1 << 20)
    return t.select("_skey", "source_size", target.alias("target"),
                    F.when(F.col("source_size") > 0, target / F.col("source_size"))
                    .otherwise(F.lit(0.0)).alias("_rate"), u.alias("_u"))


def draw(docs: DataFrame, *, source: Column | None = None, size: Column | None = None,
         identity: Column | None = None, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
         max_repeat: int = 2, seed: int = 11) -> DataFrame:
    """``docs`` with every column kept and ``_size, source_size, target, _rank, copies``,
    for tables without columns of these names or names that start with an underscore."""
    source = F.col("source") if source is None else source
    size = word_count(F.col("text")) if size is None else size
    identity = F.col("doc_id") if identity is None else identity
    rows = _with_cells(docs, source, size, identity, seed)
    leaf = ["_skey", "_cls", "_s1", "_s2"]
    cells = rows.groupBy(*leaf).agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"))
    cells = stage(cells, "mix-cells")

    def offsets(table: DataFrame, keys: list[str], name: str) -> DataFrame:
        w = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        return table.select(*keys, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(name))

    level3 = offsets(cells, leaf, "_o3")
    t2 = cells.groupBy(*leaf[:3]).agg(F.sum("_n").alias("_n"))
    level2 = offsets(t2, leaf[:3], "_o2")
    t1 = cells.groupBy(*leaf[:2]).agg(F.sum("_n").alias("_n"))
    level1 = offsets(t1, leaf[:2], "_o1")
    targets = source_targets(cells.groupBy("_skey").agg(F.sum("_words").alias("source_size")),
                             weights, share, max_repeat, seed)
    # a row a source; written, so that Spark knows its size when it plans the join
    targets = stage(targets, "mix-targets")
    plan = (level3.join(level2, leaf[:3]).join(level1, leaf[:2]).join(targets, ["_skey"])
            .withColumn("_off", F.col("_o1") + F.col("_o2") + F.col("_o3")).drop("_o1", "_o2", "_o3"))
    in_leaf = Window.partitionBy(*leaf).orderBy("_h", "_size")
    ranked = rows.join(plan, leaf).withColumn("_rank", F.col("_off") + F.row_number().over(in_leaf))
    reach = F.floor(F.col("_rate") * F.col("_rank") + F.col("_u"))
    start = F.floor(F.col("_rate") * (F.col("_rank") - 1) + F.col("_u"))
    return (ranked.withColumn("copies", F.least(reach - start, F.lit(max_repeat)).cast("long"))
            .drop("_h", "_cls", "_s1", "_s2", "_off", "_rate", "_u"))


def mix_counts(docs: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
               max_repeat: int = 2, seed: int = 11) -> DataFrame:
    """Words taken from each document: whole copies, and per source one document
    with a cut or a partial copy that settles what whole copies leave over.

    ``doc_id, size, source_size, target, taken, copies, cut``; ``taken`` is
    ``copies * size + cut`` and never above ``max_repeat * size``.
    """
    slim = stage(docs.select("doc_id", F.col("source").alias("source"),
                             word_count(F.col("text")).alias("size")), "mix-sizes")
    drawn = stage(draw(slim, size=F.col("size"), weights=weights, share=share, max_repeat=max_repeat, seed=seed)
                  .drop("_size"), "mix-drawn")
    whole = F.col("copies") * F.col("size")
    room = F.struct((max_repeat * F.col("size") - whole).alias("room"), F.col("_rank").alias("rank"))
    load = F.struct(whole.alias("room"), F.col("_rank").alias("rank"))
    rest = (drawn.groupBy("_skey").agg((F.round(F.first("target")) - F.sum(whole)).cast("long").alias("_gap"),
                                       F.max(room).alias("_up"), F.max(load).alias("_down")))
    at = F.when(F.col("_gap") > 0, F.col("_up")).otherwise(F.col("_down"))
    rest = stage(rest.select("_skey", "_gap", at["rank"].alias("_at"), at["room"].alias("_room")), "mix-rest")
    cut = (F.when((F.col("_rank") == F.col("_at")) & (F.col("_gap") > 0), F.least("_gap", "_room"))
           .when((F.col("_rank") == F.col("_at")) & (F.col("_gap") < 0), -F.least(-F.col("_gap"), F.col("_room")))
           .otherwise(F.lit(0)).cast("long"))
    # a row a source: Spark broadcasts it if its measured size allows
    return (drawn.join(rest, "_skey").withColumn("cut", cut)
            .select("doc_id", "size", "source_size", "target", (whole + F.col("cut")).alias("taken"),
                    "copies", "cut"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as it is drawn, in whole copies
    and with the columns of ``docs`` only."""
    # the row travels as one value, so no column of it can clash with those of the draw
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    drawn = draw(docs.select(row), source=F.col("_doc.source"), size=word_count(F.col("_doc.text")),
                 identity=F.col("_doc.doc_id"), **options).where(F.col("copies") > 0)
    return drawn.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")
