"""Nearest neighbours by inner product with multi-index hashing.

Fit.  On a bounded sample (``FIT_VALUES`` numbers, chosen by a hash of the id) two
rotations are learned by iterative quantization; the signs of a rotated vector
are its code.  The Hamming radius is the ``COVER`` quantile of the code distances
between sample queries and their true neighbours in the sample; neighbours in
the whole table are nearer, so the radius errs to the safe side.

Search.  Codes are split into 16-bit substrings, and each substring has its own
index (occupied buckets).  Two codes within radius r agree on some substring up
to r / substrings bits, so probing every index with that small radius finds
every code within r (pigeonhole); those are checked on the whole code and
reranked with the original vectors in double precision.  If a block holds fewer
than k codes within r, the radius grows there until k are found, so no query
ends with fewer results than there are candidates.

Scale.  The stated query set meets all rows in blocks: rows and queries are
dealt into blocks of fixed size by a hash, a task indexes one block of rows and
probes it with one block of queries, and only the k best of each leave it.
Equal vectors are one class (its smallest ids suffice for any result), so a
vector that a third of the rows share is indexed and searched once.

Defined cases: vectors that are null, of another dimension than most, zero, or
with null or non-finite components take no part; ties go to the smaller id;
of an id's usable rows the one with the smallest vector (compared number by number)
counts; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

FIT_VALUES = 1_280_000
FIT_QUERIES = 400
COVER = 0.985
ROTATIONS = 2
ROW_BLOCK, QUERY_BLOCK = 8192, 2048


def usable(v: Column) -> Column:
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(v, lambda x: x != 0)


def learn_rotation(x: np.ndarray, bits: int, seed: int, rounds: int = 30) -> np.ndarray:
    """Iterative quantization: the rotation (d x bits) whose signs fit ``x`` best."""
    _, vectors = np.linalg.eigh(x.T @ x)
    p = x @ vectors[:, -bits:]
    r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(p @ r >= 0, 1.0, -1.0).T @ p)
        r = (u @ vt).T
    return vectors[:, -bits:] @ r


class Coder:
    """Binary codes of vectors and the search radius."""

    def __init__(self, sample: np.ndarray, k: int):
        sample = sample.astype(np.float64)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.bits = sample.shape[1]
        self.maps = [learn_rotation(unit, self.bits, seed) for seed in range(ROTATIONS)]
        self.substrings = self.code(sample[:1]).shape[1]
        q = sample[:FIT_QUERIES]
        exact = q @ sample.T
        exact[np.arange(len(q)), np.arange(len(q))] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            self.radius = 16 * self.substrings
            return
        top = np.argpartition(-exact, k - 1, axis=1)[:, :k]
        codes = self.code(sample)
        dist = np.bitwise_count(codes[:len(q), None, :] ^ codes[top]).sum(-1, dtype=np.int64)
        self.radius = int(np.quantile(dist, COVER, method="higher"))

    def code(self, x: np.ndarray) -> np.ndarray:
        """16-bit substrings of the codes, n x substrings."""
        signs = np.concatenate([x @ m >= 0 for m in self.maps], axis=1)
        pad = -signs.shape[1] % 16
        packed = np.packbits(np.pad(signs, ((0, 0), (0, pad))), axis=1)
        return np.ascontiguousarray(packed).view(np.uint16)


class BlockIndex:
    """One block of rows: vectors, codes and a bucket index for each substring."""

    def __init__(self, coder: Coder, vectors: np.ndarray):
        self.coder, self.x = coder, vectors
        self.codes = coder.code(vectors)
        self.tables = []
        for s in range(coder.substrings):
            values, inverse = np.unique(self.codes[:, s], return_inverse=True)
            self.tables.append((values, inverse))

    def candidates(self, code: np.ndarray, k: int) -> np.ndarray:
        """Rows whose code lies within the radius, or the next ones up to k rows."""
        r = self.coder.radius
        near = np.zeros(len(self.x), dtype=bool)
        for s, (values, inverse) in enumerate(self.tables):
            hit = np.bitwise_count(values ^ code[s]) <= r // self.coder.substrings
            near |= hit[inverse]
        rows = np.flatnonzero(near)
        dist = np.bitwise_count(self.codes[rows] ^ code).sum(1, dtype=np.int64)
        rows = rows[dist <= r]
        if len(rows) < min(k, len(self.x)):
            dist = np.bitwise_count(self.codes ^ code).sum(1, dtype=np.int64)
            bound = np.partition(dist, min(k, len(dist)) - 1)[min(k, len(dist)) - 1]
            rows = np.flatnonzero(dist <= max(bound, r))
        return rows

    def search(self, queries: np.ndarray, ids: np.ndarray, k: int) -> tuple[list, list, list]:
        """(query row, id, score) of the k best candidates of each query."""
        codes, who, found, score = self.coder.code(queries), [], [], []
        for i, (q, c) in enumerate(zip(queries, codes, strict=True)):
            rows = self.candidates(c, k)
            s = np.einsum("ij,j->i", self.x[rows], q)
            best = np.lexsort((ids[rows], -s))[:k]
            who.append(np.full(len(best), i))
            found.append(ids[rows][best])
            score.append(s[best])
        return who, found, score


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every usable row of ``vectors``
    (vec_id, embedding) that ``is_query`` holds for."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    dims = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = dims.orderBy(F.desc("n"), "d").limit(1).collect()
    if not first:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    d = first[0]["d"]
    rows = rows.where(F.size("embedding") == d).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # classes of equal vectors; the smallest k + 1 ids of a class serve any result
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    members = (rows.withColumn("n", F.dense_rank().over(smallest)).where(F.col("n") <= k + 1)
               .groupBy("embedding").agg(F.min("vec_id").alias("cls"), F.array_distinct(F.sort_array(F.collect_list("vec_id"))).alias("ids")))
    classes = stage(members, "neighbour-classes")
    asked = rows.where(is_query).select("vec_id", "embedding").distinct()
    queries = stage(asked.join(classes.select("embedding", "cls"), "embedding").select("vec_id", "cls"), "neighbour-queries")
    wanted = queries.select("cls").distinct()

    sample = (classes.select("cls", "embedding").orderBy(F.xxhash64(F.lit("fit"), "cls"), "cls")
              .limit(max(FIT_VALUES // d, 2 * k + 2)))
    coder = Coder(np.array([r["embedding"] for r in sample.collect()]), k + 1)

    n_rows, n_queries = classes.count(), wanted.count()
    row_blocks, query_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64(F.lit(own), "cls"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    left = dealt(classes.select("cls", "embedding"), "rb", row_blocks, "qb", query_blocks)
    right = dealt(classes.select("cls", "embedding").join(wanted, "cls", "left_semi"), "qb", query_blocks, "rb", row_blocks)
    # the two sides come from one table: own names keep them apart
    right = right.select(F.col("cls").alias("q"), F.col("embedding").alias("v"), F.col("rb").alias("r2"), F.col("qb").alias("q2"))

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        none = pa.table({"q": pa.array([], pa.int64()), "cls": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not block.num_rows or not asked.num_rows:
            return none
        ids = block.column("cls").to_numpy()
        index = BlockIndex(coder, _matrix(block.column("embedding"), block.num_rows))
        who, found, score = index.search(_matrix(asked.column("v"), asked.num_rows), ids, k + 1)
        q = asked.column("q").to_numpy()
        return pa.table({"q": q[np.concatenate(who)], "cls": np.concatenate(found), "score": np.concatenate(score)})

    found = (left.groupBy("rb", "qb").cogroup(right.groupBy("r2", "q2"))
             .applyInArrow(run, "q long, cls long, score double"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "cls")
    top = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    single = (top.join(classes.select("cls", "ids"), "cls")
              .select("q", "score", F.explode("ids").alias("vec_id")))
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = (single.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1).groupBy("q")
             .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")))
    near = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (queries.select(F.col("vec_id").alias("query_id"), F.col("cls").alias("q")).join(lists, "q")
            .select("query_id", F.posexplode(near).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                    F.col("x.score").alias("score")))
