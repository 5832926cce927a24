"""Connected components and pointer jumping on DataFrames.

Each round's result is written as a table in the shared checkpoint folder
and read back, so a lost executor recomputes one round, not the whole loop,
and plan statistics stay those of real files.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.session import cut_lineage

MAX_ROUNDS = 200
BASE_EDGES = 1 << 16  # edges that one task contracts


def _signature(e: DataFrame, g: list[str]) -> tuple:
    """Row count and an order-free checksum of an edge set (one small row)."""
    h = F.pmod(F.xxhash64(*g, "a", "b"), F.lit(2_147_483_647))
    r = e.agg(F.count(F.lit(1)), F.sum(h)).first()
    return tuple(r)


def _sym(e: DataFrame, g: list[str]) -> DataFrame:
    return e.unionByName(e.select(*g, F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(e: DataFrame, g: list[str]) -> DataFrame:
    """Link every neighbour larger than a node to the node's smallest
    neighbour-or-self."""
    d = _sym(e, g)
    m = d.groupBy(*g, "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = d.join(m, g + ["a"]).filter(F.col("b") > F.col("a")).select(*g, F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter(F.col("a") != F.col("b")).distinct()


def _small_star(e: DataFrame, g: list[str]) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    d = _sym(e, g).filter(F.col("b") < F.col("a"))
    m = d.groupBy(*g, "a").agg(F.min("b").alias("m"))
    spokes = d.join(m, g + ["a"]).select(*g, F.col("b").alias("a"), F.col("m").alias("b"))
    own = m.select(*g, "a", F.col("m").alias("b"))
    out = spokes.unionByName(own).filter(F.col("a") != F.col("b"))
    # keep edges oriented larger -> smaller so the set compares exactly
    return out.select(*g, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _stars(edges: list[tuple]) -> list[tuple]:
    """Edges (group, a, b) of one task -> a star around the smallest node of each of
    their components: (group, node, smallest)."""
    code: dict[tuple, int] = {}
    root: list[int] = []
    for g, a, b in edges:
        ends = []
        for n in (a, b):
            i = code.setdefault((g, n), len(root))
            if i == len(root):
                root.append(i)
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            ends.append(i)
        if ends[0] != ends[1]:
            root[max(ends)] = min(ends)
    least: dict[int, object] = {}
    for (_, n), i in code.items():  # a root is never larger than its nodes
        r = root[i] = root[root[i]]
        if r not in least or n < least[r]:
            least[r] = n
    return [(g, n, least[root[i]]) for (g, n), i in code.items() if n != least[root[i]]]


def contract(edges: DataFrame, g: list[str], size: int, base: int = BASE_EDGES) -> DataFrame:
    """Replace the edges of each task (about ``base``) by stars of their components:
    no component is changed, and at most one edge a node and task is left."""
    parts = max(1, math.ceil(size / base))
    dealt = edges.coalesce(1) if parts == 1 else edges.repartition(parts, *g, "a")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in edges.schema.fields)

    def run(batches):
        rows, like = [], None
        for batch in batches:
            like = batch.schema
            cols = [c.to_pylist() for c in batch.columns]
            rows += zip(zip(*cols[:-2]) if g else [()] * batch.num_rows, cols[-2], cols[-1])
        if rows:
            out = [(*group, a, b) for group, a, b in _stars(rows)]
            cols = list(zip(*out)) if out else [[] for _ in like]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, like)], schema=like)

    return dealt.select(*g, "a", "b").mapInArrow(run, schema)


def connected_components(edges: DataFrame, group: list[str] | None = None,
                         src: str = "src", dst: str = "dst", nodes: DataFrame | None = None,
                         base: int = BASE_EDGES) -> DataFrame:
    """Label every node with the smallest node id of its component.

    ``edges`` holds ``group..., src, dst`` (undirected; ``group`` columns
    keep separate graphs apart, e.g. one per level).  Returns
    ``group..., node, comp``.  Nodes without edges appear only if given in
    ``nodes`` (``group..., node``).

    Each task first contracts its share of about ``base`` edges to stars.  A graph
    of more shares goes on with alternating large-star / small-star rounds (Kiveris et
    al., 2014): O(log^2 n) rounds in the worst case, each a few grouped aggregates over
    the edge list; the loop ends when a round leaves the edge set as it was, which is
    then a star around each component's smallest node.
    """
    g = list(group or [])
    e = edges.select(*g, F.col(src).alias("a"), F.col(dst).alias("b")).filter(F.col("a") != F.col("b"))
    e = cut_lineage(e.select(*g, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    size = e.count()
    cur = cut_lineage(contract(e, g, size, base), "cc")
    cur_sig = _signature(cur, g) if size > base else None
    for _ in range(MAX_ROUNDS if size > base else 0):
        nxt = cut_lineage(_small_star(_large_star(cur, g), g), "cc")
        nxt_sig = _signature(nxt, g)
        # a cheap signature rules out most unchanged-looking rounds; the exact
        # set comparison runs only when it matches
        same = (nxt_sig == cur_sig
                and nxt.join(cur, g + ["a", "b"], "left_anti").limit(1).count() == 0
                and cur.join(nxt, g + ["a", "b"], "left_anti").limit(1).count() == 0)
        cur, cur_sig = nxt, nxt_sig
        if same:
            break
    else:
        if size > base:
            raise RuntimeError("connected components did not converge")

    star = cur.select(*g, F.col("a").alias("node"), F.col("b").alias("comp"))
    centres = cur.select(*g, F.col("b").alias("node"), F.col("b").alias("comp"))
    labels = star.unionByName(centres)
    if nodes is not None:
        labels = labels.unionByName(nodes.select(*g, "node", F.col("node").alias("comp")))
    return labels.groupBy(*g, "node").agg(F.min("comp").alias("comp"))


def resolve_pointers(df: DataFrame, key: list[str], ptr: list[str]) -> DataFrame:
    """Follow ``ptr`` (a key of another row, or equal to the row's own key at
    a root) until it reaches a root; returns ``key..., ptr...`` with every
    pointer at its root.  Pointer doubling: O(log depth) rounds."""
    cur = df.select(*key, *ptr)
    for _ in range(MAX_ROUNDS):
        nxt_map = cur.select(*[F.col(k).alias(f"_k_{k}") for k in key],
                             *[F.col(p).alias(f"_n_{p}") for p in ptr])
        cond = [F.col(p) == F.col(f"_k_{k}") for p, k in zip(ptr, key)]
        nxt = (cur.join(nxt_map, cond, "left")
               .select(*key, *[F.coalesce(F.col(f"_n_{p}"), F.col(p)).alias(p) for p in ptr]))
        nxt = cut_lineage(nxt.join(cur.select(*key, *[F.col(p).alias(f"_o_{p}") for p in ptr]), key), "ptr")
        neq = None
        for p in ptr:
            c = ~F.col(p).eqNullSafe(F.col(f"_o_{p}"))
            neq = c if neq is None else (neq | c)
        changed = nxt.filter(neq).limit(1).count()
        cur = nxt.select(*key, *ptr)
        if changed == 0:
            return cur
    raise RuntimeError("pointer resolution did not converge")
