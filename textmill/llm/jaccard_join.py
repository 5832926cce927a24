"""Exact n-gram Jaccard join in metric space: pivots, Voronoi regions, recursion.

Documents are sets of word shingles; two link when ``100 * |A & B| >= percent *
|A | B|``, a ball of radius eps = 1 - percent / 100 in the Jaccard metric.

Regions.  Linked sets share a shingle among the first ``(1 - percent/100) * n + 1``
of each in any common order (prefix filter), so pivots need not be tried one by
one: for each prefix shingle, the smallest set that has it is the pivot, and every
set belongs to the regions of its pivots - on purpose to all of them, for a linked
pair always meets at the pivot of its first common prefix shingle.  Shingles that
are frequent in a bounded sample come last in the order; this keeps boilerplate
from making regions and changes no result.

Windows.  Within a region, counts of shingles by hash class map sets into an L1
space that never stretches their symmetric difference; a set stays in a region
only if another one lies within the radius there.  Regions of more than ``BLOCK``
sets are dealt into block pairs.

Recursion.  First every set goes to one region only, its home (the smallest pivot
it is near to something at), and homes are joined recursively: exact distances to
a pivot link its ball of radius eps; by the triangle inequality a ball member at
distance x can only link to sets outside the ball with distance up to x + eps, so
members without such a set leave; the rest goes on with the next pivot, until all
is one component or everything was a pivot.  Then sets meet again in the other
regions, but only those near to a set of another home and another component.
Only spanning links leave a task, never all pairs, and a set is shipped once and
then only where two homes meet.

Equal sets are one class from the start, named by a 64-bit fingerprint, and a
batch emits a class once, so a group of copies costs one set.  Sets are shipped
as 48-bit hashes; sizes are counted on 64 bits.  Components come from the
distributed star algorithm.

Defined cases: null and blank texts have empty sets and link with nothing; with
fewer than ``k`` words the whole sequence is the one shingle; rows that share an
id are one node (their links unite); rows without id take part in no link and
have a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.operators.graph import connected_components
from textmill.operators.skew import join_groups

from .common import RangeHashes, WordHashes, drop_table, mix64, release, stage, stage_at, trimmed, words
from .substring_dedup import _slices

CLASSES = 64  # hash classes of the L1 map
# Unrelated sets of n shingles differ by about sqrt(classes * n) in L1, so long
# sets need more classes to be told apart; each fine class lies in one coarse class.
FINE_CLASSES, FINE_FROM = 1024, 1000
BLOCK = 512
SAMPLE_DOCS = 4000
FREQUENT = 50_000


def ascii_lower(text: str | None) -> str:
    """A-Z to a-z, everything else unchanged."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass") if text else ""


def shingle_sets(texts: list[str | None], hashes: WordHashes, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    ws = [words(ascii_lower(t)) for t in texts]
    ranges = RangeHashes(hashes.of([w for x in ws for w in x]))
    grams, out, at = ranges.grams(k), [], 0
    for w in ws:
        n = len(w)
        if n >= k:
            out.append(np.unique(grams[at:at + n - k + 1]))
        elif n:
            out.append(ranges.of(np.array([at]), np.array([at + n])))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += n
    return out


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles that occur in three or more documents of a bounded sample."""
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    ids = ids.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # SAMPLE_DOCS ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for part in _slices(b):
                sets = shingle_sets(part.column("text").to_pylist(), hashes, k)
                if sets:
                    h, n = np.unique(np.concatenate(sets), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    counts = sample.select("text").mapInArrow(trimmed(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.where("n >= 3").orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    return np.sort(np.array([r["h"] for r in top], dtype=np.int64).view(np.uint64))


def _prefix(s: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set in the common order: rare ones, then frequent
    ones, each by hash (the flag replaces the lowest bit of the hash)."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        common = (frequent[at] == s).astype(np.uint64)
    else:
        common = np.zeros(len(s), dtype=np.uint64)
    order = (mix64(s) >> np.uint64(1)) | (common << np.uint64(63))
    n = len(s) - -(-percent * len(s) // 100) + 1
    return np.partition(order, n - 1)[:n]


def signatures(docs: DataFrame, frequent: np.ndarray, k: int, percent: int) -> DataFrame:
    """``doc_id, n, cls, sig, fine, keys`` of every row; ``sig, keys`` (and ``fine``
    for long sets) only for the first row of a class in its batch."""
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, salt = WordHashes(), np.uint64(0xA0761D6478BD642F)
        for b in batches:
            for part in _slices(b):
                sets = shingle_sets(part.column("text").to_pylist(), hashes, k)
                named = part.column("doc_id").is_valid().to_pylist()
                cls, sig, fine, keys, seen = [], [], [], [], set()
                for s, has_id in zip(sets, named, strict=True):
                    c = int(mix64(mix64(s ^ salt).sum(dtype=np.uint64, keepdims=True) + s.sum(dtype=np.uint64) * salt
                                  + np.uint64(len(s))).view(np.int64)[0])
                    first = bool(len(s)) and has_id and c not in seen
                    if first:
                        seen.add(c)
                    cls.append(c)
                    count = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=CLASSES)
                    sig.append(np.minimum(count, 65535).astype("<u2").tobytes() if first else None)
                    long = first and len(s) > FINE_FROM
                    count = np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=FINE_CLASSES) if long else None
                    fine.append(np.minimum(count, 65535).astype("<u2").tobytes() if long else None)
                    keys.append(_prefix(s, frequent, percent).view(np.int64) if first else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.int64()),
                     pa.array(sig, pa.binary()), pa.array(fine, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "cls", "sig", "fine", "keys"])

    return src.mapInArrow(trimmed(run), f"doc_id {id_type}, n long, cls long, sig binary, fine binary, keys array<long>")


CELL = ["p", "bi", "bj"]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows with the same CELL values (the input is sorted by them);
    a cell has at most two blocks of documents, so it fits in memory."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t])
        if not t.num_rows:
            continue
        edge = np.zeros(t.num_rows, dtype=bool)
        for c in CELL:
            codes = t.column(c).combine_chunks().dictionary_encode()
            codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
            edge[1:] |= np.diff(codes.indices.to_numpy(zero_copy_only=False)) != 0
        starts = [0, *np.flatnonzero(edge).tolist()]
        for lo, hi in zip(starts, starts[1:], strict=False):
            yield t.slice(lo, hi - lo)
        held = t.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def _near_rows(sig: np.ndarray, n: np.ndarray, percent: int, home: np.ndarray | None = None,
               comp: np.ndarray | None = None, fine: list[np.ndarray | None] | None = None) -> np.ndarray:
    """Rows that another row may link to by the L1 bound (and the sizes); with
    ``home`` and ``comp`` only rows that differ in both count; with ``fine``
    pairs of long sets must pass the bound on fine classes too."""
    near = np.zeros(len(n), dtype=bool)
    for i in range(len(n) - 1):
        l1 = np.abs(sig[i + 1:] - sig[i]).sum(1)
        hit = (100 + percent) * l1 <= (100 - percent) * (n[i + 1:] + n[i])
        if home is not None:
            hit &= (home[i + 1:] != home[i]) & (comp[i + 1:] != comp[i])
        if fine is not None and fine[i] is not None:
            for j in np.flatnonzero(hit).tolist():
                other = fine[i + 1 + j]
                if other is not None:
                    l1 = int(np.abs(other - fine[i]).sum())
                    hit[j] = (100 + percent) * l1 <= (100 - percent) * (n[i + 1 + j] + n[i])
        if hit.any():
            near[i] = True
            near[i + 1:] |= hit
    return near


def join_region(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Spanning links of a region: for every linked pair of rows, both ends are
    in one component of the result, and every link returned is a true one."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    comp, links = np.arange(m), []
    active, todo = np.ones(m, dtype=bool), np.ones(m, dtype=bool)
    mark = np.zeros(len(values), dtype=bool)
    eps = (100 - percent) / 100
    while True:
        pivots = np.flatnonzero(active & todo)
        if not len(pivots):
            break
        u = int(pivots[0])
        todo[u] = False
        rest = np.flatnonzero(active & (comp != comp[u]))
        if not len(rest):
            break  # all that is active is one component
        own = codes[offsets[u]:offsets[u + 1]]
        mark[own] = True
        counts = np.concatenate([[0], np.cumsum(mark[codes])])
        mark[own] = False
        inter = (counts[offsets[1:]] - counts[offsets[:-1]])[rest]
        union = sizes[rest] + sizes[u] - inter
        linked = 100 * inter >= percent * union
        far = 1 - inter / union
        ball, outside = rest[linked], rest[~linked]
        for x in ball.tolist():
            if comp[x] != comp[u]:
                links.append((u, x))
                comp[comp == comp[x]] = comp[u]
        active[u] = False  # it has been compared with all that could be new to it
        if len(outside):
            # a member of the ball goes on only if something beyond it may lie within eps
            outside_far = far[~linked][comp[outside] != comp[u]]
            reach = outside_far.min() if len(outside_far) else np.inf
            active[ball[far[linked] + eps + 1e-9 < reach]] = False
        else:
            active[ball] = False
    return links


def _pack48(s: np.ndarray) -> bytes:
    return s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unpack48(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    wide[:, 2:] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def links(docs: DataFrame, *, k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(rows, links): ``doc_id, n, cls`` of every row (``cls``: the class of its set),
    and spanning links ``src, dst`` between classes."""
    spark = docs.sparkSession
    full, path = stage_at(signatures(docs, frequent_shingles(docs, k), k, percent), "jaccard-keys")
    rows = stage(full.select("doc_id", "n", "cls", "sig", "fine"), "jaccard-sets")
    keys = full.where("keys is not null").select(F.col("cls").alias("x"), F.explode("keys").alias("key")).repartition("key")
    # a key's classes are one a batch at most, however many copies there are
    same = Window.partitionBy("key")
    regions = (keys.select("x", F.min("x").over(same).alias("p"), F.max("x").over(same).alias("q"))
               .where("p != q").select("p", "x").distinct())
    regions = stage(regions, "jaccard-regions")
    del full, keys
    drop_table(spark, path)
    release(spark)
    classes = stage(rows.where("sig is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("fine").alias("fine")).withColumnRenamed("cls", "x"), "jaccard-classes")
    blocks = (regions.groupBy("p").agg(F.count(F.lit(1)).alias("c"))
              .select("p", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    coarse = stage(_active(_dealt(regions, blocks).join(classes.select("x", "n", "sig"), "x"), percent), "jaccard-coarse")
    near = stage(_active(coarse.join(classes.select("x", "n", "sig", "fine"), "x"), percent)
                 .select("p", "x").distinct(), "jaccard-near")
    # first round: every set in its home
    homes = stage(near.groupBy("x").agg(F.min("p").alias("home")), "jaccard-homes")
    at_home = homes.select(F.col("home").alias("p"), "x")
    sizes = (at_home.groupBy("p").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
             .select("p", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    sets, shipped = stage_at(_sets(docs, homes.select("x").join(classes.select("x", "rep"), "x"), k), "jaccard-shipped")
    release(spark)
    first = stage(_join_cells(_dealt(at_home, sizes), sets, percent), "jaccard-home-links")
    # second round: other regions, where sets of two homes and components are near
    comp = stage(connected_components(first), "jaccard-components")
    known = (near.join(homes, "x").join(comp.select(F.col("node").alias("x"), "comp"), "x", "left")
             .select("p", "x", "home", F.coalesce("comp", "x").alias("comp")))
    mixed = known.groupBy("p").agg(F.min("home").alias("a"), F.max("home").alias("b"), F.min("comp").alias("c"),
                                   F.max("comp").alias("d"), F.count(F.lit(1)).alias("n")).where("a != b and c != d")
    mixed = mixed.select("p", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    open_ = stage(_active(_dealt(known, mixed).join(classes.select("x", "n", "sig", "fine"), "x"), percent), "jaccard-open")
    second = stage(_join_cells(open_, sets, percent), "jaccard-links")
    drop_table(spark, shipped)
    release(spark)
    return rows.select("doc_id", "n", "cls"), first.unionByName(second)


def _dealt(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """Members of each region in the block pairs they belong to."""
    own = F.pmod(F.xxhash64(F.lit("block"), "x"), F.col("blocks")).cast("int")
    others = [F.col(c) for c in members.columns if c not in ("p", "x")]
    return (members.join(blocks, "p").withColumn("b", own)
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("p", "x", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), *others))


def _by_cell(df: DataFrame) -> DataFrame:
    return df.repartition(*CELL).sortWithinPartitions(*CELL)


def _active(cells: DataFrame, percent: int) -> DataFrame:
    """``p, bi, bj, x`` of the sets that may have a partner in their cell."""
    two = [c for c in ("home", "comp") if c in cells.columns]
    finer = ["fine"] if "fine" in cells.columns else []
    cells = _by_cell(cells.select(*CELL, "x", "n", "sig", *two, *finer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            if cell.num_rows < 2:
                continue
            raw = b"".join(cell.column("sig").to_pylist())
            sig = np.frombuffer(raw, dtype="<u2").reshape(cell.num_rows, CLASSES).astype(np.int32)
            fine = None
            if finer:
                fine = [None if f is None else np.frombuffer(f, dtype="<u2").astype(np.int32) for f in cell.column("fine").to_pylist()]
            near = _near_rows(sig, cell.column("n").to_numpy(), percent,
                              *([cell.column(c).to_numpy() for c in two] or [None, None]), fine)
            if near.any():
                yield from cell.select([*CELL, "x"]).filter(pa.array(near)).to_batches()

    return cells.mapInArrow(trimmed(run), "p long, bi int, bj int, x long")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``x, s``: the packed set of each wanted class (x, rep: a document that has it)."""
    texts = (docs.select("doc_id", "text").join(wanted.hint("shuffle_hash"), F.col("doc_id") == F.col("rep"))
             .select("x", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for part in _slices(b):
                sets = shingle_sets(part.column("text").to_pylist(), hashes, k)
                yield pa.RecordBatch.from_arrays([part.column("x"), pa.array([_pack48(s) for s in sets], pa.binary())],
                                                 names=["x", "s"])

    return texts.mapInArrow(trimmed(run), "x long, s binary")


def _join_cells(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact join of the sets that meet in each cell: ``src, dst``."""
    met = _by_cell(cells.select(*CELL, "x").join(sets, "x").select(*CELL, "x", "s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            if cell.num_rows < 2:
                continue
            found = join_region([_unpack48(s) for s in cell.column("s").to_pylist()], percent)
            if found:
                x = cell.column("x").to_numpy()
                a, b = (pa.array(x[[f[i] for f in found]]) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([a, b], names=["src", "dst"])

    return met.mapInArrow(trimmed(run), "src long, dst long").distinct()


def _named(docs: DataFrame) -> DataFrame:
    """A row is named by its id and its text's hash, so that texts that share an id (or
    have none) stay apart."""
    return docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th")).alias("doc_id"), "text")


def _members(docs: DataFrame, k: int, percent: int, by_id: bool) -> DataFrame:
    """``doc_id`` (id, th), ``n``, ``g`` (the component of its class; null without
    words), written.  ``by_id``: the texts of one id are one node."""
    members, edges = links(_named(docs), k=k, percent=percent)
    edges = edges.select("src", "dst")
    if by_id:
        # several sets under one id are one node: their classes unite
        shared = members.where("doc_id.id is not null and n > 0").groupBy("doc_id.id").agg(
            F.min("cls").alias("src"), F.max("cls").alias("dst")).where("src != dst")
        edges = edges.unionByName(shared.select("src", "dst"))
    # a row a class that has links
    comp = stage(connected_components(edges), "jaccard-labels").select(F.col("node").alias("cls"), "comp")
    sizes = members.where("n > 0").groupBy("cls").agg(F.count(F.lit(1)).alias("size"))
    comp = stage(comp.join(sizes, "cls"), "jaccard-linked")
    total = members.count()
    linked = join_groups(members.where("n > 0"), comp, "cls", "size", total).select("doc_id", "n", F.col("comp").alias("g"))
    alone = members.where("n > 0").join(comp.select("cls"), "cls", "left_anti").select("doc_id", "n", F.col("cls").alias("g"))
    none = members.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("g"))
    return stage(linked.unionByName(alone).unionByName(none), "jaccard-members")


def components(docs: DataFrame, *, k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    members = _members(docs, k, percent, by_id=True)
    named = members.where("doc_id.id is not null and g is not null")
    # the smallest id of a group; copies are added up in each task first
    smallest = stage(named.groupBy("g").agg(F.min("doc_id.id").alias("component_id"), F.count(F.lit(1)).alias("size")), "jaccard-smallest")
    found = join_groups(named, smallest, "g", "size", members.count()).select("doc_id", "n", "component_id")
    rest = members.where("doc_id.id is null or g is null").select("doc_id", "n", F.col("doc_id.id").alias("component_id"))
    return found.unionByName(rest).select(F.col("doc_id.id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` of each component of texts, all columns kept: that of the
    smallest id (a missing id comes last), of texts that share it the one of the smallest
    hash, of rows that repeat both any one.  Unlinked texts of one id all stay; rows
    without words stay, once for each id and text."""
    members = _members(docs, k, percent, by_id=False)
    best = members.where("g is not null").groupBy("g").agg(
        F.min(F.struct(F.col("doc_id.id").isNull().alias("none"), F.col("doc_id.id").alias("id"), F.col("doc_id.th").alias("th"))).alias("b"))
    stay = best.select("b.id", "b.th").unionByName(members.where("g is null").select("doc_id.id", "doc_id.th").distinct())
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), row.alias("row"))
    stay = stay.select(F.col("id").alias("keep"), F.col("th").alias("kept"))
    rows = rows.join(stay, F.col("id").eqNullSafe(F.col("keep")) & (F.col("th") == F.col("kept")), "left_semi")
    # repeated rows are reduced in each task first
    return rows.groupBy("id", "th").agg(F.first("row").alias("row")).select("row.*")
