"""Clustering: graph helpers, k-means invariants and density clustering."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators.cluster import cluster_density, cluster_kmeans, kmeans_invariants
from textmill.operators.graph import connected_components, resolve_pointers


def test_connected_components_path_and_pair(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "src long, dst long")
    cc = {r.node: r.comp for r in connected_components(e).collect()}
    assert all(cc[i] == 0 for i in range(61)) and cc[100] == cc[101] == 100


def test_connected_components_grouped(spark):
    e = spark.createDataFrame([(0, 1, 2), (0, 2, 3), (1, 1, 2)], "g int, src long, dst long")
    cc = sorted(tuple(r) for r in connected_components(e, ["g"]).collect())
    assert cc == [(0, 1, 1), (0, 2, 1), (0, 3, 1), (1, 1, 1), (1, 2, 1)]


def test_resolve_pointers_chain(spark):
    df = spark.createDataFrame([(i, max(i - 1, 0)) for i in range(40)], "k long, p long")
    got = {r.k: r.p for r in resolve_pointers(df, ["k"], ["p"]).collect()}
    assert set(got.values()) == {0}


@pytest.mark.parametrize("base", [4, 1 << 16])
def test_components_of_one_and_of_many_shares(spark, base):
    rng = np.random.default_rng(0)
    e = [(int(g), int(a), int(b)) for g, a, b in zip(rng.integers(0, 3, 90), rng.integers(0, 60, 90), rng.integers(0, 60, 90))]
    want = {}
    for g, a, b in e:
        if a != b:
            ca, cb = want.setdefault((g, a), {a}), want.setdefault((g, b), {b})
            if ca is not cb:
                ca |= cb
                for x in cb:
                    want[g, x] = ca
    got = connected_components(spark.createDataFrame(e, "g int, src long, dst long"), ["g"], base=base).collect()
    assert {(r.g, r.node): r.comp for r in got} == {k: min(v) for k, v in want.items()}


def _blobs(spark, seed=7, per=25, outliers=0):
    rng = np.random.default_rng(seed)
    rows, lab = [], []
    for c in range(3):
        centre = np.zeros(8)
        centre[c] = 10.0
        for _ in range(per):
            rows.append((centre + rng.normal(0, 0.1, 8)).tolist())
            lab.append(c)
    for i in range(outliers):
        v = np.zeros(8)
        v[3 + i % 5] = 40.0 + 10 * i
        rows.append(v.tolist())
        lab.append(-1)
    data = [(i, [float(x) for x in r], lab[i]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "id long, embedding array<float>, label int")


def test_density_recovers_blobs_and_noise(spark):
    df = _blobs(spark, outliers=3)
    out = cluster_density(df, block_rows=32).select("label", "cluster_label").collect()
    by_label = {}
    for r in out:
        by_label.setdefault(r.label, set()).add(r.cluster_label)
    assert by_label[-1] == {-1}
    found = [by_label[c] for c in range(3)]
    assert all(len(s) == 1 and -1 not in s for s in found)
    assert len(set().union(*found)) == 3


def test_kmeans_invariants(spark):
    df = _blobs(spark)
    labelled, model = cluster_kmeans(df, k=3)
    r = kmeans_invariants(labelled, model).first()
    assert (r.n, r.k, r.size_sum, r.nearest_ok) == (75, 3, 75, True)


def test_kmeans_sends_no_task_a_centre(spark):
    """With many centres the row solver ran a job of ``k`` tasks in every round, each
    bringing its row of the distances between centres to the driver."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 1, (400, 64)))],
                               "id long, embedding array<float>")
    sc, most = spark.sparkContext, 0
    sc.setJobGroup("kmeans-tasks", "")
    try:
        labelled, model = cluster_kmeans(df, k=140)
        tracker = sc.statusTracker()
        for job in tracker.getJobIdsForGroup("kmeans-tasks"):
            for stage in tracker.getJobInfo(job).stageIds:
                info = tracker.getStageInfo(stage)
                most = max(most, info.numTasks if info else 0)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < most < 140
    r = kmeans_invariants(labelled, model).first()
    assert (r.n, r.k, r.size_sum, r.nearest_ok) == (400, 140, 400, True)


def test_hierarchy_matches_bruteforce(spark):
    """Random points with uneven density: the distributed condensed tree and
    selection give the same partition as a sequential implementation."""
    from hdbscan_bruteforce import labels_from_tree
    from textmill.operators.cluster import condensed_labels, core_distances, spanning_tree
    rng = np.random.default_rng(3)
    pts = np.concatenate([rng.normal(0, 1.0, (60, 3)), rng.normal(6, 0.5, (40, 3)),
                          rng.normal((0, 8, 0), 2.0, (40, 3)), rng.uniform(-10, 15, (10, 3))])
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "id long, v array<double>")
    n = len(pts)
    core = core_distances(df, 5, 64, n)
    tree = spanning_tree(df.join(core, "id"), 64, n)
    edges = [(r.u, r.v, r.w) for r in tree.collect()]
    assert len(edges) == n - 1
    for mcs, base in ((5, 64), (12, 1 << 16)):
        want = labels_from_tree(n, edges, mcs)
        _same_partition(want, condensed_labels(tree, df.select("id"), mcs, base))


def _same_partition(want, labels):
    got = {r.id: r.cluster_label for r in labels.collect()}
    assert len(got) == len(want)
    pairs = {}
    for i, w in enumerate(want):
        pairs.setdefault(int(w), set()).add(got[i])
    assert all(len(v) == 1 for v in pairs.values()), pairs
    assert pairs.get(-1, {-1}) == {-1}
    assert len({next(iter(v)) for v in pairs.values()}) == len(pairs)


@pytest.mark.parametrize("weights", ["equal", "zero", "uneven"])
def test_hierarchy_of_many_edges(spark, weights):
    """Six hundred edges of one weight, of weight zero, and 700 uneven points."""
    from hdbscan_bruteforce import labels_from_tree
    from textmill.operators.cluster import condensed_labels
    rng = np.random.default_rng(1)
    n = 700 if weights == "uneven" else 601
    w = {"equal": np.full(n, 2.5), "zero": np.zeros(n), "uneven": np.round(rng.gamma(2.0, 1.0, n), 2)}[weights]
    edges = [(int(rng.integers(max(0, i - 40), i)), i, float(w[i])) for i in range(1, n)]
    tree = spark.createDataFrame(edges, "u long, v long, w double")
    ids = spark.range(n)
    want = labels_from_tree(n, edges, 10)
    _same_partition(want, condensed_labels(tree, ids, 10, 256))


def test_cut_chain_of_clusters(spark):
    """A chain-shaped cluster tree: rounds of the selection stay few."""
    from textmill.operators.cluster import _select
    rows = [(2 * i, 2 * i - 2 if i else None, float((i * 37) % 11) + 1.0) for i in range(60)]
    rows += [(2 * i + 1, 2 * i, float((i * 53) % 7)) for i in range(60)]
    tree = spark.createDataFrame(rows, "c long, par long, stability double")
    got = {r["c"]: r["top"] for r in _select(tree, base=0).collect()}
    assert got == {r["c"]: r["top"] for r in _select(tree).collect()}
    kids = {}
    for c, p, _ in rows:
        kids.setdefault(p, []).append(c)
    st = {c: s for c, _, s in rows}

    def best(c):
        return max(st[c], sum(map(best, kids.get(c, []))))

    def walk(c, top):
        own = c != 0 and not sum(map(best, kids.get(c, []))) > st[c]
        top = top if top is not None else (c if own else None)
        want[c] = top
        for k in kids.get(c, []):
            walk(k, top)

    want = {}
    walk(0, None)
    assert got == want


def test_odd_inputs(spark):
    """One row, few rows, equal rows, repeated and text ids, missing vectors."""
    one = spark.createDataFrame([("D-20", [1.0, 2.0])], "id string, embedding array<double>")
    assert [r["cluster_label"] for r in cluster_density(one).collect()] == [-1]
    same = spark.createDataFrame([("a", [1.0, 2.0])] * 40 + [("b", None)] * 2 + [("c", [50.0, 50.0])], "id string, embedding array<double>")
    out = cluster_density(same, block_rows=16, base_edges=8)
    assert out.count() == 43 and [r["cluster_label"] for r in out.filter("id != 'a'").collect()] == [-1] * 3
    assert cluster_density(one.limit(0)).count() == 0
