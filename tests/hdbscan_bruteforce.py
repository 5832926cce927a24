"""Brute-force oracle for tests only: single-linkage tree from spanning-tree
edges, condensed by minimum cluster size, excess-of-mass selection (root
excluded).  Sequential and in memory, written from the published algorithm;
used to check the distributed operator on small fixtures."""

from __future__ import annotations

import numpy as np


def labels_from_tree(n: int, edges, mcs: int) -> np.ndarray:
    """``edges``: iterable of (u, v, w) over points 0..n-1."""
    # ties merge in (w, u, v) order, u < v
    e = sorted(((min(u, v), max(u, v), w) for u, v, w in edges), key=lambda t: (t[2], t[0], t[1]))
    parent = list(range(2 * n))
    size = [1] * n + [0] * n
    children = {}
    wt = {}
    nxt = n

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v, w in e:
        a, b = find(int(u)), find(int(v))
        node = nxt
        nxt += 1
        parent[a] = parent[b] = node
        size[node] = size[a] + size[b]
        children[node] = (a, b)
        wt[node] = w
    root = nxt - 1

    def leaves(x):
        out, st = [], [x]
        while st:
            y = st.pop()
            if y < n:
                out.append(y)
            else:
                st.extend(children[y])
        return out

    # condensed tree: (parent_cluster, child, lambda, child_size)
    lam = lambda w: np.inf if w <= 0 else 1.0 / w
    clusters = {root: 0.0}  # cluster id -> birth lambda
    cparent = {}
    fell = {}   # point -> (cluster, lambda)
    stab = {root: 0.0}
    stack = [(root, root)]
    while stack:
        node, cl = stack.pop()
        if node < n:
            continue
        l = lam(wt[node])
        a, b = children[node]
        sa = size[a] if a >= n else 1
        sb = size[b] if b >= n else 1
        big_a, big_b = sa >= mcs, sb >= mcs
        if big_a and big_b:
            for c in (a, b):
                clusters[c] = l
                cparent[c] = cl
                stab[c] = 0.0
                stab[cl] += (size[c] if c >= n else 1) * (l - clusters[cl])
                stack.append((c, c))
        else:
            for c, big in ((a, big_a), (b, big_b)):
                if big:
                    stack.append((c, cl))
                else:
                    for p in leaves(c):
                        fell[p] = (cl, l)
                        stab[cl] += l - clusters[cl]
    # excess of mass, children before parents (larger ids are later merges; walk by depth)
    order = sorted(clusters, key=lambda c: -clusters[c])
    kids = {}
    for c, p in cparent.items():
        kids.setdefault(p, []).append(c)
    best = dict(stab)
    sel = {c: True for c in clusters if c != root}
    for c in order:
        if c == root:
            continue
        sub = sum(best[k] for k in kids.get(c, []))
        if sub > stab[c]:
            sel[c] = False
            best[c] = sub
        else:
            st = list(kids.get(c, []))
            while st:
                k = st.pop()
                sel[k] = False
                st.extend(kids.get(k, []))
    chosen = sorted(c for c, s in sel.items() if s)
    num = {c: i for i, c in enumerate(chosen)}
    out = np.full(n, -1)
    for p in range(n):
        c = fell.get(p, (root, 0))[0]
        while c != root and not sel.get(c, False):
            c = cparent[c]
        if c != root:
            out[p] = num[c]
    return out
