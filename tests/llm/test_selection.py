"""Importance resampling, exact dedup by recipes and the filter audit against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from textmill.llm import chunk_recipes, filter_audit, importance
from textmill.llm.ngram_table import NgramTable, interned, xxhash64

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
FEATURE = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
texts = st.lists(st.text(alphabet="aZ09 é日_\n", max_size=60), max_size=12)


def grams(text, n):
    ws = FEATURE.findall((text or "").translate(LOWER))
    return [" ".join(ws[i:i + k]) for k in range(1, n + 1) for i in range(len(ws) - k + 1)], len(ws)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=80), min_size=1, max_size=20))
def test_hash_is_xxhash64(parts):
    lens = np.array([len(p) for p in parts])
    starts = np.cumsum(lens) - lens
    buf = np.frombuffer(b"".join(parts) + bytes(16), dtype=np.uint8).copy()
    assert xxhash64(buf, starts, lens).tolist() == [xxhash.xxh64_intdigest(p) for p in parts]


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 3), st.sampled_from([8, 40, 1 << 20]))
def test_interned_counts(rows, n, slice_bytes):
    """Also where a text is longer than a slice, so n-grams cross the cut."""
    words, features, buckets = [0] * len(rows), [Counter() for _ in rows], 97
    for first, k, table, text, n_words in interned(pa.array(rows, pa.string()), buckets, n, slice_bytes):
        assert np.array_equal(np.bincount(table.slot, minlength=len(table.count)), table.count)
        for i in range(k):
            words[first + i] += int(n_words[i])
        for t, b in zip(text.tolist(), table.bucket[table.slot].tolist()):
            features[first + t][b] += 1
    for i, row in enumerate(rows):
        want, count = grams(row, n)
        assert words[i] == count
        assert features[i] == Counter(zlib.crc32(g.encode()) % buckets for g in want)


def test_colliding_keys_keep_apart():
    """Every n-gram under one key: the bytes tell them apart, also beyond 64 bytes."""
    parts = [b"a", b"b", b"a", b"abcdefghi", b"abcdefghj", b"b", b"x" * 90, b"x" * 89 + b"y", b"x" * 90, b""]
    lens = np.array([len(p) for p in parts])
    starts = np.cumsum(lens) - lens
    buf = np.frombuffer(b"".join(parts) + bytes(16), dtype=np.uint8).copy()
    table = NgramTable(buf, starts, lens, 1000, hashes=lambda b, s, m: np.full(len(s), 7, dtype=np.uint64))
    got = [parts[[i for i, s in enumerate(table.slot) if s == slot][0]] for slot in table.slot]
    assert got == parts and sorted(table.count.tolist()) == [1, 1, 1, 1, 2, 2, 2]


def resampled(rows, target, percent, min_words, buckets, n):
    raw, tgt = Counter(), Counter()
    for _, t in rows:
        raw.update(zlib.crc32(g.encode()) % buckets for g in grams(t, n)[0])
    for t in target:
        tgt.update(zlib.crc32(g.encode()) % buckets for g in grams(t, n)[0])
    s, t = sum(raw.values()), sum(tgt.values())
    gain = [math.floor(1000 * math.log((tgt[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        g, n_words = grams(text, n)
        w = sum(gain[zlib.crc32(x.encode()) % buckets] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    fit = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(fit) // 100
    rows_out = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(fit)]
    return sorted(rows_out + [(*r[:4], None) for r in out if r[4] < min_words], key=repr)


@pytest.mark.parametrize("n,percent", [(1, 50), (2, 100)])
def test_resampling_of_odd_rows(spark, edge, nothing, n, percent):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    target = ["One two THREE", None, "w1 w2 w3 same same"]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.score_documents(edge, t, percent=percent, min_words=2, buckets=50, max_n=n)
    assert sorted(map(tuple, got.collect()), key=repr) == resampled(rows, target, percent, 2, 50, n)
    assert importance.score_documents(nothing, t).count() == 0
    assert importance.score_documents(edge, t.limit(0), min_words=2).count() == len(rows)
    kept = importance.resample(edge, t, percent=percent, min_words=2, buckets=50, max_n=n)
    assert kept.columns == edge.columns and kept.filter("copies is not null and copies != 'x'").count() == 0


def test_resampling_query(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    t = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = E.queries()["op11_importance_resampling"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == resampled([tuple(r) for r in d], t, 10, 20, 10_000, 1)


def grouped(rows):
    low = [(i, (t or "").translate(LOWER)) for i, t in rows]
    by = {}
    for i, t in low:
        by.setdefault(t, []).append(i)
    top = {t: max(ids, key=lambda x: (x is not None, x)) for t, ids in by.items()}
    return sorted(((i, top[t], len(by[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in low), key=repr), by


@pytest.mark.parametrize("key_bytes", [1, 16])
def test_recipes_of_odd_rows(spark, edge, nothing, key_bytes):
    """One byte of identifier makes chunks collide; the attempts with longer ones are right."""
    import random
    rng = random.Random(5)
    long = " ".join(rng.choice(["Alpha", "beta", "Gamma", "x1", "é"]) for _ in range(30_000))
    more = [(100 + i, " ".join(rng.choice("abcdefghij") for _ in range(400))) for i in range(40)]
    more += [(200, long), (201, long.upper()), (202, long.replace("é", "e")), (203, long + "!"), (204, "a" * 50_000),
             (205, "A" * 50_000), (206, "a" * 50_001), (None, "A" * 50_000), (207, "É"), (208, "é"), (208, "é"), (None, "lost"),
             (None, "Lost")]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    docs = edge.select("doc_id", "text", F.lit("k").alias("kept"), F.lit(1).alias("group_size")).unionByName(
        extra.select("doc_id", "text", F.lit("k").alias("kept"), F.lit(1).alias("group_size")))
    out = chunk_recipes.groups(docs, key_bytes=key_bytes).collect()
    want, by = grouped([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=repr) == want
    kept = [r for r in out if r.kept]
    assert len(kept) == len(by) and all(r.doc_id == r.keep_id for r in kept)
    left = chunk_recipes.deduplicate(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in kept}
    assert chunk_recipes.groups(nothing).count() == 0


def test_recipe_chunks_are_content_defined():
    import random
    rng = random.Random(1)
    data = bytes(rng.randrange(97, 123) for _ in range(200_000))
    ends = chunk_recipes.chunk_ends(chunk_recipes.cut_places(data), 0, len(data))
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert sum(sizes) == len(data) and max(sizes) <= chunk_recipes.MAX_CHUNK and min(sizes[:-1]) >= chunk_recipes.MIN_CHUNK
    moved = b"0" * 777 + data
    again = chunk_recipes.chunk_ends(chunk_recipes.cut_places(moved), 0, len(moved))
    shared = {data[a:b] for a, b in zip([0, *ends], ends)} & {moved[a:b] for a, b in zip([0, *again], again)}
    assert len(shared) > 0.9 * len(ends)  # only the chunks beside the change differ


def audited(masks, letters):
    """masks: (part, mask, good, toxic) per document."""
    out = []
    for part in {m[0] for m in masks}:
        mine, shapley, rows = [m for m in masks if m[0] == part], Counter(), []
        for order in itertools.permutations(range(len(letters))):
            applied = 0
            for step, f in enumerate(order, 1):
                bit = 1 << f
                gone = [m for m in mine if not m[1] & applied and m[1] & bit]
                rows.append((part, "".join(letters[i] for i in order), step, sum(not m[1] & (applied | bit) for m in mine), len(gone),
                             sum(bool(m[1] & applied and m[1] & bit) for m in mine), sum(m[1] == bit for m in mine),
                             sum(m[2] for m in gone), sum(m[3] for m in gone)))
                shapley[letters[f]] += len(gone)
                applied |= bit
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def test_audit_of_odd_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (7, 1, 1), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text or "", r.lang or "") for r in edge.collect()]
    good, toxic = {4, 7}, {4, 7}
    masks = []
    for i, t, part in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        equal = [j for j, u, _ in rows if u == t and j is not None and (i is None or j < i)]
        bits = [len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                bool(re.search(r"[#$%&*|]", t)), bool(equal)]
        masks.append((part, sum(b << k for k, b in enumerate(bits)), i in good, i in toxic))
    got = filter_audit.audit_documents(edge, labels)
    assert sorted(map(tuple, got.collect())) == audited(masks, "ABCDE")
    assert filter_audit.audit_documents(nothing, labels).count() == 0
    assert filter_audit.audit_documents(edge, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_of_many_parts(spark):
    """More parts than any row limit of a recursion over parts would let through."""
    rows = spark.range(6000).select((F.col("id") % 3000).cast("string").alias("part"), (F.col("id") % 2 == 0).alias("P"),
                                    (F.col("id") % 5 == 0).alias("Q"), F.lit(True).alias("R"), F.lit(True).alias("good"),
                                    F.lit(False).alias("toxic"))
    out = filter_audit.audit(rows, "PQR").filter("part in ('0', '7')")
    masks = [(str(i % 3000), (i % 2 == 0) + 2 * (i % 5 == 0) + 4, True, False) for i in range(6000) if i % 3000 in (0, 7)]
    assert sorted(map(tuple, out.collect())) == audited(masks, "PQR")
    with pytest.raises(ValueError):
        filter_audit.enumerate_steps(spark, "AA")


@pytest.mark.parametrize("key", ["op11_importance_resampling", "op12_exact_dedup", "op13_filter_audit"])
def test_queries_match_sql(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in rel.description]
    df = E.queries()[key](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(rel.fetchall(), key=repr)
