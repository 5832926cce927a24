"""Mixing, packing, quality, substring dedup, the Jaccard join and the pipeline
against brute force, and the defined edge cases of each."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textmill.llm import jaccard_join as JJ
from textmill.llm import mixing, packing, quality, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# ------------------------------------------------------------------ mixing

def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Share by weight, cap, reshare the excess until nobody is above."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(w[n] for n in open_)
        full = {n for n in open_ if unit * w[n] >= cap * sizes[n]}
        if not full:
            return out | {n: unit * w[n] for n in open_}
        for n in full:
            out[n] = cap * sizes[n]
            left -= out[n]
        open_ -= full
    return out


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_mixing(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.collect()
    got = mixing.mix_counts(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    want = targets(sizes)
    source = {r["doc_id"]: r["source"] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] + r["cut"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + (max(len(words(r["text"])) for r in rows) if table == "edge" else 0)
    again = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix_counts(docs.repartition(5)).collect()}
    if table == "documents":
        assert again == {(r["doc_id"], r["size"]): r["taken"] for r in got}


def test_mix_rows(edge, nothing):
    out = mixing.mix(edge)
    assert out.columns == edge.columns
    assert mixing.mix(nothing).count() == 0 and mixing.mix_counts(nothing).count() == 0


def test_hot_source_is_near_its_target(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    got = (mixing.mix_counts(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source", "target")
           .agg(F.sum("taken").alias("t")).collect())
    assert all(abs(r["t"] - r["target"]) <= 1 for r in got)


# ------------------------------------------------------------------ packing

@pytest.mark.parametrize("table", ["documents", "edge"])
def test_packing(request, table, vocabulary):
    docs = request.getfixturevalue(table)
    lib = Tokenizer.from_file(vocabulary)
    pieces = packing.pack(docs, vocabulary, length=256, packet=64, with_ids=True).collect()
    ends = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends[p["sequence_id"]] and len(p["ids"]) == p["length"]
        assert zlib.crc32(np.array(p["ids"], dtype="<u4").tobytes()) == p["ids_crc32"]
        ends[p["sequence_id"]] += p["length"]
    assert sorted(ends) == list(range(len(ends)))
    assert all(ends[s] == 256 for s in range(len(ends) - 1)) and ends[len(ends) - 1] <= 256
    want, got = Counter(), Counter()
    for r in docs.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want.update((r["doc_id"], i, t) for i, t in enumerate(ids))
    for p in pieces:
        got.update((p["doc_id"], p["start"] + i, t) for i, t in enumerate(p["ids"]))
    assert want == got


def test_windows_follow_the_proportions(documents, vocabulary):
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    pieces = packing.pack(documents, vocabulary, length=2048, packet=256).collect()
    total = Counter()
    for p in pieces:
        total[source[p["doc_id"]]] += p["length"]
    all_ids = sum(total.values())
    seen = Counter()
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        seen[source[p["doc_id"]]] += p["length"]
        done = sum(seen.values())
        s = source[p["doc_id"]]
        # credits and debts of a queue stay below one packet, and the stream is cut within a round
        assert abs(seen[s] - done * total[s] / all_ids) <= 256 + 2 * 2048 * total[s] / all_ids + len(total) * 256 * total[s] / all_ids


def test_sequences(edge, nothing, vocabulary):
    out = packing.sequences(edge, vocabulary, length=256, packet=64).collect()
    assert all(len(r["ids"]) == 256 or len(r["ids"]) == r["n_tokens"] for r in out)
    assert packing.pack(nothing, vocabulary).count() == 0


# ------------------------------------------------------------------ quality

def brute_stats(text):
    ws = words(text)
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    cover = set()
    for i in range(len(ws) - 4):
        if grams[tuple(ws[i:i + 5])] > 1:
            cover.update(range(i, i + 5))
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover))


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_quality_statistics(request, table):
    docs = request.getfixturevalue(table)
    want = Counter((r["doc_id"], *brute_stats(r["text"])) for r in docs.collect())
    got = quality.judge(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                   for r in got) == want
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_outliers(spark, nothing):
    rng = random.Random(1)
    rows = [(i, " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 400))),
             "en", "s") for i in range(300)]
    rows += [(1000 + i, "### $$$ " + " ".join(f"#{i}${j}|" for j in range(100)), "en", "s") for i in range(20)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i] for i in range(20)) and all(got[i] for i in range(300))
    assert quality.judge(nothing).count() == 0


# ------------------------------------------------------------------ substring dedup

def brute_removed(rows, window):
    """rows: (doc_id, text), in order; one entry a document."""
    seen, out = set(), {}
    for d, text in rows:
        ws, cover = words(text), set()
        for p in range(len(ws) - window + 1):
            key = tuple(ws[p:p + window])
            if key in seen:
                cover.update(range(p, p + window))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(ws) if i not in cover)
        out[d] = (len(ws), len(cover), hashlib.sha256(kept.encode()).hexdigest())
    return out


def passages(seed, n=120):
    """Documents that share, edit, overlap and repeat passages."""
    rng = random.Random(seed)
    pool = [[f"v{rng.randint(0, 60)}" for _ in range(rng.randint(15, 60))] for _ in range(12)]
    rows = []
    for d in range(n):
        ws = []
        for _ in range(rng.randint(1, 6)):
            part = list(rng.choice(pool))
            if rng.random() < 0.5:
                part = part[rng.randint(0, 10):]
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = "edit"
            ws += part if rng.random() < 0.7 else [f"u{rng.randint(0, 10 ** 6)}" for _ in range(30)]
        if d % 17 == 0:
            ws = ["again", "and"] * 40
        rows.append((d, " ".join(ws)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dedup_brute_force(spark, seed, monkeypatch):
    rows = passages(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(substring_dedup._slices, "__defaults__", (2000,))  # many small batches
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove(docs).collect()}
    assert got == brute_removed(rows, 20)


def test_dedup_edges(edge, nothing):
    got = substring_dedup.remove(edge.select("doc_id", "text")).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_words"] == 0 and by[7]["n_removed"] == 0  # a repeated row is no earlier text
    assert by[8]["n_removed"] == 300 and by[9]["n_removed"] > 500
    assert substring_dedup.remove(nothing).count() == 0
    out = substring_dedup.deduplicate(edge, window=20)
    assert out.columns == edge.columns and {r["doc_id"] for r in out.collect()} == {1, 2, 3, 4, 5, None, 6, 7, 9}


@pytest.mark.parametrize("id_", [None, 7])
def test_dedup_tells_apart_texts_of_one_id(spark, id_):
    rng = random.Random(4)
    pool = [[f"v{rng.randint(0, 10 ** 6)}" for _ in range(rng.randint(20, 60))] for _ in range(300)]
    rows = [(i, id_, " ".join([*rng.choice(pool), *(f"u{i}x{j}" for j in range(rng.randint(1, 90))), *rng.choice(pool)]))
            for i in range(3000)]
    docs = spark.createDataFrame(rows, "n long, doc_id long, text string").repartition(5)
    order = [(r["n"], r["text"]) for r in docs.orderBy(F.xxhash64("text")).select("n", "text").collect()]
    got = {r["n"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove(docs).collect()}
    assert got == brute_removed(order, 20)


# ------------------------------------------------------------------ Jaccard join

def brute_components(rows, k, percent):
    sets = {}
    for d, text in rows:
        ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[d] = {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a1, b1 = find(a), find(b)
                root[max(a1, b1)] = min(a1, b1)
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(seed, n=140):
    rng = random.Random(seed)
    base = [[f"W{rng.randint(0, 10 ** 4)}" for _ in range(rng.randint(3, 120))] for _ in range(10)]
    rows = []
    for d in range(n):
        ws = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            ws[rng.randrange(len(ws))] = f"e{rng.randint(0, 3)}"
        rows.append((d, " ".join(ws) if rng.random() < 0.9 else " ".join(ws).lower()))
    return rows


@pytest.mark.parametrize("seed,k,percent,block", [(1, 4, 85, 512), (2, 4, 85, 16), (3, 5, 80, 16), (4, 2, 70, 8)])
def test_join_brute_force(spark, seed, k, percent, block, monkeypatch):
    monkeypatch.setattr(JJ, "BLOCK", block)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in JJ.components(docs, k=k, percent=percent).collect()}
    assert got == brute_components(rows, k, percent)


@pytest.mark.parametrize("seed", range(8))
def test_region_recursion_loses_no_link(seed):
    rng = random.Random(seed)
    base = [rng.randrange(1 << 60) for _ in range(60)]
    sets = []
    for _ in range(40):
        s = set(base[:rng.randint(20, 60)]) | {rng.randrange(1 << 60) for _ in range(rng.randint(0, 12))}
        sets.append(np.array(sorted(s), dtype=np.uint64))
    links = JJ.join_region(sets, 85)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = set(sets[a].tolist()), set(sets[b].tolist())
        assert 100 * len(x & y) >= 85 * len(x | y)
        root[find(a)] = find(b)
    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            assert 100 * len(x & y) < 85 * len(x | y) or find(a) == find(b)


def test_join_edges(edge, nothing):
    got = JJ.components(edge).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert by[1] == (0, 1) and by[3] == (0, 3) and by[4] == (1, 4) and by[5] == (1, 4) and by[7][1] == 7
    assert by[None][1] is None
    assert JJ.components(nothing).count() == 0
    kept = JJ.keep_one(edge, k=4, percent=85)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == edge.columns and Counter(ids) == Counter([1, 2, 3, 4, None, 6, 7, 8, 9])


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, edge, nothing, tmp_path):
    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "passages", "mixing", "packing"]
    for start, some in ((spark.read.parquet(f"{sf}/documents.parquet"), True), (edge, True), (nothing, False)):
        docs, columns = start, start.columns
        for i, (_, step) in enumerate(corpus_pipeline.STAGES):
            out = str(tmp_path / f"{start.count()}-{len(columns)}-{some}-{i}")
            step(spark, docs, sf).write.parquet(out)
            docs = spark.read.parquet(out)
            if i < 4:
                assert docs.columns == columns
        assert (docs.count() > 0) == some


def test_pipeline_decisions(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    left = {r["toxic"]: r["n"] for r in clean.join(labels, "doc_id").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    all_ = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    assert left[0] >= 0.95 * all_[0] and left.get(1, 0) <= 0.4 * all_[1]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    one = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()}
    want = brute_components(rows[:300], 5, 80)
    few = spark.createDataFrame(rows[:300], "doc_id long, text string")
    assert {r["doc_id"] for r in JJ.keep_one(few).collect()} == {d for d, (_, c) in want.items() if c == d}
    assert len(one) < len(rows)


CLASHING = ("target source_size _h copies _rank _size _copy n_words n_removed kept_sha256 kept_text _tag _id _t _ats _row "
            "_doc _skey _cls g th row size n cls keep kept label").split()


def test_user_columns_keep_their_values(spark):
    """Columns with the operators' own names come through all stages but the last, row by row."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{i}x{j}" for j in range(80)) for i in range(12)]
    texts += [texts[0], passage + " " + texts[1][:90], passage + " end of it " + texts[2][:90]]
    rows = [(i, t, "en", "ab"[i % 2], len(t), *[f"{c}:{i}" for c in CLASHING]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` string" for c in CLASHING))
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[c] == f"{c}:{r['doc_id']}" for r in got for c in CLASHING), name
        assert len({r["doc_id"] for r in got}) >= 12, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert pieces.select("doc_id").distinct().count() == len(rows)


def test_keep_one_of_shared_and_missing_ids(spark):
    """Unlinked texts of one id both stay; copies without id are reduced; the smallest id of a group stays."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a + " more"
    rows = [(1, a), (1, b), (1, a), (2, near), (None, a), (None, c), (None, c), (3, c + " tail"), (5, ""), (5, ""), (6, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, JJ.keep_one(docs, k=5, percent=80).collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (3, c + " tail"), (5, ""), (6, ""), (None, None)], key=repr)
    only = spark.createDataFrame([(None, c), (None, c), (None, c + " x"), (None, a)], "doc_id long, text string")
    kept = [r["text"] for r in JJ.keep_one(only).collect()]
    assert len(kept) == 2 and a in kept
    assert {(r["doc_id"], r["component_id"]) for r in JJ.components(only).collect()} == {(None, None)}


def test_every_code_point_in_packing(vocabulary):
    """Ids by ranks are the library's for every character, alone, in words and after blanks."""
    import numpy as np
    from textmill.llm.packing import Encoder
    enc = Encoder(vocabulary)
    assert enc.table is not None
    points = [c for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    for s in range(0, len(points), 8192):
        batch = [f"a{c}b {c} 1{c}{c}2 {c}" for c in map(chr, points[s:s + 8192])]
        want = enc.library.encode_batch_fast(batch, add_special_tokens=False)
        assert enc.encode(batch) == [np.asarray(w.ids, dtype=enc.dtype).tobytes() for w in want]
    odd = ["<|endoftext|>x <|endoftext|> <|endoftext", "", None, " \n\n x\t ", "I'LL don'T 've", "a" * 4000]
    want = [enc.library.encode(t or "", add_special_tokens=False).ids for t in odd]
    assert enc.encode(odd) == [np.asarray(w, dtype=enc.dtype).tobytes() for w in want]
    import public_tokenizers
    other = Encoder(public_tokenizers.path("word_bpe_49k.json"))  # not byte-level: the library's own way
    assert other.table is None and other.encode(["Two words"]) == [
        np.asarray(other.library.encode("Two words", add_special_tokens=False).ids, dtype=other.dtype).tobytes()]
