"""Toxicity by nearest labelled examples: exact weighted cosine over a block-max
inverted index, distance-weighted votes, calibrated scores and evidence.

Fit.  At most ``BANK_TOXIC`` toxic and ``BANK_OTHER`` other labelled documents
(chosen by a hash of the id, so any label table is sampled alike) make the bank.
Every word of their texts is a term, weighed by inverse document frequency
(counted over all documents) and by its evidence: the G-test of its document
counts between the two labels, as a share of ``FULL_G`` and 1 at most.  The bank's vectors go into an
inverted index: postings by term and block of ``BLOCK`` examples, with the
largest weight of every term in every block.  The lists of the ``HEAD`` most frequent
words name most examples; they are kept as full rows.

Score.  The share of the frequent words in all cosines is one matrix product for some
documents at once.  It and the sum of query weight times block maximum over the
other words bound each block: the blocks of highest bound are completed from their
postings first, then every block whose bound reaches the ``K``-th cosine found; the
result equals the full scan.  A word
of no example has no weight, so it counts neither for the cosine nor for the norm.  Neighbours vote with weight
1 / (1 - cosine + 0.1), times the inverse sampling rate of their label.  An
isotonic map, fitted on the bank with each example's own text left out, turns
the vote into a probability.  A document without any word of the bank has the rate
of such examples.  An example with the same text as the document never votes, so no
document is scored by its own label.

Scale.  Texts are read once into sparse term vectors (a stage table); term counts
are partial aggregates; the bank and its words are bounded by the bank's
parameters and the only thing shipped to workers.  Scoring is per row.

Defined cases: null and empty texts have no terms; repeated rows get a row each;
conflicting or repeated labels of one id are reduced to the largest; without any
toxic label every score is 0; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, trimmed

BANK_TOXIC, BANK_OTHER = 2500, 3500
FULL_G = 15.0
BLOCK = 512
HEAD = 512  # words whose lists are full rows
FIRST_BLOCKS, FIRST_SHARE = 2, 0.2  # blocks completed before any is left out
AT_ONCE = 128  # documents in one matrix product
K = 25
ROWS = 512


def terms_of(text: str | None) -> Counter:
    """Lower-case words of a text without punctuation around them."""
    seen: Counter = Counter()
    for w, n in Counter((text or "").split()).items():
        t = _term(w)
        if t:
            seen[t] += n
    return seen


def _term(word: str) -> str:
    i, j = 0, len(word)
    while i < j and not word[i].isalnum():
        i += 1
    while j > i and not word[j - 1].isalnum():
        j -= 1
    return word[i:j].lower()


def fingerprint(text: str | None) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) >> 1


def pick_bank(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the bank; bounded by BANK_TOXIC + BANK_OTHER rows."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))

    def some(label: int, n: int) -> DataFrame:
        return one.where(F.col("toxic") == label).orderBy(F.xxhash64(F.lit("bank"), "doc_id"), "doc_id").limit(n)

    return some(1, BANK_TOXIC).unionByName(some(0, BANK_OTHER))


def bank_terms(bank_texts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Every word of the bank's texts, frequent ones first, and its evidence;
    ``bank_texts``: text, toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                total.update((t, y) for t in terms_of(text))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([total[k] for k in keys], pa.int64())], names=["term", "toxic", "n"])

    sizes = {r["toxic"]: r["n"] for r in bank_texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    df = (bank_texts.select("text", "toxic").mapInArrow(trimmed(run), "term string, toxic int, n long").groupBy("term")
          .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
               F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")))
    got = df.orderBy(F.desc(F.col("a") + F.col("b")), "term").toArrow()
    terms = got.column("term").to_pylist()
    return terms, evidence(got.column("a").to_numpy(), got.column("b").to_numpy(), n1, n0)


def evidence(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Weight from 0 to 1 of words in ``a`` of ``n1`` toxic and ``b`` of ``n0`` other
    examples; 1 for every word if a label is missing."""
    if not n1 or not n0:
        return np.ones(len(a))
    n, g = n1 + n0, np.zeros(len(a))
    for obs, exp in ((a, (a + b) * n1 / n), (b, (a + b) * n0 / n), (n1 - a, (n - a - b) * n1 / n), (n0 - b, (n - a - b) * n0 / n)):
        some = obs > 0
        g[some] += 2 * obs[some] * np.log(obs[some] / exp[some])
    return np.clip(g / FULL_G, 1e-3, 1.0)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every stretch, one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


class Vectors:
    """Sparse term counts of texts; raw words are looked up once."""

    def __init__(self, terms: list[str]):
        self.index = {t: i for i, t in enumerate(terms)}
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        hits: dict[int, int] = {}
        known = self.known
        for w, n in Counter((text or "").split()).items():
            i = known.get(w)
            if i is None:
                if len(known) > 200_000:
                    known.clear()
                i = known[w] = self.index.get(_term(w), -1)
            if i >= 0:
                hits[i] = hits.get(i, 0) + n
        at = np.fromiter(hits, np.int32, len(hits))
        order = at.argsort()
        return at[order], np.fromiter(hits.values(), np.int32, len(hits))[order]


def term_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, fp, terms, counts`` of every document (only the words of the bank)."""
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vectors(terms)
        for b in batches:
            for s in range(0, b.num_rows, ROWS):
                part = b.slice(s, ROWS)
                texts = part.column("text").to_pylist()
                vs = [vector(t) for t in texts]
                ends = pa.array(np.cumsum([0] + [len(v[0]) for v in vs]), pa.int32())
                flat = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([v[i] for v in vs]))) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([fingerprint(t) for t in texts], pa.int64()), *flat],
                    names=["doc_id", "fp", "terms", "counts"])

    return src.mapInArrow(trimmed(run), f"doc_id {id_type}, fp long, terms array<int>, counts array<int>")


def lists(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as arrays."""
    if isinstance(column, pa.ChunkedArray):
        return [x for c in column.chunks for x in lists(c)]
    at = column.offsets.to_numpy()
    return np.split(column.flatten().to_numpy(zero_copy_only=False), at[1:-1] - at[0]) if len(column) else []


class Index:
    """Postings of the bank by term and block, with block maxima; votes and their
    calibration."""

    def __init__(self, vectors: list[tuple[list[int], list[int]]], labels: list[int], fps: list[int], ids: list,
                 idf: np.ndarray, totals: dict[int, int], k: int = K):
        # like with like: tight maxima (bytes of sorted terms sort as the lists do)
        order = sorted(range(len(labels)), key=lambda i: (np.asarray(vectors[i][0], dtype=">i4").tobytes(), fps[i]))
        self.k, self.idf, self.ids = k, idf, [ids[i] for i in order]
        self.y = np.array([labels[i] for i in order], dtype=np.int8)
        self.fp = np.array([fps[i] for i in order], dtype=np.int64)
        units = [self.unit(*vectors[i]) for i in order]
        sizes = np.array([len(at) for at, _ in units], dtype=np.int64)
        row = np.repeat(np.arange(len(order)), sizes)
        term = np.concatenate([at for at, _ in units]) if units else np.empty(0, np.int64)
        by_term = np.lexsort((row, term))
        self.row, term = row[by_term], term[by_term]
        self.w = np.concatenate([w for _, w in units])[by_term] if units else np.empty(0)
        # one entry for each term and block: where its postings start, and their largest weight
        block = self.row // BLOCK
        start = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        self.start, self.block = np.append(start, len(term)), block[start]
        self.size, self.row = np.diff(self.start), self.row.astype(np.int32)
        self.bmax = np.maximum.reduceat(self.w, start) if len(start) else np.empty(0)
        self.first = np.searchsorted(term[start], np.arange(len(idf) + 1))
        self.n_blocks = -(-len(order) // BLOCK)
        sampled = Counter(labels)
        rate = {y: totals.get(y, 0) / max(sampled[y], 1) for y in (0, 1)}
        self.weight = np.array([rate[int(y)] for y in self.y])
        self.empty = self._rate(sizes == 0)
        self.xs, self.ys = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        if len(order):
            self._calibrate(units)

    @property
    def dense(self) -> np.ndarray:
        """The bank's vectors as a full matrix (small banks only)."""
        return self._rows(len(self.idf)).T

    def _rows(self, n: int) -> np.ndarray:
        """The lists of the first ``n`` terms as full rows."""
        last = self.first[n]
        end = self.start[last]
        out = np.zeros((n, len(self.y)))
        out[np.repeat(np.repeat(np.arange(n), np.diff(self.first[:n + 1])), self.size[:last]), self.row[:end]] = self.w[:end]
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "head"}  # made again by each worker

    def frequent(self, units: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the frequent words add to the cosines: a row a document."""
        if "head" not in self.__dict__:
            self.head = self._rows(min(HEAD, len(self.idf)))
        q = np.zeros((len(units), len(self.head)))
        for i, (at, w) in enumerate(units):
            some = at < q.shape[1]
            q[i, at[some]] = w[some]
        return q @ self.head

    def _rate(self, rows: np.ndarray) -> float:
        """Share of toxic among ``rows``; 0 without any toxic label."""
        if not (self.y == 1).any():
            return 0.0
        w, y = self.weight[rows], self.y[rows]
        total, prior = w.sum(), (self.weight * self.y).sum() / self.weight.sum()
        return float((w @ y + prior) / (total + 1.0))

    def unit(self, at: list[int], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        at = np.asarray(at, dtype=np.int64)
        w = (1 + np.log(np.asarray(counts, dtype=np.float64))) * self.idf[at]
        norm = math.sqrt(float(w @ w))
        return at, (w / norm if norm else w)

    def nearest(self, at: np.ndarray, w: np.ndarray, fp: int,
                sims: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the exact ``k`` nearest; ties by row; cosine 0 never counts.
        ``sims``: the document's row of ``frequent``, completed in place."""
        at, w = np.asarray(at, dtype=np.int64), np.asarray(w)
        if sims is None:
            sims = self.frequent([(at, w)])[0]
        mine = np.flatnonzero(self.fp == fp)
        sims[mine] = 0.0
        rare = at >= HEAD
        at, w = at[rare], w[rare]
        first = self.first.take(at)
        n = self.first.take(at + 1) - first
        entry, q = spread(first, n), np.repeat(w, n)
        block = self.block.take(entry)
        bound = np.bincount(block, q * self.bmax.take(entry), self.n_blocks) + 1e-9
        bound += np.maximum.reduceat(sims, np.arange(0, len(sims), BLOCK))
        lead = np.zeros(self.n_blocks, dtype=bool)
        lead[np.argsort(-bound, kind="stable")[:max(FIRST_BLOCKS, int(FIRST_SHARE * self.n_blocks))]] = True
        self._complete(sims, entry, q, lead.take(block), mine)
        least = self._least(sims)
        rest = (bound >= least) & (bound > 2e-9) & ~lead
        if rest.any():
            self._complete(sims, entry, q, rest.take(block), mine)
            least = self._least(sims)
        rows = np.flatnonzero(sims >= max(least - 1e-11, 1e-9))
        return self._top(rows, sims[rows])

    def _least(self, sims: np.ndarray) -> float:
        """The ``k``-th cosine found so far."""
        return float(np.partition(sims, -self.k)[-self.k]) if len(sims) > self.k else 0.0

    def _complete(self, sims: np.ndarray, entry: np.ndarray, q: np.ndarray, pick: np.ndarray, mine: np.ndarray) -> None:
        """Add what the picked entries' postings give; ``mine`` stay 0."""
        at = np.flatnonzero(pick)
        entry = entry.take(at)
        n = self.size.take(entry)
        post = spread(self.start.take(entry), n)
        sims += np.bincount(self.row.take(post), np.repeat(q.take(at), n) * self.w.take(post), len(sims))
        sims[mine] = 0.0

    def _top(self, rows: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sims = np.round(sims, 12)  # sums of other orders agree
        keep = np.lexsort((rows, -sims))[:self.k]
        return rows[keep], sims[keep]

    def vote(self, rows: np.ndarray, sims: np.ndarray) -> float:
        w = self.weight[rows] / (1 - np.minimum(sims, 1.0) + 0.1)
        return float((w @ self.y[rows]) / w.sum())

    def _calibrate(self, units: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Isotonic regression (pool adjacent violators) of label on vote, each
        example without its own text."""
        votes, own = [], []
        for s in range(0, len(self.y), AT_ONCE):
            for i, found in enumerate(self.search(units[s:s + AT_ONCE], self.fp[s:s + AT_ONCE]), s):
                if len(found[0]):
                    votes.append(self.vote(*found))
                    own.append(i)
        if not own:
            return
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # vote sum, label sum, weight
        for j in order:
            i, w = own[j], self.weight[own[j]]
            pools.append([votes[j] * w, float(self.y[i]) * w, w])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.xs = np.array([p[0] / p[2] for p in pools])
        self.ys = np.array([(p[1] + 0.01) / (p[2] + 0.02) for p in pools])

    def search(self, units: list[tuple[np.ndarray, np.ndarray]], fps) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of some documents; none for those without terms."""
        none = np.empty(0, np.int64), np.empty(0)
        return [self.nearest(*u, int(fp), sims) if len(u[0]) else none
                for u, fp, sims in zip(units, fps, self.frequent(units), strict=True)]

    def scores(self, vectors: list[tuple[list[int], list[int]]], fps: list[int]) -> list[tuple[float, list[tuple]]]:
        """(probability, [(id, cosine, label)] of the three nearest) of some documents."""
        if not len(self.y):
            return [(self.empty, [])] * len(vectors)
        return [self._score(*found) for found in self.search([self.unit(*v) for v in vectors], fps)]

    def _score(self, rows: np.ndarray, sims: np.ndarray) -> tuple[float, list[tuple]]:
        if not len(rows):
            return self.empty, []
        p = float(np.interp(self.vote(rows, sims), self.xs, self.ys)) if (self.y == 1).any() else 0.0
        return min(max(p, 0.0), 1.0), [(self.ids[r], float(s), int(self.y[r])) for r, s in zip(rows[:3], sims[:3], strict=True)]


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """(rows, documents that hold each term): counted in each task, only sums move."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, df, rows = Vectors(terms), np.zeros(len(terms), dtype=np.int64), 0
        for b in batches:
            rows += b.num_rows
            for text in b.column("text"):
                df[vector(text.as_py())[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], rows), pa.int64())],
                                         names=["t", "n"])

    got = docs.select("text").mapInArrow(trimmed(run), "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # a row a term
    df, t, n = np.zeros(len(terms) + 1), got.column("t").to_numpy(), got.column("n").to_numpy()
    df[t] = n  # the rows come last
    return int(df[-1]), df[:-1]


def fit(docs: DataFrame, labels: DataFrame, keep_vectors: bool = True) -> tuple[list[str], Index, DataFrame | None]:
    """(terms, index, term vectors of ``docs`` if kept); ``labels``: doc_id, toxic, the
    rows to learn from.  Of the texts of one id the one of the smallest hash is in the bank."""
    bank = stage(pick_bank(labels), "toxic-bank")
    totals = {r["toxic"]: r["n"] for r in labels.where(F.col("toxic").isNotNull())
              .groupBy(F.col("toxic").cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    # the bank is bounded by its parameters (6000 rows of two numbers)
    shown = docs.select("doc_id", "text").join(F.broadcast(bank), "doc_id")
    one = shown.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    texts = stage(one.select("doc_id", F.col("one.text").alias("text"), "toxic"), "toxic-texts")
    terms, share = bank_terms(texts)
    if keep_vectors:
        vectors = stage(term_vectors(docs, terms), "toxic-vectors")
        size, df = vectors.count(), np.zeros(len(terms))
        seen = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).toArrow()
        df[seen.column("t").to_numpy()] = seen.column("n").to_numpy()
    else:
        vectors, (size, df) = None, document_frequencies(docs, terms)
    weight = (np.log((1 + size) / (1 + df)) + 1) * share
    rows = term_vectors(texts, terms).join(F.broadcast(bank), "doc_id").toArrow()
    index = Index(list(zip(lists(rows.column("terms")), lists(rows.column("counts")), strict=True)),
                  *(rows.column(c).to_pylist() for c in ("toxic", "fp", "doc_id")), weight, totals)
    return terms, index, vectors


class Scorer:
    """Scores vectors, each distinct one once."""

    def __init__(self, index: Index):
        self.index, self.known, self.bank = index, {}, set(index.fp.tolist())

    def __call__(self, vectors: list[tuple[list[int], list[int]]], fps: list[int]) -> list[tuple[float, list[tuple]]]:
        if len(self.known) > 20_000:
            self.known.clear()
        keys = [self._key(*v, fp) for v, fp in zip(vectors, fps, strict=True)]
        new = list({key: i for i, key in enumerate(keys) if key not in self.known}.items())
        for s in range(0, len(new), AT_ONCE):
            part = new[s:s + AT_ONCE]
            found = self.index.scores([vectors[i] for _, i in part], [fps[i] for _, i in part])
            self.known.update(zip((key for key, _ in part), found, strict=True))
        return [self.known[key] for key in keys]

    def _key(self, terms: list[int], counts: list[int], fp: int) -> tuple:
        """Equal vectors have equal neighbours unless an example is the text itself."""
        import xxhash
        both = np.concatenate([np.asarray(terms, dtype=np.int32), np.asarray(counts, dtype=np.int32)])
        return xxhash.xxh3_128_digest(both.tobytes()), fp if fp in self.bank else None


def fit_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted, evidence`` for every row of ``docs``."""
    _, index, vectors = fit(docs, labels)
    id_field = vectors.schema["doc_id"].dataType
    id_type = id_field.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    evidence = pa.list_(pa.struct([("doc_id", to_arrow_type(id_field)), ("cosine", pa.float64()), ("toxic", pa.int32())]))
    model = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for b in batches:
            out = scorer(list(zip(lists(b.column("terms")), lists(b.column("counts")), strict=True)),
                         b.column("fp").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([s for s, _ in out], pa.float64()),
                 pa.array([int(s >= 0.5) for s, _ in out], pa.int32()),
                 pa.array([[dict(zip(("doc_id", "cosine", "toxic"), x, strict=True)) for x in e] for _, e in out], evidence)],
                names=["doc_id", "score", "predicted", "evidence"])

    return vectors.select("doc_id", "fp", "terms", "counts").mapInArrow(
        trimmed(run), f"doc_id {id_type}, score double, predicted int, evidence array<struct<doc_id:{id_type},cosine:double,toxic:int>>")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns kept.
    Rows are scored where they are read: no join and no shuffle of texts."""
    terms, index, _ = fit(docs, labels, keep_vectors=False)
    model = docs.sparkSession.sparkContext.broadcast((terms, index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ix = model.value
        vector, scorer = Vectors(names), Scorer(ix)
        for b in batches:
            for s in range(0, b.num_rows, ROWS):
                part = b.slice(s, ROWS)
                texts = part.column("text").to_pylist()
                out = scorer([vector(t) for t in texts], [fingerprint(t) for t in texts])
                yield part.filter(pa.array([p < threshold for p, _ in out], pa.bool_()))

    return docs.mapInArrow(trimmed(run), docs.schema)
