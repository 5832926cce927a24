"""Packing documents into token windows with target source proportions.

Deficit round-robin over source queues: each round credits every source with
its share of one window, and a source sends packets (pieces of its documents of
at most ``packet`` tokens) while its credit covers them; what is left, or owed,
carries over to the next rounds.  The schedule has a closed form.  A packet
that starts after S tokens of its queue is sent in round
``floor((S + u * length) / quantum)``, where the quantum is the source's share
of a window and u, fixed by source, is the credit it starts with.  So no state
travels from window to window or from partition to partition: two running sums
(of tokens within a queue, and of tokens over rounds) give every packet its place
in one endless stream, and windows are cut from the stream every ``length`` ids.
All windows but the last are full.

By default a source's share is its share of all tokens, so that all queues last
to the end; ``shares`` sets other proportions by source.

Scale.  Only numbers are shuffled to make the schedule; sums run down trees
(``running_offsets``), so a hot source is split by a hash of its documents.  The
encoded ids are written once and joined to their cuts by row.

Defined cases: null and empty texts have no ids but the closing one; repeated
rows and ids are packed each; a null source is a queue of its own; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import running_offsets, source_key, stage, trimmed

WINDOW = 2048
PACKET = 512
CLOSING_ID = 1
FANOUT = 256
ROUND_BITS = 10
ROWS = 1024
# Fixed value: the published pre-split pattern of byte-level BPE files.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of texts as the ``tokenizers`` library gives them.

    A byte-level BPE file whose merges stand in the order of their ids, with the usual
    pre-split and no normaliser, is the same encoding as a table of byte strings and
    ranks, which ``tiktoken`` applies several times faster; any other file is encoded
    by the library itself.  Strings of special tokens are those tokens in both."""

    def __init__(self, vocabulary: str):
        self.file = vocabulary
        with open(vocabulary, encoding="utf-8") as f:
            file = json.load(f)
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens") or []}
        largest = max([*(file.get("model") or {}).get("vocab", {"": 0}).values(), *self.special.values()])
        self.dtype = "<u2" if largest < 1 << 16 else "<u4"
        self.table = self._table(file)

    def _table(self, file: dict):
        """The encoding as ranks of byte strings; None where that isn't the same."""
        model, split = file.get("model") or {}, file.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                 and not split.get("add_prefix_space") and not file.get("normalizer") and not model.get("dropout")
                 and not model.get("unk_token") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
                 and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in file.get("added_tokens") or []))
        if not plain or model.get("ignore_merges"):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get(x + y, -1) for x, y in merges]
        # printable bytes stand for themselves, the others for the characters from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        tokens = {t: i for t, i in model["vocab"].items() if t not in self.special}
        singles = [i for t, i in tokens.items() if len(t) == 1]
        if made != sorted(made) or len(singles) != 256 or len(tokens) != 256 + len(set(made)) or max(singles) >= (made or [256])[0] or any(
                c not in byte for t in tokens for c in t):
            return None
        import tiktoken
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_SPLIT, special_tokens=self.special,
                                 mergeable_ranks={bytes(byte[c] for c in t): i for t, i in tokens.items()})

    @cached_property
    def library(self):
        """The library's tokenizer; a worker loads it only where the ranks won't do."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.file)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as packed integers."""
        if self.table is None:
            got = self.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [np.asarray(e.ids, dtype=self.dtype).tobytes() for e in got]
        out = []
        for t in texts:
            marked = bool(t) and any(s in t for s in self.special)
            ids = self.table.encode_to_numpy(t or "", allowed_special="all" if marked else set(), disallowed_special=())
            out.append(ids.astype(self.dtype).tobytes())
        return out


_LOADED: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = Encoder(vocabulary)
    return _LOADED[vocabulary]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``uid, doc_id, _skey, n, ids``: the ids of each row with the closing id."""
    src = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id"), source_key(F.col("source")).alias("_skey"), "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        width = np.dtype(enc.dtype).itemsize
        close = np.array([CLOSING_ID], dtype=enc.dtype).tobytes()
        for b in batches:
            for s in range(0, b.num_rows, ROWS):
                part = b.slice(s, ROWS)
                ids = [x + close for x in enc.encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("doc_id"), part.column("_skey"),
                     pa.array([len(x) // width for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["uid", "doc_id", "_skey", "n", "ids"])

    return src.mapInArrow(trimmed(run), f"uid long, doc_id {id_type}, _skey string, n long, ids binary")


def schedule(rows: DataFrame, *, length: int = WINDOW, packet: int = PACKET,
             shares: DataFrame | None = None, order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``uid, start, size, position`` of every packet: its document's ids before
    it, its length, and its place in the stream.  Queues follow a hash of the
    columns ``order``; with ``uid`` in it copies of a document lie apart.

    ``rows``: uid, doc_id, _skey, n.  ``shares``: _skey, share (sums to 1).
    """
    h = F.xxhash64(*order, F.lit("queue"))
    rows = (rows.select("uid", "_skey", "n", h.alias("_h"))
            .withColumns({"_a": F.pmod("_h", F.lit(FANOUT)).cast("int"),
                          "_b": F.pmod(F.shiftright("_h", 8), F.lit(FANOUT)).cast("int")}))
    leaf = ["_skey", "_a", "_b"]
    offsets = running_offsets(rows, leaf, "n", "_off")
    before = Window.partitionBy(*leaf).orderBy("_h", "uid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_skey").agg(F.sum("n").alias("_l"))
    if shares is None:
        # one row for each source; the total comes from its one-row sum
        total = sizes.agg(F.sum("_l").alias("_t"))
        quota = sizes.join(F.broadcast(total)).select("_skey", (F.col("_l") / F.col("_t") * length).alias("_q"))
    else:
        quota = shares.select("_skey", (F.col("share") * length).alias("_q"))
    credit = F.pmod(F.xxhash64(F.col("_skey"), F.lit("credit")), F.lit(1 << 20)) / float(1 << 20)
    quota = stage(quota.withColumn("_u", credit), "pack-quota")
    placed = (rows.join(offsets, leaf).withColumn("_s", F.col("_off") + F.coalesce(F.sum("n").over(before), F.lit(0)))
              .join(quota, "_skey"))
    packets = placed.select("uid", "_skey", "_s", "n", "_q", "_u",
                            F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(packet).cast("long"))).alias("start"))
    packets = packets.select("uid", "_skey", "start", F.least(F.lit(packet).cast("long"), F.col("n") - F.col("start")).alias("size"),
                             (F.col("_s") + F.col("start")).alias("_at"), "_q", "_u")
    packets = packets.select("uid", "_skey", "start", "size", "_at",
                             F.floor((F.col("_at") + F.col("_u") * F.col("size")) / F.col("_q")).cast("long").alias("_round"))
    packets = (packets.withColumn("_r1", F.shiftright("_round", 2 * ROUND_BITS))
               .withColumn("_r2", F.shiftright("_round", ROUND_BITS)).withColumn("_all", F.lit(0)))
    packets = stage(packets, "pack-packets")
    rounds = running_offsets(packets, ["_all", "_r1", "_r2", "_round"], "size", "_start")
    inside = Window.partitionBy("_round").orderBy("_skey", "_at").rowsBetween(Window.unboundedPreceding, -1)
    return (packets.join(rounds.select("_round", "_start"), "_round")
            .withColumn("position", F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .select("uid", "start", "size", "position"))


def cut_pieces(packets: DataFrame, *, length: int = WINDOW) -> DataFrame:
    """``uid, start, length, sequence_id, offset``: packets cut at window ends."""
    end = F.col("position") + F.col("size")
    first = F.floor(F.col("position") / length)
    last = F.floor((end - 1) / length)
    p = packets.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("position"), F.col("sequence_id") * length)
    hi = F.least(end, (F.col("sequence_id") + 1) * length)
    return p.select("uid", (F.col("start") + lo - F.col("position")).alias("start"), (hi - lo).alias("length"),
                    "sequence_id", (lo - F.col("sequence_id") * length).alias("offset"))


def pack(docs: DataFrame, vocabulary: str, *, length: int = WINDOW, packet: int = PACKET,
         shares: DataFrame | None = None, order: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and ``ids``, an array, if asked for)."""
    tokens = stage(encode_documents(docs, vocabulary), "pack-tokens")
    pieces = cut_pieces(schedule(tokens.select("uid", "doc_id", "_skey", "n"), length=length, packet=packet,
                                 shares=shares, order=order), length=length)
    # the cuts of one document; a document's rows are as many as its windows
    cuts = pieces.groupBy(F.col("uid").alias("cut_uid")).agg(F.collect_list(
        F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))
    joined = (tokens.select("uid", "doc_id", "n", "ids").join(cuts.hint("shuffle_hash"), F.col("uid") == F.col("cut_uid"))
              .select("doc_id", "n", "ids", "cuts"))
    id_type = joined.schema["doc_id"].dataType.simpleString()
    dtype = encoder(vocabulary).dtype
    width = np.dtype(dtype).itemsize
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = (f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + ", ids array<int>" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, ROWS):
                part = b.slice(s, ROWS)
                lists = part.column("cuts")
                flat = lists.flatten()
                starts, lengths, sequences, offsets = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                counts = np.diff(lists.offsets.to_numpy())
                rows = np.repeat(np.arange(part.num_rows), counts)
                raw = [memoryview(x.as_buffer()) for x in part.column("ids")]
                crcs, ids, at = [], [], 0
                for row, n in enumerate(counts.tolist()):
                    wide = np.frombuffer(raw[row], dtype=dtype).astype("<u4")
                    for j in range(at, at + n):
                        piece = wide[starts[j]:starts[j] + lengths[j]]
                        crcs.append(zlib.crc32(piece.tobytes()))
                        if with_ids:
                            ids.append(piece.astype(np.int32))
                    at += n
                take = pa.array(rows)
                out = [part.column("doc_id").take(take), pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64()),
                       part.column("n").take(take), pa.array(sequences), pa.array(offsets)]
                yield pa.RecordBatch.from_arrays(out + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names=columns)

    return joined.mapInArrow(trimmed(run), schema)


def sequences(docs: DataFrame, vocabulary: str, *, length: int = WINDOW, **options) -> DataFrame:
    """The windows: ``sequence_id, ids, n_tokens, doc_ids``.  ``ids`` has
    ``n_tokens`` ids; a last, shorter window is padded with 0 to ``length``
    unless its size is a power of two."""
    pieces = pack(docs, vocabulary, length=length, with_ids=True, **options)
    # a window holds at most ``length`` ids, so its group is bounded
    w = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    w = w.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
    n = F.size("ids")
    power = n.bitwiseAND(n - 1) == 0
    return w.select("sequence_id", F.when(power, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(0), F.lit(length) - n))).alias("ids"), n.cast("long").alias("n_tokens"), "doc_ids")
