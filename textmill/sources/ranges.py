"""Records that may lie anywhere in large text files, read in parallel byte ranges.

Spark's text source cuts files into ranges at a separator, so every task sees whole
units (lines, or pieces up to a closing brace) of known ranges.  Whether a unit ends a
record depends on all that precedes it: on a mode (inside quotes or not) and a depth.
A range is a function of both, mode to mode and a change of depth for each mode.
Three steps, all by Spark:

1. each task reduces its ranges to these functions (and the file's first record);
2. windows over the table of ranges (a row a range) compose them: mode and depth
   at every range's start, and the range in which an open record began;
3. each task cuts its ranges into records, knowing how they start; records that cross
   ranges come as fragments and are joined by file and first range.

The table of ranges is broadcast: a row for each range of a file, that is about a
millionth of the input, checked against ``MAX_RANGES``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.session import cut_lineage

MAX_RANGES = 2_000_000
_NEVER, _DEEP = 1 << 40, 1 << 20
_LAST = (1 << 31) - 1  # place of a record that runs on into the next range
BATCH_CHARS = 4 << 20


@dataclass(frozen=True)
class Grammar:
    """How units make records.  ``step(unit, mode, depth)`` gives mode and depth after
    it; a record ends after a unit that leaves mode 0 and depth 1."""
    separator: str
    step: Callable[[str, int, int], tuple[int, int]]
    depth: int  # at the start of a file
    closing: str  # what the last unit of a record lost to the separator


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _functions(grammar: Grammar):
    """Rows ``file, start, mode0, delta0, least0, mode1, delta1, least1, first``."""
    names = ["file", "start", "mode0", "delta0", "least0", "mode1", "delta1", "least1", "first"]

    def run(batches):
        step, depth0 = grammar.step, grammar.depth
        key, out = None, []

        def close():
            if key is not None:
                (m0, d0, l0), (m1, d1, l1) = ((m, d - base, least - base) for m, d, least in (states[0], states[-1]))
                out.append((*key, m0, d0, l0, m1, d1, l1, first if done else None))

        for file, start, value in _units(batches):
            if (file, start) != key:
                close()
                key, head, done, first = (file, start), [], False, None
                # the first range of a file always starts in mode 0; the depth of
                # another is not known yet: any depth that no end is taken for
                base = depth0 if start == 0 else _DEEP
                states = [[m, base, _NEVER] for m in ((0,) if start == 0 else (0, 1))]
            for s in states:
                s[0], s[1] = step(value, s[0], s[1])
                if s[0] == 0 and s[1] < s[2]:
                    s[2] = s[1]
            if start == 0 and not done:
                head.append(value)
                if states[0][0] == 0 and states[0][1] <= 1:
                    done, first, head = True, grammar.separator.join(head), []
        close()
        cols = list(zip(*out)) if out else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))], names=names)

    return run, "file string, start long, mode0 int, delta0 long, least0 long, mode1 int, delta1 long, least1 long, first string"


def compose(table: DataFrame, depth: int) -> DataFrame:
    """Ranges with ``mode, depth`` at their start, ``open`` (a record is under way there),
    ``ends`` (some record ends inside), ``runs_on`` (one is under way at the end) and
    ``owner`` (the range in which the record open at the start began)."""
    w = Window.partitionBy("file").orderBy("start")
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("mode0") == F.col("mode1")
    flip = (~same & (F.col("mode0") == 1)).cast("int")
    t = table.withColumn("_f", F.coalesce(F.sum(flip).over(before), F.lit(0)))
    # a range that ends in one mode either way fixes it; flips since then turn it
    t = t.withColumn("_c", F.when(same, F.pmod(F.col("mode0") + F.col("_f") + flip, F.lit(2))))
    t = t.withColumn("mode", F.pmod(F.coalesce(F.last("_c", True).over(before), F.lit(0)) + F.col("_f"), F.lit(2)).cast("int"))
    by_mode = [F.when(F.col("mode") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("delta", "least", "mode")]
    t = t.select("file", "start", "first", "mode", by_mode[0].alias("delta"), by_mode[1].alias("least"), by_mode[2].alias("after"))
    t = t.withColumn("depth", F.lit(depth) + F.coalesce(F.sum("delta").over(before), F.lit(0)))
    t = t.withColumn("ends", F.col("depth") + F.col("least") <= 1)
    t = t.withColumn("runs_on", (F.col("after") == 1) | (F.col("depth") + F.col("delta") > 1))
    t = t.withColumn("open", F.coalesce(F.lag("runs_on").over(w), F.lit(False)))
    began = F.when(F.col("runs_on") & (~F.col("open") | F.col("ends")), F.col("start"))
    return t.withColumn("owner", F.last(began, True).over(before)).drop("delta", "least", "after")


def _cut(grammar: Grammar, edges: bool):
    """Records of the ranges (``edges``: instead the pieces of records that cross ranges)."""
    names = ["file", "start", "place", "value"]

    def run(batches):
        sep, closing, step = grammar.separator, grammar.closing, grammar.step
        rows, held, key, place, buf, waiting = [], 0, None, 0, [], False

        def batch():
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                              names=names)

        def tail():
            # what is left of a range: the begin of a record that runs on, or all
            # of a range that lies inside one
            if edges and key is not None and buf and runs:
                rows.append((key[0], owner if waiting else key[1], key[1], sep.join(buf)))

        for file, start, value, mode_at, depth_at, is_open, own, runs_on in _units(batches):
            if (file, start) != key:
                tail()
                if mode_at is None:
                    raise RuntimeError("the files or their ranges changed while they were read")
                key, place, buf = (file, start), 0, []
                mode, depth, waiting, owner, runs = mode_at, depth_at, is_open, own, runs_on
            mode, depth = step(value, mode, depth)
            if edges or not waiting:
                buf.append(value)
            if mode == 0 and depth <= 1:
                if waiting:
                    if edges:
                        rows.append((file, owner, start, sep.join(buf) + closing))
                    waiting = False
                elif not edges:
                    rows.append((file, start, place, sep.join(buf) + closing))
                    place += 1
                if rows:
                    held += len(rows[-1][3])
                buf = []
                if held > BATCH_CHARS:
                    yield batch()
                    rows, held = [], 0
        tail()
        yield batch()

    return run, "file string, start long, place long, value string"


def scan_records(spark: SparkSession, path: str | list[str], grammar: Grammar, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(records, ranges)``: ``file, start, place, value`` of every record (order: file,
    start, place) and the written table of ranges (``first``: the file's first record)."""
    r = spark.read.option("lineSep", grammar.separator)
    if glob:
        r = r.option("pathGlobFilter", glob)
    units = r.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    run, schema = _functions(grammar)
    ranges = cut_lineage(compose(units.mapInArrow(run, schema), grammar.depth), "ranges")
    if ranges.count() > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: read fewer files, or larger ranges, at once")
    known = ranges.select("file", "start", "mode", "depth", "open", "owner", "runs_on")
    cols = ["file", "start", "value", "mode", "depth", "open", "owner", "runs_on"]
    run, schema = _cut(grammar, False)
    whole = units.join(F.broadcast(known), ["file", "start"], "left").select(*cols).mapInArrow(run, schema)
    run, pieces = _cut(grammar, True)
    crossing = known.filter("open or runs_on")
    cut = units.join(F.broadcast(crossing), ["file", "start"]).select(*cols).mapInArrow(run, pieces)
    # of a piece, start is the range where its record began and place its own range
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda p: p["value"]), grammar.separator)
    joined = cut.groupBy("file", "start").agg(text.alias("value")).select("file", "start", F.lit(_LAST).cast("long").alias("place"), "value")
    return whole.unionByName(joined), ranges


# ---------------------------------------------------------------- CSV

def csv_line(line: str, quoted: int, delimiter: str = ",") -> int:
    """Whether a quoted field is open after the line (as before it, if no quote is in it)."""
    if '"' not in line:
        return quoted
    at, n = 0, len(line)
    while True:
        if not quoted:
            if at < n and line[at] == '"':
                quoted, at = 1, at + 1
                continue
        else:
            at = line.find('"', at)
            if at < 0:
                return 1
            if line.startswith('"', at + 1):
                at += 2
                continue
            quoted, at = 0, at + 1
        at = line.find(delimiter, at) + 1
        if at == 0:
            return 0


def csv_grammar(delimiter: str = ",") -> Grammar:
    def step(line: str, mode: int, depth: int) -> tuple[int, int]:
        return csv_line(line, mode, delimiter), depth
    return Grammar("\n", step, 1, "")


# ---------------------------------------------------------------- JSON arrays

# strings are matched whole and passed over, so that their brackets do not count
_STRUCTURE = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{"]', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


def json_piece(piece: str, quoted: int, depth: int) -> tuple[int, int]:
    """State after a piece and the brace that ended it.  After the array's end only
    white space may follow; the file's last piece has no brace, which then is not missed."""
    if depth <= 0 and not quoted and not piece.strip():
        return 0, depth
    at = 0
    if quoted:
        m = _STRING_END.match(piece)
        if m is None:
            return 1, depth
        at = m.end()
    for m in _STRUCTURE.finditer(piece, at):
        c = m.group()
        if c == "{" or c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
            if depth == 0:
                return 0, 0
        elif c == '"':  # a string that goes on after the piece
            return 1, depth
    return 0, depth - 1


JSON_ARRAY = Grammar("}", json_piece, 0, "}")


def json_elements(records: DataFrame) -> DataFrame:
    """Element objects of scanned array files: what precedes the first brace (array
    start, comma, white space) goes; what holds none is no element."""
    at: Column = F.instr("value", "{")
    return records.filter(at > 0).withColumn("value", F.expr("substring(value, instr(value, '{'))"))
