"""CSV records and JSON array elements cut from small byte ranges, against csv and json."""

import csv
import io
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.sinks import write_json_array
from textmill.sources.files import POSITION, read_json_array, read_records_csv
from textmill.sources.ranges import csv_line, json_piece

FIELDS = ["id", "Issue", "Logged on", "x,y"]
SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
_S = T.StringType()
ELEMENT = (T.StructType().add("id", T.IntegerType()).add("text", _S)
           .add("meta", T.StructType().add("n", T.IntegerType()).add("tags", T.ArrayType(_S)))
           .add("list", T.ArrayType(T.StructType().add("k", _S))))


@pytest.fixture(params=[48, 333, 1 << 20])
def ranges(spark, request):
    """Byte ranges of this many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def cells(rng):
    return rng.choice(["plain", "é日", 'say ""hi', "two\nlines", "a,b", '"', "\n\n", 'q"\n",', " ", "x" * rng.randrange(200), "no"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a",\n', max_size=6), min_size=1, max_size=4), max_size=5))
def test_quote_state_follows_csv(rows):
    """After each physical line the state says whether the csv module waits for more."""
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    state, ends, text = 0, [], out.getvalue()
    for line in text.split("\n")[:-1]:
        state = csv_line(line, state)
        ends.append(state)
    assert ends.count(0) == len(rows) and (not ends or ends[-1] == 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.text(alphabet='a{}[]"\\ ', max_size=4), st.recursive(
    st.text(alphabet='b{}[]"\\,', max_size=5) | st.integers(), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(alphabet='k}"', max_size=3), c, max_size=3)),
    max_size=3), max_size=4), st.sampled_from([None, 1]))
def test_json_state_finds_every_element(elements, indent):
    mode, depth, buf, got = 0, 0, [], []
    for piece in json.dumps(elements, indent=indent).split("}"):
        mode, depth = json_piece(piece, mode, depth)
        buf.append(piece)
        if mode == 0 and depth <= 1:
            got.append("}".join(buf) + "}")
            buf = []
    found = [g[g.index("{"):] for g in got if "{" in g]
    assert [json.loads(g) for g in found] == elements and depth == 0


def test_two_header_orders_in_one_folder(spark, tmp_path, ranges):
    """Each file by its own header; quoted newlines across ranges; CRLF, blank lines, short rows."""
    rng = random.Random(ranges)
    want = []
    for name, header, end in (("a.csv", FIELDS, "\n"), ("b.csv", FIELDS[::-1], "\r\n"), ("c.csv", ["Issue", "other", "id"], "\n"),
                              ("d.csv", FIELDS, "\n")):
        rows = [] if name == "d.csv" else [[f"{name}{i}" if h == "id" else cells(rng) for h in header] for i in range(40)]
        out = io.StringIO()
        csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL if name == "a.csv" else csv.QUOTE_MINIMAL).writerows([header, *rows])
        text = out.getvalue() + ("" if name != "b.csv" else end + "short" + end)
        (tmp_path / name).write_bytes(text.encode())
        for r in csv.DictReader(io.StringIO(text, newline="")):
            want.append(tuple(r.get(f) or None for f in FIELDS))
    got = read_records_csv(spark, str(tmp_path), SCHEMA)
    assert got.columns == FIELDS
    assert sorted((tuple(v or None for v in r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    placed = read_records_csv(spark, str(tmp_path / "c.csv"), SCHEMA, positions=True).orderBy(*POSITION)
    assert [r["id"] for r in placed.collect()] == [f"c.csv{i}" for i in range(40)]
    if ranges < 1000:
        assert read_records_csv(spark, str(tmp_path / "a.csv"), SCHEMA).rdd.getNumPartitions() > 4


def test_headers(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿id,Issue,id\r\n1,x,2\r\n".encode())
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "open.csv").write_text('id,Issue\n9,"never closed\n')
    got = sorted(tuple(r) for r in read_records_csv(spark, str(tmp_path), SCHEMA).select("id", "Issue").collect())
    assert got[0] == ("2", "x") and got[1][0] == "9" and len(got) == 2  # of a repeated name the last counts
    assert read_records_csv(spark, str(tmp_path / "empty.csv"), SCHEMA).count() == 0


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_in_ranges(spark, tmp_path, ranges, indent):
    """Nested objects, braces and quotes in strings, one line or many; order kept."""
    rng = random.Random(ranges)
    want = []
    for name in ("b.json", "a.JSON", "c.json"):
        part = [{"id": i, "text": rng.choice(['{"}', "]\\", 'é"]}', "x" * rng.randrange(150), "\n}", "", "\\\\"]),
                 "meta": {"n": i, "tags": ["}", "{["] * (i % 3)}, "list": [{"k": "}"}] * (i % 2)} for i in range(0 if name == "c.json" else 30)]
        (tmp_path / name).write_text(json.dumps(part, indent=indent, ensure_ascii=bool(indent)) + "\n" * (name == "b.json"), encoding="utf-8")
        want.append((name, part))
    (tmp_path / "no.txt").write_text("not JSON")
    got = read_json_array(spark, str(tmp_path), ELEMENT, positions=True).orderBy(*POSITION).drop(*POSITION)
    assert [r.asDict(True) for r in got.collect()] == [e for _, part in sorted(want) for e in part]


def test_array_files_only(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"id": 1}\n{"id": 2}\n')
    with pytest.raises(ValueError, match="lines"):
        read_json_array(spark, str(tmp_path), ELEMENT)
    (tmp_path / "blank").mkdir()
    (tmp_path / "blank" / "x.json").write_text('\n\t [ {"id": 1} , 5, {"id": 2} ] \n\n')
    assert [r.id for r in read_json_array(spark, str(tmp_path / "blank"), ELEMENT).collect()] == [1, 2]


def test_array_writer(spark, tmp_path):
    df = spark.range(500).select(F.col("id").cast("int"), F.concat(F.lit('}"\n'), "id").alias("text"))
    path = write_json_array(df.repartition(3), str(tmp_path / "t"))
    files = sorted((tmp_path / "t").glob("*.json"))
    rows = [e for f in files for e in json.loads(f.read_text())]
    assert sorted(e["id"] for e in rows) == list(range(500))
    back = read_json_array(spark, path, T.StructType.fromDDL("id int, text string"))
    assert back.join(df, ["id", "text"]).count() == 500
    assert read_json_array(spark, write_json_array(df.limit(0), str(tmp_path / "none")), ELEMENT).count() == 0
