"""File readers with declared schemas (S3, S4) and the schema contract."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill import schemas
from textmill.sources.ranges import JSON_ARRAY, csv_grammar, json_elements, scan_records


def _glob(ext: str) -> str:
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)


def read_chunks_json(spark: SparkSession, path: str | list[str],
                     schema: T.StructType = schemas.CHUNK, layout: str = "lines") -> DataFrame:
    """Chunk JSON: one file or every ``.json`` (any case) in a folder,
    non-recursively.  ``array`` files hold one JSON array each (every element
    a row); ``lines`` files hold one object per line.  Absent keys are null."""
    r = (spark.read.schema(schema)
         .option("pathGlobFilter", _glob("json"))
         .option("recursiveFileLookup", "false"))
    if layout == "array":
        return read_json_array(spark, path, schema)
    if layout != "lines":
        raise ValueError(f"unknown JSON layout: {layout!r}")
    return r.json(path)


POSITION = ["file", "start", "place"]  # sorts records in the order of their files


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.CHUNK,
                    positions: bool = False) -> DataFrame:
    """Array files (one or every ``.json`` in a folder): every element object a row,
    read in parallel ranges of each file.  ``positions`` adds ``POSITION``, by which
    rows sort in the order of file names and of the elements in them."""
    records, ranges = scan_records(spark, path, JSON_ARRAY, _glob("json"))
    other = ranges.filter(F.col("start") == 0).filter(~F.coalesce(F.btrim("first", F.lit(" \t\r\n\ufeff")), F.lit("[")).rlike(r"^(\[|$)"))
    if not other.isEmpty():
        raise ValueError("not a JSON array file: read it with layout='lines'")
    out = json_elements(records).select(*POSITION, F.from_json("value", schema).alias("_r"))
    return out.select(*(POSITION if positions else []), "_r.*")


MAX_LAYOUTS = 1000


def read_records_csv(spark: SparkSession, path: str | list[str],
                     schema: T.StructType = schemas.RECORDS_CSV, positions: bool = False) -> DataFrame:
    """Header CSV, UTF-8, lines end in LF or CRLF, quoted fields may hold newlines and
    doubled quotes; every value is text.  An unquoted empty field reads as null, blank
    lines are skipped.

    Every file goes by its own header: the order of columns is free, others are
    ignored, absent ones are null, of a repeated name the last counts; short records
    end in nulls.  Files are read in parallel ranges (records, quoted newlines included,
    may cross them).  ``positions`` adds ``POSITION``."""
    records, ranges = scan_records(spark, path, csv_grammar())
    files = ranges.filter(F.col("start") == 0).select("file", "first")
    if not files.filter("first is null").isEmpty():
        raise ValueError("a header does not end within the first range of its file")
    # the distinct headers, at most MAX_LAYOUTS
    headers = sorted(r["first"] for r in files.select("first").distinct().limit(MAX_LAYOUTS + 1).collect())
    if len(headers) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different headers")
    if not headers:
        headers = [""]
    number = spark.createDataFrame(list(enumerate(headers)), "layout int, first string")
    known = F.broadcast(files.join(F.broadcast(number), "first").select("file", "layout"))  # a row a file
    body = (records.join(known, "file").filter("not (start = 0 and place = 0)")
            .withColumn("value", F.regexp_replace("value", r"\r\z", "")).filter("value <> ''"))
    names, parsed = [], []
    for i, header in enumerate(headers):
        cells = next(csv.reader([header.removeprefix("\ufeff").removesuffix("\r")]), [])
        names.append({c: j for j, c in enumerate(cells)})
        row = ", ".join(f"c{j} string" for j in range(max(len(cells), 1)))
        record = F.from_csv("value", F.lit(row), {"escape": '"', "multiLine": "true"})
        parsed.append(F.when(F.col("layout") == i, record).alias(f"_r{i}"))
    rows = body.select(*POSITION, "layout", *parsed)

    def field(name: str):
        out = F.lit(None).cast("string")
        for i, at in enumerate(names):
            if name in at:
                out = F.when(F.col("layout") == i, F.col(f"_r{i}.c{at[name]}")).otherwise(out)
        return out

    return rows.select(*(POSITION if positions else []), *[field(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Contract check: one row per expected or actual column whose type
    differs or that is missing/extra; empty when the schema conforms."""
    spark = df.sparkSession
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name in list(want) + [n for n in have if n not in want]:
        e, a = want.get(name), have.get(name)
        if e != a:
            rows.append((name, e, a))
    sch = "column string, expected string, actual string"
    return spark.createDataFrame(rows, sch)
