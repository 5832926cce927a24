"""Derived inputs, computed by Spark from the given tables (see FIXTURES.md).

Each fixture is a fixed SQL expression over a whole table, so its work grows
with the table and the oracle can evaluate the very same expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import read_table  # noqa: F401

# Word substitutions that put category vocabulary into text.
VOCAB_CASES = [
    (0, " the ", " hydraulic pressure "),
    (1, " of ", " landing gear brake "),
    (2, " and ", " fuel tank inspection "),
    (3, " is ", " table of contents "),
    (4, " to ", " bus breaker "),
    (5, " in ", " c.g. limitations "),
    (6, " on ", " engine n1 "),
    (7, " the ", " flight director radar "),
    (8, " of ", " bleed air oxygen "),
    (9, " and ", " autopilot rudder trim "),
    (10, " is ", " emergency procedures warnings "),
    (11, " to ", " normal procedures checklist "),
    (12, " in ", " hydraulic electrical fuel system "),
    (13, " on ", " removal and installation service "),
    (14, " that ", " brakes torque boost pump "),
]
VOCAB_MOD = 16


def vocab_text_sql(text: str = "text", key: str = "doc_id") -> str:
    """CASE expression shared by Spark and the oracle."""
    arms = " ".join(f"WHEN {i} THEN replace({text}, '{a}', '{b}')" for i, a, b in VOCAB_CASES)
    return f"CASE {key} % {VOCAB_MOD} {arms} ELSE {text} END"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def vocab_documents(spark: SparkSession, sf: str) -> DataFrame:
    """F-VOCAB: documents with category words substituted in."""
    d = documents(spark, sf)
    return d.select("doc_id", F.expr(vocab_text_sql()).alias("text"), "lang", "source")


def front_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """F-FRONT: conversations as documents, turns as chunk positions, with
    front-matter phrases prefixed to some turns."""
    c = read_table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("document_id"), F.col("turn").alias("pos"), "role",
                    F.expr(FRONT_TEXT_SQL).alias("content"))


# Every front-matter phrase, and every phrase that opens content.
FRONT_PHRASES = ["Table of Contents", "List of Effective Pages", "Record of Revisions", "Revision Record",
                 "Log of Revisions", "Copyright", "Proprietary Notice", "Distribution Statement", "TOC", "LEP"]
START_PHRASES = ["Introduction", "General Description", "System Description", "Normal Procedures"]
FRONT_TEXT_SQL = (
    "CASE WHEN conv_id % 5 = 0 OR (conv_id % 3 = 0 AND turn < 2) THEN concat(CASE (conv_id + turn) % 10 "
    + " ".join(f"WHEN {i} THEN '{p} '" for i, p in enumerate(FRONT_PHRASES)) + " END, text) "
    + "WHEN conv_id % 7 = 1 AND turn = 1 THEN concat(CASE conv_id % 4 "
    + " ".join(f"WHEN {i} THEN '{p} '" for i, p in enumerate(START_PHRASES)) + " END, text) ELSE text END")


FOREIGN_SQL = {
    "content": "CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN '' ELSE NULL END",
    "text": "text",
    "page_number": "turn",
    "page": "turn + 1",
    "page_index": "turn",
    "section_title": "CASE WHEN turn % 2 = 1 THEN NULL ELSE concat('Section ', turn) END",
    "title": "role",
    "section": "'body'",
    "element_type": "CASE WHEN turn = 0 THEN 'Header' WHEN turn % 7 = 3 THEN 'Footer' "
                    "WHEN turn % 7 = 5 THEN 'Table' ELSE NULL END",
    "type": "role",
}


def foreign_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """F-FOREIGN: layout-parser style chunks with alternative key names."""
    c = read_table(spark, sf, "conversations")
    cols = [F.expr("conv_id * 1000 + turn").alias("id"), F.col("conv_id").alias("document_id"),
            F.col("turn").alias("pos")]
    cols += [F.expr(v).alias(k) for k, v in FOREIGN_SQL.items()]
    return c.select(*cols)


# F-TIME: raw timestamp text in one of several shapes, chosen by a key.
def ftime_spark(key: str, ts: str = "ts") -> str:
    return (f"CASE ({key}) % 7 WHEN 0 THEN date_format({ts}, 'MM/dd/yy HH:mm') "
            f"WHEN 1 THEN date_format({ts}, 'M/d/yyyy HH:mm') "
            f"WHEN 2 THEN date_format({ts}, 'MM/dd/yy HH:mm:ss') "
            f"WHEN 3 THEN 'N/A' WHEN 4 THEN ' na ' WHEN 5 THEN '' "
            f"ELSE date_format({ts}, 'MM/dd/yyyy HH:mm:ss') END")


def ftime_sql(key: str, ts: str = "ts") -> str:
    return (f"CASE ({key}) % 7 WHEN 0 THEN strftime({ts}, '%m/%d/%y %H:%M') "
            f"WHEN 1 THEN strftime({ts}, '%-m/%-d/%Y %H:%M') "
            f"WHEN 2 THEN strftime({ts}, '%m/%d/%y %H:%M:%S') "
            f"WHEN 3 THEN 'N/A' WHEN 4 THEN ' na ' WHEN 5 THEN '' "
            f"ELSE strftime({ts}, '%m/%d/%Y %H:%M:%S') END")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def time_strings(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("event_id", F.expr(ftime_spark("event_id")).alias("raw"))


# F-CSV: a write-up file derived from events (the header names are fixed).
def csv_columns(dialect: str) -> dict[str, str]:
    ft = ftime_spark if dialect == "spark" else ftime_sql
    nl = "char(10)" if dialect == "spark" else "chr(10)"
    return {
        "Discrepancy ID": "CAST(event_id AS STRING)" if dialect == "spark" else "CAST(event_id AS VARCHAR)",
        "Aircraft": "concat('N', user_id)",
        "Aircraft Serial": "CAST(user_id AS STRING)" if dialect == "spark" else "CAST(user_id AS VARCHAR)",
        "Logged on": ft("event_id"),
        "Issue": "concat('  ', event_type, ' fault  ')",
        "Corrective action": f"concat(props, CASE WHEN event_id % 10 = 0 THEN concat({nl}, 'see log') ELSE '' END)",
        "Status": "event_type",
        "MEL category": "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE 'C' END",
        "MEL location": "'cabin'",
        "MEL company": "'ACME'",
        "Sign-off by": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('tech ', user_id % 10) END",
        "Sign-off on": ft("event_id + 1"),
        "Sign-off license": "'A&P, \"IA\"'",
        "Work completed on": ft("event_id + 2"),
    }


def write_records_csv(spark: SparkSession, sf: str, path: str) -> str:
    """Write F-CSV under ``path`` (header, quoted as needed, blanks kept): the files of
    odd event ids have their columns in reverse order, so one folder holds two layouts."""
    cols = [F.expr(v).alias(k) for k, v in csv_columns("spark").items()]
    for odd, layout, mode in ((0, cols, "overwrite"), (1, cols[::-1], "append")):
        (events(spark, sf).filter(F.expr(f"event_id % 2 = {odd}")).select(*layout).write.mode(mode)
         .option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    return path


# F-CLUSTER: every document, with its embedding and given label where there is
# one and a label by its id elsewhere; noise, blank texts and empty vectors are
# mixed in by fixed rules.
CLUSTER_COLS = {
    "pos": "d.doc_id",
    "cluster_label": "CASE WHEN d.doc_id % 17 = 0 THEN -1 ELSE coalesce(e.label, 100 + d.doc_id % 37) END",
    "text": "CASE WHEN d.doc_id % 11 = 0 THEN '' WHEN d.doc_id % 13 = 0 THEN '   ' ELSE d.text END",
}


def cluster_rows(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "embeddings").alias("e")
    d = read_table(spark, sf, "documents").alias("d")
    j = d.join(e, F.col("e.vec_id") == F.col("d.doc_id"), "left")
    return j.select(F.col("d.doc_id").cast("string").alias("id"),
                    *[F.expr(v).alias(k) for k, v in CLUSTER_COLS.items()],
                    F.expr("CASE WHEN d.doc_id % 19 = 0 THEN array() ELSE coalesce(e.embedding, "
                           "array(CAST(d.doc_id % 7 AS FLOAT), CAST(1 AS FLOAT))) END").alias("embedding"))


def cluster_rows_sql() -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in CLUSTER_COLS.items())
    return (f"(SELECT CAST(d.doc_id AS VARCHAR) AS id, {cols}, "
            f"CASE WHEN d.doc_id % 19 = 0 THEN CAST([] AS FLOAT[]) ELSE coalesce(e.embedding, "
            f"CAST([d.doc_id % 7, 1] AS FLOAT[])) END AS embedding "
            f"FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id)")


# F-SEP: separable vectors (label decides which axis is lifted); the
# outlier variant pushes some rows far out along their own direction.
SEP_VEC = ("transform(embedding, (x, i) -> CAST(0.15 * x + CASE WHEN i = label THEN 1 ELSE 0 END AS FLOAT))")
SEP_OUTLIER = "vec_id % 25 = 0"


def separable(spark: SparkSession, sf: str, outliers: bool = False) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    v = F.expr(SEP_VEC)
    group = F.col("label")
    if outliers:
        v = F.when(F.expr(SEP_OUTLIER), F.expr("transform(embedding, x -> CAST(10 * x AS FLOAT))")).otherwise(v)
        group = F.when(F.expr(SEP_OUTLIER), F.lit(-1)).otherwise(F.col("label"))
    return e.select(F.col("vec_id").alias("id"), v.alias("embedding"), group.alias("label"))
