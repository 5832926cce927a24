"""Write-up records: CSV rows -> typed records -> clustering input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.records import iso_or_null
from textmill.functions.text import py_strip
from textmill.operators.embed import embed_rows
from textmill.schemas import RECORD

ORG = "squawk"


def map_records(rows: DataFrame, org: str = ORG) -> DataFrame:
    """Header-named CSV rows -> the 17 scalar record fields.

    ``tail_number`` and ``aircraft`` both come from ``Aircraft``;
    ``aircraft_type`` and ``aircraft_serial`` both from ``Aircraft Serial``
    (kept as the source maps them).  Timestamps parse with the three
    accepted formats after the N/A check.  Narrow projection, no shuffle.
    """
    c = F.col
    return rows.select(
        c("`Discrepancy ID`").alias("discrepancy_id"),
        F.lit(org).alias("org"),
        c("Aircraft").alias("tail_number"),
        c("`Aircraft Serial`").alias("aircraft_type"),
        c("Aircraft").alias("aircraft"),
        c("`Aircraft Serial`").alias("aircraft_serial"),
        iso_or_null(c("`Logged on`")).alias("logged_on"),
        py_strip(c("Issue")).alias("issue"),
        py_strip(c("`Corrective action`")).alias("corrective_action"),
        c("Status").alias("status"),
        c("`MEL category`").alias("mel_category"),
        c("`MEL location`").alias("mel_location"),
        c("`MEL company`").alias("mel_company"),
        c("`Sign-off by`").alias("signoff_by"),
        iso_or_null(c("`Sign-off on`")).alias("signoff_on"),
        c("`Sign-off license`").alias("signoff_license"),
        iso_or_null(c("`Work completed on`")).alias("work_completed_on"),
    )


def embed_records(records: DataFrame, provider: str = "hashing") -> DataFrame:
    """The full record of 19 fields: both texts with their vectors (null text:
    null vector)."""
    out = records
    for text, vector in (("issue", "issue_embedding_vector"), ("corrective_action", "corrective_embedding_vector")):
        out = embed_rows(out, text, provider=provider).withColumnRenamed("embedding", vector).drop("embedding_model")
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD.fields])


def cluster_input(records: DataFrame, id_col: str = "discrepancy_id", text_col: str = "issue",
                  vec_col: str = "issue_embedding_vector") -> DataFrame:
    """Project stored records to the clustering input ``id, text, embedding``.

    Vectors that come back as JSON text are parsed."""
    v = F.col(vec_col)
    dtype = dict(records.dtypes)[vec_col]
    if dtype == "string":
        v = F.from_json(v, "array<float>")
    return records.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                          v.alias("embedding"))
