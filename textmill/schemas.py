"""Declared schemas of the pipeline tables (never inferred)."""

from pyspark.sql import types as T

CHUNK = T.StructType([
    T.StructField("content", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("section_title", T.StringType()),
    T.StructField("aircraft_model", T.StringType()),
    T.StructField("document_id", T.StringType()),
    T.StructField("system_category", T.StringType()),
    T.StructField("token_count", T.IntegerType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("content_hash", T.StringType()),
])

EMBEDDED_CHUNK = T.StructType(CHUNK.fields + [
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("embedding_model", T.StringType()),
])

VECTOR_ROW = T.StructType([
    T.StructField("content", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("section_title", T.StringType()),
    T.StructField("aircraft_model", T.StringType()),
    T.StructField("document_id", T.StringType()),
    T.StructField("system_category", T.StringType()),
    T.StructField("document_type", T.StringType()),
    T.StructField("metadata", T.StructType([T.StructField("token_count", T.IntegerType())])),
])

# The header names of the write-up CSV.
RECORD_HEADERS = [
    "Discrepancy ID", "Aircraft", "Aircraft Serial", "Logged on", "Issue", "Corrective action",
    "Status", "MEL category", "MEL location", "MEL company", "Sign-off by", "Sign-off on",
    "Sign-off license", "Work completed on",
]
RECORDS_CSV = T.StructType([T.StructField(h, T.StringType()) for h in RECORD_HEADERS])

RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ("discrepancy_id", "org", "tail_number", "aircraft_type", "aircraft", "aircraft_serial")]
    + [T.StructField("logged_on", T.TimestampType())]
    + [T.StructField(n, T.StringType()) for n in
       ("issue", "corrective_action", "status", "mel_category", "mel_location", "mel_company",
        "signoff_by")]
    + [T.StructField("signoff_on", T.TimestampType()), T.StructField("signoff_license", T.StringType()),
       T.StructField("work_completed_on", T.TimestampType()),
       T.StructField("issue_embedding_vector", T.ArrayType(T.FloatType())),
       T.StructField("corrective_embedding_vector", T.ArrayType(T.FloatType()))]
)

CLUSTER_INPUT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

COMMON_ISSUE = T.StructType([
    T.StructField("canonical_squawk", T.StringType()),
    T.StructField("cluster_label", T.IntegerType()),
    T.StructField("frequency", T.LongType()),
    T.StructField("sample_examples", T.ArrayType(T.StringType())),
    T.StructField("sources", T.StructType([
        T.StructField("manuals", T.ArrayType(T.StringType())),
        T.StructField("overviews", T.ArrayType(T.StringType())),
        T.StructField("past_squawks", T.ArrayType(T.StringType())),
    ])),
])
