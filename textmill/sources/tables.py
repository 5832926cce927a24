"""Table scans for the clustering input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, text: str = "text", vec: str = "embedding") -> DataFrame:
    """Rows with a non-empty vector and non-empty text (blank text passes)."""
    return df.filter(F.col(vec).isNotNull() & (F.size(vec) > 0) & F.col(text).isNotNull() & (F.col(text) != ""))


def read_cluster_rows(src: DataFrame, limit: int | None = None, order: str = "id") -> DataFrame:
    """``id, text, embedding`` (+ extra columns) with the optional row cap
    applied at the source, *before* the usable-row filter, so a cap of n may
    give fewer than n rows.  The cap takes the first rows in ``order``
    (a top-n, planned as TakeOrderedAndProject); 0 or None means no cap."""
    df = src
    if limit:
        df = df.orderBy(order).limit(limit)
    return usable(df)
