"""Joins of rows with one row per group where a few groups may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 1000  # a group above a thousandth of all rows is heavy: fewer than a thousand can be


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row a ``key``, its number of rows in
    ``size``; the sizes add up to ``n`` at most).

    The fewer than ``HEAVY`` groups above ``n / HEAVY`` rows are broadcast, so their rows
    stay where they are; the others are joined as Spark plans it, and no key of that
    join has more than ``n / HEAVY`` rows.  Read ``rows`` and ``groups`` from written tables: each is used twice."""
    big = F.col(size) * HEAVY > n
    heavy = F.broadcast(groups.filter(big))  # fewer than HEAVY rows, by their size
    rest = rows.join(F.broadcast(groups.filter(big).select(key)), key, "left_anti")
    return rows.join(heavy, key).unionByName(rest.join(groups.filter(~big), key))
