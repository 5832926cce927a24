"""The whole run from vectors to the table of common issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.cluster import cluster
from textmill.operators.keyed import merge_keyed, read_keyed
from textmill.operators.summary import TOP_N, common_issues, first_members, nonblank, rank_clusters
from textmill.session import cut_lineage
from textmill.sources.tables import read_cluster_rows

KEY = "canonical_squawk"
ROW, NONBLANK = "_tm_issue_row", "_tm_nonblank"


def refresh_issues(rows: DataFrame, path: str, method: str = "density", corpora: dict[str, DataFrame] | None = None,
                   top: int = TOP_N, pos: str = "pos", buckets: int = 64, **options) -> DataFrame | None:
    """Cluster ``rows`` (id, pos, text, embedding), describe the ``top`` largest clusters
    with context from ``corpora``, and merge them by phrase into the table at ``path``;
    returns the table as it is then (None if it never held a row).

    Rows without a vector or a text take no part.  Clusters
    of one phrase leave the one that ranks higher.  Issues of earlier runs whose phrase
    doesn't come up again stay.  ``options`` go to the clustering.

    Texts are written once and stay there: rows are clustered and ranked without them,
    and only those that a cluster is described by are looked up."""
    usable = read_cluster_rows(rows, order=pos).withColumn(ROW, F.monotonically_increasing_id())
    usable = cut_lineage(usable.withColumn(NONBLANK, nonblank("text")), "issue-rows")
    labelled = cut_lineage(cluster(usable.drop("text"), method, **options).select(ROW, NONBLANK, pos, "cluster_label"), "issue-labels")
    ranked = cut_lineage(rank_clusters(labelled, pos=pos, top=top), "issue-ranks")
    members = first_members(labelled, ranked, NONBLANK, pos=pos).dropDuplicates([ROW])
    if top:  # a bounded number of clusters, some rows each
        members = F.broadcast(members)
    members = cut_lineage(usable.select(ROW, "text").join(members, ROW), "issue-members")
    issues = common_issues(members, top=top, pos=pos, context="search" if corpora else "empty", corpora=corpora, ranked=ranked)
    merge_keyed(issues, path, KEY, buckets=buckets)
    return read_keyed(rows.sparkSession, path)
