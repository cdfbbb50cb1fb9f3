"""Access control on search: filter first, fail closed, audit afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.operators import topk


def search_as_user(
    queries: DataFrame, corpus: DataFrame, user_groups: DataFrame, scorer, k: int, keys: Sequence[str]
) -> DataFrame:
    """Top-k among the rows whose ``acl_groups`` share a group with the asking user.

    ``queries`` has user_id; ``user_groups`` has (user_id, groups). Groups are the
    cells of the search, so a row is scored only for users who may see it, and a
    group that most rows carry is split into blocks. Users without groups get no
    rows.
    """
    asked = queries.join(user_groups, "user_id").withColumn("_group", F.explode(F.array_distinct("groups")))
    visible = corpus.withColumn("_group", F.explode(F.array_distinct("acl_groups")))
    return topk.top_k(asked.drop("groups"), visible.drop("acl_groups"), scorer, k, keys, cell="_group")


def drop_unauthorised(ranking: DataFrame, queries: DataFrame, acl: DataFrame, user_groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Post-filter: rows of an over-fetched ranking the user may see, ranked anew."""
    seen = (
        ranking.join(queries.select("query_id", "user_id"), "query_id")
        .join(user_groups, "user_id")
        .join(acl, list(keys))
        .where(F.arrays_overlap("acl_groups", "groups"))
        .drop("groups", "acl_groups")
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("rank")).cast("bigint")
    return seen.withColumn("rank", place)


def shortfall(queries: DataFrame, visible: DataFrame, k: int) -> DataFrame:
    """How many of k results each query lacks after a post-filter."""
    counts = visible.where(F.col("rank") <= k).groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    found = F.coalesce("_n", F.lit(0))
    return queries.select("query_id").join(counts, "query_id", "left").select(
        "query_id", found.alias("n_found"), (k - found).alias("missing")
    )


def audit_events(ranking: DataFrame, queries: DataFrame, user_groups: DataFrame, at) -> DataFrame:
    """One audit row per query: who asked what, which documents came back, under which groups."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "doc_id")))
    returned = ranking.groupBy("query_id").agg(F.transform(listed, lambda s: s["doc_id"]).alias("returned_doc_ids"))
    return (
        queries.join(returned, "query_id", "left")
        .join(user_groups, "user_id", "left")
        .select(
            at.alias("ts"),
            "user_id",
            "query_id",
            "query",
            F.coalesce("returned_doc_ids", F.array().cast("array<bigint>")).alias("returned_doc_ids"),
            F.coalesce("groups", F.array().cast("array<string>")).alias("user_acl_groups"),
        )
    )


def as_of(left: DataFrame, snapshots: DataFrame, key: str, ts: str, snapshot_ts: str, hours: int = 24) -> DataFrame:
    """Each left row with the latest snapshot of its key at or before ``ts``; rows without one are left out.

    Rows and snapshots go through time together: inside a piece (a key's ``hours``) the last snapshot is carried to the
    rows after it, and what a piece leaves behind, one row, is carried into later pieces. So a row meets one snapshot, however
    many its key has, and a hot key is spread over its pieces.
    """
    others = [c for c in snapshots.columns if c != key]
    snapshot = F.struct(*others)
    rows = left.select(
        F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"), F.struct(*left.columns).alias("_row"),
        F.lit(None).cast(snapshots.select(snapshot.alias("s")).schema["s"].dataType).alias("_snapshot"),
    )
    changes = snapshots.select(
        F.col(key).alias("_key"), F.col(snapshot_ts).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), snapshot.alias("_snapshot"),
    )
    both = rows.unionByName(changes).where(F.col("_key").isNotNull() & F.col("_at").isNotNull())
    both = both.withColumn("_piece", F.floor(F.unix_micros(F.col("_at").cast("timestamp")) / (hours * 3_600_000_000)))
    inside = Window.partitionBy("_key", "_piece").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_last", F.last("_snapshot", ignorenulls=True).over(inside)).where(F.col("_kind") == 1)
    # one row for each piece: what it leaves behind; before it, what earlier ones have left
    left_behind = both.groupBy("_key", "_piece").agg(F.max_by("_snapshot", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_end"))
    along = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = left_behind.withColumn("_before", F.last("_end", ignorenulls=True).over(along)).select("_key", "_piece", "_before")
    met = carried.join(before, ["_key", "_piece"]).withColumn("_met", F.coalesce("_last", "_before")).where(F.col("_met").isNotNull())
    return met.select(F.col(f"_row.{key}").alias(key), *[F.col(f"_row.{c}") for c in left.columns if c != key], *[F.col(f"_met.{c}") for c in others])


def audit_mismatches(audit: DataFrame, snapshots: DataFrame, hours: int = 24) -> DataFrame:
    """Returned documents whose groups at the time shared none with the user's."""
    returned = audit.select("event_id", "user_id", "ts", "user_acl_groups", F.explode("returned_doc_ids").alias("doc_id"))
    replayed = as_of(returned, snapshots, "doc_id", "ts", "snapshot_ts", hours)
    return replayed.where(~F.arrays_overlap("acl_groups", "user_acl_groups"))
