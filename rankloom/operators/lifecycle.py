"""Keeping a chunk table in step with its documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.scale import cut_lineage, is_small
from rankloom.sources.versioned import VersionedTable

#: Rows of ids alone that may be broadcast (their bytes are bounded as ever), and changes from which texts are not moved.
ID_ROWS, MANY_CHANGES = 4_000_000, 100_000


def upsert(target: DataFrame, changes: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """New rows replace old rows of the same key; write the result to a new path, then switch.

    ``by``: a part of the key with few values among the changes. Rows of other values stay where they lie.
    """
    key, by = list(key), list(by)
    keys = changes.select(*key)
    if by:
        ids = cut_lineage(changes.select(*by).distinct())
        if is_small(ids, ID_ROWS):
            ids = F.broadcast(ids)
            replaced = target.join(ids, by, "left_semi").join(keys, key, "left_anti")
            return target.join(ids, by, "left_anti").unionByName(replaced).unionByName(changes)
    return target.join(keys, key, "left_anti").unionByName(changes)


def deleted_from_source(index: DataFrame, source: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct indexed ids the source no longer has."""
    return index.select(key).distinct().join(source.select(key), key, "left_anti")


def latest_changes(changes: DataFrame, key: str = "doc_id", seq: str = "seq") -> DataFrame:
    """The last change of each key. ``max_by`` combines before the shuffle, so a hot key is cheap."""
    others = [c for c in changes.columns if c != key]
    return changes.groupBy(key).agg(F.max_by(F.struct(*others), seq).alias("_last")).select(key, "_last.*")


def _latest_in_place(changes: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """``latest_changes`` and the ids to broadcast, without moving texts: only ids and numbers of changes are grouped.

    None if there are too many ids. Documents with several changes of their last number, or with none, go the other way.
    """
    counted = changes.groupBy("doc_id", "seq").agg(F.count(F.lit(1)).alias("_n"))
    newest = counted.groupBy("doc_id").agg(F.max(F.struct("seq", "_n")).alias("_last")).select("doc_id", "_last.*")
    newest = cut_lineage(newest)
    if not is_small(newest, ID_ROWS):
        return None
    plain = (F.col("_n") == 1) & F.col("seq").isNotNull() & F.col("doc_id").isNotNull()
    last = changes.join(F.broadcast(newest.where(plain).select("doc_id", "seq")), ["doc_id", "seq"], "left_semi")
    other = newest.where(~plain).select(F.col("doc_id").alias("_id"))
    if not other.isEmpty():
        rest = changes.join(F.broadcast(other), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        last = last.unionByName(cut_lineage(latest_changes(rest)))
    return last, F.broadcast(newest.select("doc_id"))


def apply_changes(target: DataFrame, changes: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Chunk table after a set of document changes (op insert, update or delete).

    All old chunks of a changed document go first, so a document that shrank
    leaves nothing behind; ``build`` turns the surviving documents into chunks.
    """
    last = latest_changes(changes)
    return _applied(target, last, last.select("doc_id"), build)


def _applied(target: DataFrame, last: DataFrame, ids: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    kept = target.join(ids, "doc_id", "left_anti")
    fresh = build(last.where(F.col("op") != "delete").drop("op", "seq"))
    return kept.unionByName(fresh.select(*kept.columns))


def upsert_into(table: VersionedTable, changes: DataFrame, key: Sequence[str], base: int | None = None) -> int:
    """A new version in which new rows replace old rows of the same key; only their buckets are written."""
    by = [c for c in table.by if c in key]
    return table.rewrite(changes, lambda rows: upsert(rows, changes.select(*rows.columns), key, by), base)


def apply_changes_to(
    table: VersionedTable,
    changes: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    base: int | None = None,
    batch: int | None = None,
    scope: Column | None = None,
) -> int:
    """``apply_changes`` on the buckets of the changed documents; ``scope`` names the rows of them that a change replaces."""
    found = _latest_in_place(changes) if changes.count() > MANY_CHANGES else None
    if found is None:
        last = cut_lineage(latest_changes(changes))
        found = last, last.select("doc_id")
    last, ids = found

    def changed(rows: DataFrame) -> DataFrame:
        if scope is None:
            return _applied(rows, last, ids, build)
        return rows.where(~scope).unionByName(_applied(rows.where(scope), last, ids, build))

    return table.rewrite(last, changed, base, batch)


def source_of_truth(versions: DataFrame, group: str, canonical: str, updated: str, key: str) -> DataFrame:
    """One version per group: canonical before others, then the most recent, then the lowest key."""
    best = F.max(F.struct(F.col(canonical), F.col(updated), (-F.col(key)).alias("_k"))).alias("_b")
    return versions.groupBy(group).agg(best).select(
        group, (-F.col("_b._k")).alias(key), F.col(f"_b.{canonical}"), F.col(f"_b.{updated}")
    )


def newer_than(df: DataFrame, ts: str, since: Column) -> DataFrame:
    return df.where(F.col(ts) >= since)


def within_retention(df: DataFrame, ts: str, as_of: Column, months: int = 60) -> DataFrame:
    """Rows of the last ``months`` months up to ``as_of``."""
    return df.where(F.col(ts) >= F.add_months(as_of, -months))


def migration_backlog(vectors: DataFrame, target_version: str, priority: str) -> DataFrame:
    """Vectors of other model versions with their place in line, most important first."""
    waiting = vectors.where(F.coalesce(F.col("model_version") != target_version, F.lit(True)))
    return waiting.orderBy(F.desc(priority), "doc_id")
