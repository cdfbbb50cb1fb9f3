"""Document change streams kept as an append-only chunk log.

Each micro-batch adds one partition: the new chunks of every changed document
and a marker row for it. Nothing stored is rewritten, so a small change never
costs a pass over the table; readers take each document's latest version, and a
compaction folds the log into a new base from time to time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.chunking import distinct_content
from rankloom.operators.lifecycle import apply_changes_to, latest_changes
from rankloom.scale import broadcast_if_small, cut_lineage
from rankloom.sources.versioned import VersionedTable

Build = Callable[[DataFrame], DataFrame]


def append_changes(build: Build, path: str) -> Callable[[DataFrame, int], None]:
    """Handler for change batches (doc_id, op, seq, ...). A repeated batch overwrites its own partition."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        last = cut_lineage(latest_changes(batch))
        docs = last.where(F.col("op") != "delete").drop("op")
        chunks = build(docs.drop("seq")).withColumn("_live", F.lit(True))
        chunks = chunks.join(last.select("doc_id", "seq"), "doc_id")
        markers = last.select("doc_id", "seq")
        rows = chunks.unionByName(markers, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def apply_batches(table: VersionedTable, build: Build) -> Callable[[DataFrame, int], None]:
    """Handler that applies each change batch (doc_id, op, seq, ...) to a versioned table of chunks.

    A batch makes one version and writes only the buckets of its documents; readers need no merge. The version
    remembers the batch, so a repeated batch changes nothing. A document's changes must come in the order of ``seq``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id > table.last_batch():
            apply_changes_to(table, batch, build, batch=batch_id)

    return handle


def current_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table the log stands for: rows of each document's highest seq, markers left out."""
    log = spark.read.parquet(path)
    newest = log.groupBy("doc_id").agg(F.max("seq").alias("seq"))
    return log.join(newest, ["doc_id", "seq"]).where("_live").drop("_live", "batch_id", "seq")


def compact(spark: SparkSession, path: str, new_path: str) -> None:
    """Fold a log into a fresh base at ``new_path`` as one batch; readers switch afterwards."""
    log = spark.read.parquet(path)
    newest = log.groupBy("doc_id").agg(F.max("seq").alias("seq"))
    log.join(newest, ["doc_id", "seq"]).drop("batch_id").write.mode("overwrite").parquet(f"{new_path}/batch_id=0")


def embed_new_chunks(build: Build, embed: Build, path: str) -> Callable[[DataFrame, int], None]:
    """Handler that chunks a document batch and encodes only texts no earlier batch has stored.

    Every text of the batch gets a row with its number of copies; a text that is stored
    already has no vector in it. ``counted_chunks`` puts the rows together.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = cut_lineage(distinct_content(build(batch)))
        again = None
        if batch_id > 0:
            # the store is only probed for the batch's own ids, not shuffled, when they are few
            stored = batch.sparkSession.read.parquet(path).where(F.col("batch_id") < batch_id).select("chunk_id")
            known = stored.join(broadcast_if_small(fresh.select("chunk_id")), "chunk_id", "left_semi").distinct()
            again = fresh.join(known, "chunk_id", "left_semi")
            fresh = fresh.join(known, "chunk_id", "left_anti")
        rows = embed(fresh)
        if again is not None:
            rows = rows.unionByName(again, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def counted_chunks(rows: DataFrame) -> DataFrame:
    """(chunk_id, copies, embedding) of all batches: the same however the documents were batched."""
    vector = F.first("embedding", ignorenulls=True).alias("embedding")
    return rows.groupBy("chunk_id").agg(F.sum("copies").alias("copies"), vector)
