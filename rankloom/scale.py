"""Helpers that keep plans safe on large, skewed tables.

Everything here is exact: no helper drops, caps or samples rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
HOT_ROWS = 5_000_000


# ---------------------------------------------------------------- shared folder
def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where there is one machine: a local master.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and context.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="rankloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def through_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (columnar, prunable)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------- broadcasts
def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``: true only if its rows and bytes are within the bounds.

    Rows are counted first, so the bytes of a large table are never looked at.
    """
    if df.count() > max_rows:
        return False
    size = F.length(F.to_json(F.struct("*")))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast after measuring; otherwise leave the join to Spark and AQE.

    ``df`` is computed once: what is measured is what is joined.
    """
    df = cut_lineage(df)
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


# ------------------------------------------------------------------------ splits
def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on a scan with fewer splits than cores (small files with one row group).

    A scan that already has enough splits is left alone, so large tables are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


# ------------------------------------------------------------------------- skew
def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join a skewed ``left`` to a ``right`` that has at most one row per key.

    Keys with more than ``hot_rows`` rows on the left (there are at most
    rows/hot_rows of them) join by broadcast of their few right rows, so a hot
    key is never gathered in one task. All other keys shuffle as usual.
    """
    on = list(on)
    hot = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*on)
    hot = cut_lineage(hot)
    if hot.isEmpty():
        return left.join(right, on, how)
    hot = broadcast_if_small(hot)
    cold = left.join(hot, on, "left_anti").join(right, on, how)
    warm = left.join(hot, on, "left_semi").join(broadcast_if_small(right.join(hot, on, "left_semi")), on, how)
    return cold.unionByName(warm)


def two_stage_count_distinct(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Distinct values per key: de-duplicate on (key, value) first, then count rows.

    The first step spreads a hot key over its values; the second is a plain
    count, which combines before the shuffle.
    """
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(name))


def carried_sum(
    df: DataFrame,
    key: str,
    bucket: str,
    order: Sequence[Column],
    value: Column,
    peer: str | None = None,
) -> DataFrame:
    """Per-key running sum without gathering a key in one task.

    Rows are summed inside (key, bucket) pieces, where ``bucket`` rises with the
    order; piece totals (one row per piece) give each piece its carry-in.
    Adds ``_local`` (running sum in the piece) and ``_before`` (sum of all earlier
    pieces); with ``peer``, constant in a piece, also ``_peers`` (sum up to and
    including all rows of that peer value).
    """
    held = [key, bucket] if peer is None else [key, bucket, peer]
    totals = df.groupBy(*held).agg(F.sum(value).alias("_piece"))
    along = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_piece").over(along), F.lit(0.0)))
    if peer is not None:
        level = Window.partitionBy(key).orderBy(peer).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        totals = totals.withColumn("_peers", F.sum("_piece").over(level)).drop(peer)
    inside = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_local", F.sum(value).over(inside)).join(totals.drop("_piece"), [key, bucket])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
