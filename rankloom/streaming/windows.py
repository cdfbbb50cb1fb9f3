"""Windowed counts with watermarks. Every function takes a stream or a batch table alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATE = "2 hours"


def timely(events: DataFrame, ts: str = "ts", late: str = LATE) -> DataFrame:
    """Rows up to ``late`` behind the newest are accepted; older ones are left to the day's reprocessing."""
    return events.withWatermark(ts, late)


def tumbling(events: DataFrame, keys: Sequence[str], length: str, ts: str = "ts") -> DataFrame:
    return _opened(events.groupBy(F.window(ts, length), *keys).agg(F.count(F.lit(1)).alias("n")), keys)


def sliding(events: DataFrame, keys: Sequence[str], length: str, step: str, ts: str = "ts") -> DataFrame:
    return _opened(events.groupBy(F.window(ts, length, step), *keys).agg(F.count(F.lit(1)).alias("n")), keys)


def session(events: DataFrame, keys: Sequence[str], gap: str, ts: str = "ts") -> DataFrame:
    """Sessions per key; the window ends ``gap`` after the last event."""
    counted = events.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return _opened(counted, keys)


def _opened(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counted.select(F.col("window.start").alias("started"), F.col("window.end").alias("ended"), *keys, "n")


def once(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Each idempotency key once within the watermark; state older than it is dropped."""
    return events.dropDuplicatesWithinWatermark([key])


def close_pairs(first: DataFrame, second: DataFrame, key: str, seconds: int, ts: str = "ts") -> DataFrame:
    """Keys and slots in which both streams have events at most ``seconds`` apart.

    Each side shrinks to one row per (key, slot) with its earliest and latest
    event; only equal and neighbouring slots meet, so a busy key never forms
    pairs of events. Both sides need a watermark.
    """
    length = f"{seconds} seconds"
    micros = F.unix_micros(F.col(ts))

    def slots(df: DataFrame, name: str) -> DataFrame:
        edges = df.groupBy(F.window(ts, length), F.col(key).alias(f"{name}_key")).agg(
            F.min(micros).alias(f"{name}_lo"), F.max(micros).alias(f"{name}_hi")
        )
        return edges.select(f"{name}_key", F.window_time("window").alias(f"{name}_at"), f"{name}_lo", f"{name}_hi")

    a, b = slots(first, "a"), slots(second, "b")
    limit = F.lit(seconds * 1_000_000)
    near = (
        (F.col("a_key") == F.col("b_key"))
        & (F.col("a_at") >= F.col("b_at") - F.expr(f"INTERVAL {seconds} SECONDS"))
        & (F.col("a_at") <= F.col("b_at") + F.expr(f"INTERVAL {seconds} SECONDS"))
        & (F.col("a_lo") - F.col("b_hi") <= limit)
        & (F.col("b_lo") - F.col("a_hi") <= limit)
    )
    return a.join(b, near).select(F.col("a_key").alias(key), "a_at", "b_at")


def _beside(first: DataFrame, second: DataFrame, key: str, seconds: int, ts: str, how: str) -> DataFrame:
    """``first`` joined to the rows of ``second`` with its key at most ``seconds`` away.

    The key is compared inside a struct, which is never null: a test for null on the key itself would be moved below the
    watermarks, and a row that has only a time could not move them.
    """
    held = F.struct(F.col(key).alias("key"))
    span = F.expr(f"INTERVAL {seconds} SECONDS")
    other = second.select(held.alias("_key"), F.col(ts).alias("_at"))
    near = (F.col("_own") == F.col("_key")) & (F.col(ts) >= F.col("_at") - span) & (F.col(ts) <= F.col("_at") + span)
    return first.withColumn("_own", held).join(other, near, how)


def with_company(first: DataFrame, second: DataFrame, key: str, seconds: int, ts: str = "ts") -> DataFrame:
    """Rows of the first stream that have a row of the second with their key at most ``seconds`` away.

    A half join: each row comes out once, as soon as both have arrived, and pairs are never formed.
    State is kept only as long as the watermarks allow a partner. Both sides need a watermark. Null keys
    count as equal; drop such rows from what the stream has written, not from the stream.
    """
    return _beside(first, second, key, seconds, ts, "left_semi").drop("_own")


def without_company(first: DataFrame, second: DataFrame, key: str, seconds: int, ts: str = "ts") -> DataFrame:
    """Rows of the first stream that no row of the second comes near, once the watermarks exclude one. Null keys: see above."""
    joined = _beside(first, second, key, seconds, ts, "left_outer")
    return joined.where(F.col("_key").isNull()).drop("_own", "_key", "_at")


def reprocess_days(raw: DataFrame, build, path: str, day: str = "day") -> None:
    """Nightly job: rebuild the days in ``raw`` from all their rows, late ones included,
    replacing just those day partitions. Running it again gives the same table."""
    build(raw).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
