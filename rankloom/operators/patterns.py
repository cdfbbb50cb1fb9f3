"""Windowed patterns on event tables, built so that one hot key never fills one task.

Ordered work on a key is done in pieces (key, time bucket); one summary row per
piece carries the state from piece to piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.scale import broadcast_if_small, carried_sum, two_stage_count_distinct


def _micros(column: str):
    return F.unix_micros(F.col(column))


def sessions(events: DataFrame, key: str = "user_id", ts: str = "ts", gap_seconds: int = 1800) -> DataFrame:
    """Sessions per key: number, start, end, events. A gap of exactly the limit stays inside.

    Time is cut into slots as long as the gap: events of one slot always share a
    session, so each (key, slot) shrinks to one row before the shuffle and only
    those rows are ordered.
    """
    gap = gap_seconds * 1_000_000
    slots = events.groupBy(key, F.floor(_micros(ts) / gap).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    along = Window.partitionBy(key).orderBy("_slot")
    idle = _micros("_first") - F.lag(_micros("_last")).over(along)
    opened = slots.withColumn("_new", F.when(idle.isNull() | (idle > gap), 1).otherwise(0))
    number = F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        opened.withColumn("session", number)
        .groupBy(key, "session")
        .agg(F.min("_first").alias("started"), F.max("_last").alias("ended"), F.sum("_n").alias("n_events"))
    )


def nth_highest(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """Rows holding one of the n highest distinct values of their group, ties included, with the place.

    Only distinct values are ranked; rows meet the few surviving values by join.
    """
    distinct = df.select(group, value).distinct()
    place = F.dense_rank().over(Window.partitionBy(group).orderBy(F.desc(value))).cast("bigint")
    best = distinct.withColumn("place", place).where(F.col("place") <= n)
    return df.join(broadcast_if_small(best), [group, value])


def islands(df: DataFrame, key: str, day: str) -> DataFrame:
    """Runs of consecutive days per key; repeated rows of a day are combined before ranking."""
    days = df.select(key, day).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy(day))
    return (
        days.withColumn("_run", F.date_sub(F.col(day), place))
        .groupBy(key, "_run")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n_days"))
        .drop("_run")
    )


def running_total(df: DataFrame, key: str, bucket, order: Sequence, value: str) -> DataFrame:
    """Cumulative sum per key in the given order; ``bucket`` must rise with the order."""
    summed = carried_sum(df.withColumn("_bucket", bucket), key, "_bucket", list(order), F.col(value))
    return summed.withColumn("running_total", F.col("_before") + F.col("_local")).drop("_bucket", "_before", "_local")


def rows_and_range_totals(
    df: DataFrame, key: str, peer: str, row_id: str, value: str, slice_width: int = 1_000_000
) -> DataFrame:
    """Both running totals on ties: row by row, and up to all peers (rows equal in ``peer``).

    Peers are ordered by ``row_id`` and cut into slices of it, so that neither a
    hot key nor a hot tie is gathered.
    """
    bucket = F.struct(F.col(peer), F.floor(F.col(row_id) / slice_width).alias("_slice"))
    summed = carried_sum(df.withColumn("_bucket", bucket), key, "_bucket", [F.col(row_id)], F.col(value), peer)
    return (
        summed.withColumn("rows_total", F.col("_before") + F.col("_local"))
        .withColumnRenamed("_peers", "range_total")
        .drop("_bucket", "_before", "_local")
    )


def rolling_active(events: DataFrame, key: str, ts: str, days: int = 7) -> DataFrame:
    """Distinct keys seen in the ``days`` days up to each day that has events."""
    seen = events.select(F.to_date(ts).alias("_on"), key).distinct()
    served = seen.select(
        key, F.explode(F.sequence(F.col("_on"), F.date_add("_on", days - 1))).alias("day")
    )
    counted = two_stage_count_distinct(served, ["day"], key, "active")
    return counted.join(seen.select(F.col("_on").alias("day")).distinct(), "day", "left_semi")


def within_interval(first: DataFrame, second: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """Keys with an event of ``first`` and one of ``second`` at most ``seconds`` apart, either way.

    Time is cut into buckets of that length. Two events of one bucket are always
    close enough; across neighbouring buckets only the latest of one and the
    earliest of the next matter. So both sides shrink to one row per (key, bucket)
    and no pair of events is ever formed.
    """
    step = seconds * 1_000_000
    bucket = F.floor(_micros(ts) / step)

    def edges(df: DataFrame, lo: str, hi: str) -> DataFrame:
        return df.groupBy(key, bucket.alias("_b")).agg(F.min(_micros(ts)).alias(lo), F.max(_micros(ts)).alias(hi))

    a, b = edges(first, "_a_lo", "_a_hi"), edges(second, "_b_lo", "_b_hi")
    around = b.select(
        key,
        F.explode(
            F.array(
                *[
                    F.struct((F.col("_b") + shift).alias("_b"), F.lit(shift).alias("_shift"), "_b_lo", "_b_hi")
                    for shift in (-1, 0, 1)
                ]
            )
        ).alias("_e"),
    ).select(key, "_e.*")
    close = (
        (F.col("_shift") == 0)
        | ((F.col("_shift") == 1) & (F.col("_a_lo") - F.col("_b_hi") <= step))
        | ((F.col("_shift") == -1) & (F.col("_b_lo") - F.col("_a_hi") <= step))
    )
    return a.join(around, [key, "_b"]).where(close).select(key).distinct()


def pivoted(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts with one column per distinct value, found by a first pass over combined counts.

    The values become columns, so their number is small by the nature of the result.
    """
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(row).pivot(column).agg(F.sum("_n")).na.fill(0)


def salted_totals(df: DataFrame, key: str, ts: str, value: str, seconds: int = 60) -> DataFrame:
    """Totals per key in two steps, the first spread over (key, time slice)."""
    slice_ = F.floor(_micros(ts) / (seconds * 1_000_000)).alias("_slice")
    parts = df.groupBy(key, slice_).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
    return parts.groupBy(key).agg(F.sum("_n").alias("n"), F.sum("_v").alias("total"))
