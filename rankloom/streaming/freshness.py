"""How far the index runs behind its sources; the same expressions serve batch and stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lag_per_source(rows: DataFrame, alert_seconds: int = 30) -> DataFrame:
    """Largest lag and number of rows over the alert limit, per source."""
    lag = F.unix_timestamp("indexed_at") - F.unix_timestamp("source_ts")
    return rows.groupBy("source").agg(
        F.max(lag).alias("max_lag_seconds"),
        F.count(F.when(lag > alert_seconds, 1)).alias(f"n_over_{alert_seconds}s"),
    )


def against_limits(lags: DataFrame, limit_minutes: Mapping[str, int]) -> DataFrame:
    """Adds the agreed limit of each source and whether it is broken; limits are a fixed few."""
    limits = F.create_map(*[F.lit(x) for pair in limit_minutes.items() for x in pair])
    limit = limits[F.col("source")].cast("bigint")
    return lags.withColumn("sla_minutes", limit).withColumn("breached", F.col("max_lag_seconds") > limit * 60)
