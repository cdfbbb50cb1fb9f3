"""Late rows as an output of their own.

A window operator drops rows behind the watermark without a trace. Here each batch is split first: rows older than
the newest row of earlier batches, less the allowed delay, are stored apart. Windows count the others at once; the days
of late rows are queued, and the nightly job counts these days again from all their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.streaming.windows import LATE


def split_late(path: str, ts: str = "ts", late: str = LATE) -> Callable[[DataFrame, int], None]:
    """Handler that stores a batch with a column ``late`` and remembers its newest row.

    A repeated batch overwrites its own folders and is judged by the same earlier batches, so it changes nothing. A row
    without a time is not late.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, behind = batch.sparkSession, F.lit(False)
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/newest").where(F.col("batch_id") < batch_id)
            limit = before.agg((F.max("newest") - F.expr(f"INTERVAL {late}")).alias("limit")).first()["limit"]
            if limit is not None:
                behind = F.coalesce(F.col(ts) < F.lit(limit), F.lit(False))
        held = f"{path}/rows/batch_id={batch_id}"
        batch.withColumn("late", behind).write.mode("overwrite").parquet(held)
        newest = spark.read.parquet(held).agg(F.max(ts).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")

    return handle


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows so far, with ``late`` and the batch that brought them."""
    return spark.read.parquet(f"{path}/rows")


def days_to_reprocess(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """(day, n_late): the days that late rows belong to."""
    return rows.where("late").groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_late"))
