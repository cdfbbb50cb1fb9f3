"""Starting streams: file sources in, idempotent tables out.

All state and output live in the shared folder, so a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.scale import scratch_path

#: How long after the newest row a stream's closing row comes: longer than any window and watermark here.
QUIET = "2 DAYS"
#: Rows of a batch that one partition of a stream's state takes.
STATE_ROWS = 100_000


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files below ``path`` as a stream; the schema is taken from the files there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def drain_to_table(stream: DataFrame, label: str, checkpoint: str | None = None, path: str | None = None, partition_by=()) -> str:
    """Process what is there, append finished rows to Parquet files, and return their folder.

    The file sink commits each batch once, also after a restart.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()
    return path


def drain_and_close(
    build: Callable[[DataFrame], DataFrame], stream: DataFrame, newest: DataFrame, label: str, ts: str = "ts"
) -> DataFrame:
    """Process what is there, then let time pass, so that windows still open at the end are finished too.

    ``build`` takes the stream, sets its watermark and counts by windows; ``newest`` has one row, the newest ``ts``.
    When all is processed, one row comes ``QUIET`` later, null but for its time. It moves the watermark past all
    other rows; its own window never closes, so it isn't in the result. Returns the finished rows. An empty
    stream gives none. A filter in ``build`` must let the closing row through: Spark moves it below the watermark.
    """
    spark, end = stream.sparkSession, scratch_path(stream.sparkSession, f"{label}-end")
    spark.createDataFrame([], stream.schema).write.parquet(end)
    out = build(stream.unionByName(spark.readStream.schema(stream.schema).parquet(end)))
    state = scratch_path(spark, f"{label}-state")
    path = drain_to_table(out, label, state)
    last = newest.where(F.col(ts).isNotNull()).select((F.col(ts) + F.expr(f"INTERVAL {QUIET}")).alias(ts))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema if f.name != ts]
    last.select(ts, *empty).write.mode("append").parquet(end)
    drain_to_table(out, label, state, path)
    return spark.read.schema(out.schema).parquet(path)


def state_partitions(spark: SparkSession, rows: int) -> int:
    """How many partitions the state of a stream needs, if a batch has ``rows`` rows.

    Each partition writes its stores' files in every batch, be there rows or not, so their number follows the rows: one for
    each core, or as many as keep them small; never more than the session's shuffles have.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-rows // STATE_ROWS))
    return min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def _settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Settings (dots as double underscores) for streams started within; a stream keeps those it was started with."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, str(value).lower())
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def drain_in_stages(
    build: Callable[[DataFrame], DataFrame], rows: DataFrame, stage: Column, n: int, label: str, ts: str = "ts", close: bool = True
) -> DataFrame:
    """Let a table arrive in ``n`` stages, each processed as one batch with the state of those before, and close it.

    ``stage`` numbers the rows 0 to n - 1. ``build`` takes the stream and sets its watermark. The closing row (see
    ``drain_and_close``) has only a time: filters in ``build`` must let a row through whose other columns are null, since
    Spark moves filters (also those that a join on a nullable key implies) below the watermark, which otherwise never sees it.

    A stage settles what the watermark of the stage before allows; no batch without rows is run in between, as it would
    write all state once more. Only after the closing row one finishes what is left.
    """
    spark = rows.sparkSession
    largest = rows.groupBy(stage.alias("_stage")).count().agg(F.max("count")).first()[0] or 0
    parts = state_partitions(spark, largest)
    arrived, state, path = (scratch_path(spark, f"{label}-{part}") for part in ("arrived", "state", "out"))
    out = None

    def drained(finish: bool = False) -> None:
        nonlocal out
        out = build(spark.readStream.schema(rows.schema).parquet(arrived))
        with _settings(spark, spark__sql__shuffle__partitions=parts, spark__sql__streaming__noDataMicroBatches__enabled=finish):
            drain_to_table(out, label, state, path)

    for i in range(n):
        rows.where(stage == i).write.mode("append").parquet(arrived)
        drained()
    newest = rows.agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull()) if close else None
    if newest is not None:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != ts]
        last = newest.select((F.col(ts) + F.expr(f"INTERVAL {QUIET}")).alias(ts), *empty)
        last.select(*rows.columns).write.mode("append").parquet(arrived)
        drained(finish=True)
    return spark.read.schema(out.schema).parquet(path)


def drain_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], label: str, mode: str = "append", checkpoint: str | None = None
) -> None:
    """Process what is there through ``handle(batch, batch_id)``; a repeated batch has the same id."""
    (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def feed_in_stages(rows: DataFrame, stage: Column, n: int, handle: Callable[[DataFrame, int], None], label: str) -> None:
    """Let a table arrive in ``n`` stages, each going through ``handle(batch, batch_id)`` as one batch."""
    spark = rows.sparkSession
    arrived, state = scratch_path(spark, f"{label}-arrived"), scratch_path(spark, f"{label}-state")
    for i in range(n):
        rows.where(stage == i).write.mode("append").parquet(arrived)
        drain_batches(spark.readStream.schema(rows.schema).parquet(arrived), handle, label, checkpoint=state)
