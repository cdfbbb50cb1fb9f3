"""Parquet tables for chunks, vectors and run metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.scale import broadcast_if_small, cut_lineage, union_all


#: Rows of a file in a partitioned table, about.
FILE_ROWS = 1_000_000


def dealt_by(df: DataFrame, by: Sequence[str], file_rows: int = FILE_ROWS, salt: Sequence[str] = ()) -> tuple[DataFrame, list[tuple]]:
    """(``df`` with the rows of each value of ``by`` together, a large one in several parts; the values).

    Written with ``partitionBy`` it gives a few files for each value, not one for each task and value. The
    values must be few: they are counted and named on the driver.
    """
    by = list(by)
    counts = cut_lineage(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")))
    parts = counts.select(*[F.col(c).alias(f"_{c}") for c in by], F.ceil(F.col("_n") / file_rows).cast("int").alias("_parts"))
    total = parts.agg(F.sum("_parts")).first()[0]
    if not total:
        return df, []
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    spot = F.pmod(F.xxhash64(*(salt or [c for c in df.columns if c not in by])), F.col("_parts"))
    placed = df.join(F.broadcast(parts), same).select(*df.columns, spot.alias("_part"))
    return placed.repartition(total, *by, "_part").drop("_part"), [tuple(r)[: len(by)] for r in counts.collect()]


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh: all partitions are written in parallel and replace the old table."""
    if partition_by:
        df, _ = dealt_by(df, partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; running it twice changes nothing more."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_dense_id(df: DataFrame, keys: Sequence[str], name: str = "vec_id") -> DataFrame:
    """0, 1, 2, ... in key order without a global window.

    Rows are range-partitioned by key (a hot key prefix is split by the rest of
    the key) and the layout is fixed by a checkpoint; each partition then needs
    only the sizes of the partitions before it.
    """
    keys = list(keys)
    laid = cut_lineage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = laid.join(broadcast_if_small(offsets), "_part")
    return numbered.withColumn(name, F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")


# ---------------------------------------------------------------------- contract
def contract_report(
    df: DataFrame, key: Sequence[str], required: Sequence[str], vector: str | None = None, dim: int | None = None
) -> DataFrame:
    """(check, violations) for NOT NULL, unique key, vector dimension and unit length."""
    counts = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null {c}") for c in required]
    if vector is not None:
        from rankloom.functions.vectors import norm

        counts.append(F.count(F.when(F.size(vector) != dim, 1)).alias("wrong dimension"))
        counts.append(F.count(F.when(F.abs(norm(F.col(vector)) - 1) > 1e-3, 1)).alias("not unit length"))
    counted = df.agg(*counts)
    rows = [F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("violations")) for c in counted.columns]
    columns = counted.select(F.inline(F.array(*rows)))
    doubles = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return columns.unionByName(doubles.agg(F.count(F.lit(1)).alias("violations")).select(F.lit("duplicate key").alias("check"), "violations"))


def enforce_contract(report: DataFrame) -> None:
    """Raise when any check of a report has violations (the report has a handful of rows)."""
    broken = [f"{r['check']}: {r['violations']}" for r in report.where("violations > 0").collect()]
    if broken:
        raise ValueError("contract violated: " + ", ".join(broken))


def alignment(vectors: DataFrame, metadata: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys present on one side only, counted both ways."""
    key = list(key)
    left = vectors.select(*key).withColumn("_v", F.lit(1))
    right = metadata.select(*key).withColumn("_m", F.lit(1))
    return left.join(right, key, "full_outer").agg(
        F.count(F.when(F.col("_m").isNull(), 1)).alias("vectors_only"),
        F.count(F.when(F.col("_v").isNull(), 1)).alias("metadata_only"),
        F.count(F.when(F.col("_v").isNotNull() & F.col("_m").isNotNull(), 1)).alias("matched"),
    )


def per_topic(df: DataFrame) -> DataFrame:
    """Rows and distinct documents per topic, largest first."""
    counted = df.groupBy("topic", "doc_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.groupBy("topic")
        .agg(F.sum("_n").alias("n_chunks"), F.count(F.lit(1)).alias("n_docs"))
        .orderBy(F.desc("n_chunks"), "topic")
    )


def footprint(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Vectors, dimensions and bytes as float32."""
    return vectors.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.max(F.size(column)).cast("bigint").alias("dim"),
        (F.sum(F.size(column)) * 4).alias("bytes"),
    )


def metric_rows(frame: DataFrame, run: Column | str, measures: Mapping[str, Column]) -> DataFrame:
    """Measures of a run as (run, metric, value) rows, to append to a metrics table."""
    return union_all(
        [frame.select(run if isinstance(run, Column) else F.col(run), F.lit(n).alias("metric"), v.cast("double").alias("value"))
         for n, v in measures.items()]
    )
