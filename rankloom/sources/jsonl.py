"""JSON Lines sources and sinks with fixed schemas; a malformed line fails the read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

CORPUS = S.StructType(
    [
        S.StructField("doc_id", S.StringType()),
        S.StructField("topic", S.StringType()),
        S.StructField("text", S.StringType()),
    ]
)
CHUNKS = S.StructType(
    [
        S.StructField("chunk_id", S.StringType()),
        S.StructField("doc_id", S.StringType()),
        S.StructField("chunk_index", S.IntegerType()),
        S.StructField("topic", S.StringType()),
        S.StructField("text", S.StringType()),
        S.StructField("n_tokens_ws", S.IntegerType()),
    ]
)
EVAL_QUERIES = S.StructType(
    [
        S.StructField("query_id", S.StringType()),
        S.StructField("query", S.StringType()),
        S.StructField("relevant_doc_ids", S.ArrayType(S.StringType())),
    ]
)


def _read(spark: SparkSession, path: str, schema: S.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Documents; a missing topic reads as 'unknown'. Blank lines are skipped."""
    return _read(spark, path, CORPUS).withColumn("topic", F.coalesce("topic", F.lit("unknown")))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks; an empty table is an error, as nothing could be indexed."""
    chunks = _read(spark, path, CHUNKS)
    if chunks.isEmpty():
        raise ValueError(f"no chunks at {path}: run the chunk step first")
    return chunks


def read_eval_queries(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation queries; a missing list of relevant documents reads as empty."""
    rows = _read(spark, path, EVAL_QUERIES)
    return rows.withColumn("relevant_doc_ids", F.coalesce("relevant_doc_ids", F.array().cast("array<string>")))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def labelled_texts(spark: SparkSession, rows: Iterable[Mapping[str, str]]) -> DataFrame:
    """A small corpus given in the program: rows with ``text`` and ``label``."""
    return spark.createDataFrame([(r["text"], r["label"]) for r in rows], "text string, label string")
