"""The given tables in the shapes the operators expect."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.operators import postings
from rankloom.operators.chunking import fixed_chunks, swept_chunks
from rankloom.operators.encoding import embed
from rankloom.operators.evaluation import passage_labels
from rankloom.operators.lexical import term_weights
from rankloom.scale import scratch_path, spread, through_table
from rankloom.session import apply_settings

CHUNK = (32, 8)
#: Chunk sizes that are compared with each other.
CONFIGS = ((32, 8), (64, 16))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source as topic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("topic"), "lang", "text")
    return spread(docs, "doc_id")


def eval_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage as a query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant in UTC."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def plain_ts(ts: Column) -> Column:
    """An instant as a time without zone, as results are compared."""
    return ts.cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


_BUILT: dict[tuple, tuple[tuple, DataFrame]] = {}


def _version(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> tuple:
    """Changes with the files of these tables: how many, how long, and when they or their folder were written; no job."""
    context, found = spark.sparkContext, []
    for name in names:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        held = files.getContentSummary(path)
        found.append((held.getFileCount(), held.getLength(), files.getFileStatus(path).getModificationTime()))
    return tuple(found)


def _once(
    spark: SparkSession,
    key: tuple,
    build: Callable[[], DataFrame],
    *names: str,
    keep: Callable[[DataFrame, str], DataFrame] = through_table,
) -> DataFrame:
    """Tables derived from the tables ``names`` (the documents, if none), once per application while those stay as they are.

    ``keep`` writes what is built and reads it back.
    """
    apply_settings(spark)
    version = _version(spark, key[1], names or ("documents",))
    key = (spark.sparkContext.applicationId, *key)
    if key not in _BUILT or _BUILT[key][0] != version:
        _BUILT[key] = (version, keep(build(), str(key[1])))
    return _BUILT[key][1]


def chunk_index(spark: SparkSession, sf_dir: str, size: int = CHUNK[0], overlap: int = CHUNK[1]) -> DataFrame:
    """Chunks with terms and vectors, written once, a folder for each topic: rankers read only their own columns, and
    searches in some topics only these folders."""

    def build() -> DataFrame:
        chunks = fixed_chunks(documents(spark, sf_dir).select("doc_id", "topic", "text"), size, overlap)
        return embed(chunks).withColumn("terms", T.word_terms(F.col("text")))

    return _once(spark, ("chunk-index", sf_dir, size, overlap), build, keep=_by_topic)


def _by_topic(rows: DataFrame, label: str) -> DataFrame:
    """Written as the rows are made, with neither shuffle nor sort: a task keeps a file open for each topic it meets."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.partitionBy("topic").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def doc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with terms and vectors, written once."""

    def build() -> DataFrame:
        return embed(documents(spark, sf_dir)).withColumn("terms", T.word_terms(F.col("text")))

    return _once(spark, ("doc-index", sf_dir), build)


def chunk_weights(spark: SparkSession, sf_dir: str, size: int = CHUNK[0], overlap: int = CHUNK[1]) -> DataFrame:
    """Term statistics of the chunk index, stored beside it."""
    key = ("chunk-weights", sf_dir, size, overlap)
    return _once(spark, key, lambda: term_weights(chunk_index(spark, sf_dir, size, overlap)))


def doc_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, ("doc-weights", sf_dir), lambda: term_weights(doc_index(spark, sf_dir)))


def config_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of all CONFIGS in one index, with their configuration as a column, from one pass over the text."""

    def build() -> DataFrame:
        chunks = swept_chunks(documents(spark, sf_dir).select("doc_id", "text"), CONFIGS).drop("chunk_id", "n_tokens_ws")
        return embed(chunks).withColumn("terms", T.word_terms(F.col("text"))).drop("text")

    return _once(spark, ("config-index", sf_dir), build)


def config_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, ("config-weights", sf_dir), lambda: term_weights(config_index(spark, sf_dir), ["config"]))


def _as_postings(rows: DataFrame, label: str) -> DataFrame:
    return postings.store(rows, scratch_path(rows.sparkSession, label))


def doc_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of whole documents, stored by bucket of the term."""
    key = ("doc-postings", sf_dir)
    return _once(spark, key, lambda: postings.postings(doc_index(spark, sf_dir), ["doc_id"]), keep=_as_postings)


def relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, doc_id): the documents that contain the passage."""

    def build() -> DataFrame:
        return passage_labels(eval_queries(spark, sf_dir), documents(spark, sf_dir))

    return _once(spark, ("relevance", sf_dir), build, "documents", "benchmark")


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed(eval_queries(spark, sf_dir), text="query")
