"""Splitting documents into chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.scale import union_all


def check_config(size: int, overlap: int) -> None:
    if size <= 0 or overlap < 0:
        raise ValueError(f"chunk size must be positive and overlap not negative, got {size}/{overlap}")
    if overlap >= size:
        raise ValueError(f"overlap {overlap} must be smaller than chunk size {size}")


def strategy_id(version: str, method: str, size: int, overlap: int, encoder: str) -> str:
    """Name of a chunking choice, stamped on every chunk and part of its key."""
    return f"{version}-{method}-{size}-{overlap}-{encoder}"


def window_count(n, size: int, overlap: int):
    """Number of windows over ``n`` tokens: the last one is the first to reach the end."""
    step = size - overlap
    return F.when(n == 0, 0).when(n <= size, 1).otherwise(F.ceil((n - size) / F.lit(step)) + 1).cast("int")


def fixed_chunks(
    docs: DataFrame, size: int, overlap: int, text: str = "text", strategy: str | None = None
) -> DataFrame:
    """Windows of ``size`` white-space tokens, each starting ``size - overlap`` after the last.

    Other columns of ``docs`` are kept. Chunks of a document are built as one
    array before the explode, so the token list is not copied to every chunk.
    """
    check_config(size, overlap)
    step = size - overlap
    others = [c for c in docs.columns if c != text]
    tokens = docs.select(*others, T.ws_tokens(F.col(text)).alias("_tokens"))
    n = F.size("_tokens")
    pieces = F.transform(
        F.sequence(F.lit(0), window_count(n, size, overlap) - 1),
        lambda i: F.slice("_tokens", i * step + 1, size),
    )
    rows = tokens.select(*others, F.posexplode(F.when(n > 0, pieces)).alias("chunk_index", "_piece"))
    chunks = rows.select(
        *others,
        "chunk_index",
        T.rejoin(F.col("_piece")).alias("text"),
        F.size("_piece").alias("n_tokens_ws"),
    ).withColumn("chunk_id", T.content_key(F.col("text")))
    return chunks if strategy is None else chunks.withColumn("chunk_strategy_id", F.lit(strategy))


def swept_chunks(docs: DataFrame, configs: Sequence[tuple[int, int]], text: str = "text") -> DataFrame:
    """The chunks of several (size, overlap) choices, told apart by ``config`` ("size/overlap"), from one pass over the text."""
    for size, overlap in configs:
        check_config(size, overlap)
    others = [c for c in docs.columns if c != text]
    tokens = docs.select(*others, T.ws_tokens(F.col(text)).alias("_tokens")).where(F.size("_tokens") > 0)
    n = F.size("_tokens")

    def pieces(size: int, overlap: int):
        return F.transform(
            F.sequence(F.lit(0), window_count(n, size, overlap) - 1),
            lambda i: F.struct(
                F.lit(f"{size}/{overlap}").alias("config"),
                i.alias("chunk_index"),
                F.slice("_tokens", i * (size - overlap) + 1, size).alias("_piece"),
            ),
        )

    rows = tokens.select(*others, F.inline(F.concat(*[pieces(*c) for c in configs])))
    named = rows.withColumn("text", T.rejoin(F.col("_piece"))).withColumn("n_tokens_ws", F.size("_piece"))
    return named.drop("_piece").withColumn("chunk_id", T.content_key(F.col("text")))


def sentence_chunks(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Whole sentences packed greedily up to ``size`` tokens.

    A sentence longer than ``size`` becomes a chunk of its own and is not cut.
    """
    check_config(size, 0)
    others = [c for c in docs.columns if c != text]
    clean = F.transform(T.sentences(F.col(text)), lambda s: T.rejoin(T.ws_tokens(s)))
    split = docs.select(*others, F.filter(clean, lambda s: s != "").alias("_sentences"))
    start = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n")
    )

    def pack(state, sentence):
        count = F.size(F.split(sentence, " "))
        fits = (state["n"] == 0) | (state["n"] + count <= size)
        return F.struct(
            F.when(fits, state["done"]).otherwise(F.concat(state["done"], F.array(state["open"]))).alias("done"),
            F.when(state["n"] == 0, sentence)
            .when(fits, F.concat_ws(" ", state["open"], sentence))
            .otherwise(sentence)
            .alias("open"),
            F.when(fits, state["n"] + count).otherwise(count).alias("n"),
        )

    packed = F.aggregate(
        "_sentences",
        start,
        pack,
        lambda s: F.when(s["n"] > 0, F.concat(s["done"], F.array(s["open"]))),
    )
    rows = split.select(*others, F.posexplode(packed).alias("chunk_index", "text"))
    return rows.withColumn("n_tokens_ws", F.size(F.split("text", " "))).withColumn(
        "chunk_id", T.content_key(F.col("text"))
    )


def ingest_counts(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents, chunks and chunks per document; documents without tokens count."""
    per_doc = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        docs.select("doc_id")
        .join(per_doc, "doc_id", "left")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_chunks"))
        .withColumn("chunks_per_doc", F.col("n_chunks") / F.greatest("n_docs", F.lit(1)))
    )


def size_sweep(docs: DataFrame, configs: Sequence[tuple[int, int]], text: str = "text") -> DataFrame:
    """Chunk statistics for several (size, overlap) choices.

    Lengths follow from token counts alone, so no chunk is materialised: one
    pass counts tokens and a second, small step expands window lengths.
    """
    for size, overlap in configs:
        check_config(size, overlap)
    lengths = docs.select(F.size(T.ws_tokens(F.col(text))).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("docs"))

    def measured(size: int, overlap: int) -> DataFrame:
        windows = window_count(F.col("n"), size, overlap).cast("bigint")
        last = F.col("n") - (windows - 1) * (size - overlap)
        return lengths.select(
            F.lit(size).alias("size"),
            F.lit(overlap).alias("overlap"),
            "docs",
            (windows * F.col("docs")).alias("chunks"),
            F.when(windows > 0, ((windows - 1) * size + last) * F.col("docs")).otherwise(0).alias("tokens"),
            F.when(windows > 1, size).when(windows == 1, F.col("n")).alias("longest"),
        )

    return (
        union_all([measured(s, o) for s, o in configs])
        .groupBy("size", "overlap")
        .agg(
            F.sum("chunks").alias("n_chunks"),
            F.round(F.sum("chunks") / F.sum("docs"), 2).alias("chunks_per_doc"),
            F.round(F.sum("tokens") / F.sum("chunks"), 1).alias("avg_len"),
            F.max("longest").alias("max_len"),
        )
    )


def distinct_content(chunks: DataFrame) -> DataFrame:
    """One row per chunk_id: the copy with the lowest (doc_id, chunk_index)."""
    kept = F.min(F.struct("doc_id", "chunk_index", "text")).alias("_first")
    return chunks.groupBy("chunk_id").agg(kept, F.count(F.lit(1)).alias("copies")).select(
        "chunk_id", "_first.*", "copies"
    )


def one_strategy(chunks: DataFrame, strategy: str) -> DataFrame:
    """Chunks of the required strategy; fails at run time when others are mixed in."""
    wrong = F.raise_error(
        F.concat(F.lit(f"expected chunk strategy {strategy}, found "), F.coalesce("chunk_strategy_id", F.lit("none")))
    )
    same = F.coalesce(F.col("chunk_strategy_id") == strategy, F.lit(False))
    return chunks.withColumn(
        "chunk_strategy_id", F.when(same, F.col("chunk_strategy_id")).otherwise(wrong.cast("string"))
    )
