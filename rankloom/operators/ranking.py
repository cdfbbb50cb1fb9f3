"""Rankings: (query_id, keys, score, rank), their fusion and their collapse to documents.

The order is total everywhere: score rounded to nine places, best first, then key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.scale import union_all

RRF_K = 60


def by_score(keys: Sequence[str], score: str = "score") -> list[Column]:
    return [F.round(score, 9).desc(), *[F.col(key).asc() for key in keys]]


def ranked(scored: DataFrame, k: int | None, keys: Sequence[str], per: Sequence[str] = ("query_id",)) -> DataFrame:
    """Positions 1, 2, ... per query. With ``k`` Spark cuts each partition before the shuffle."""
    position = F.row_number().over(Window.partitionBy(*per).orderBy(*by_score(keys))).cast("bigint")
    out = scored.withColumn("rank", position)
    return out if k is None else out.where(F.col("rank") <= k)


def single_query_top(scored: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    """k best rows of one query: sorted per partition, cut, merged."""
    return scored.orderBy(*by_score(keys)).limit(k)


def documents_of(ranking: DataFrame, max_docs: int | None, per: Sequence[str] = ("query_id",)) -> DataFrame:
    """Chunk ranking to document ranking: a document takes the place of its first chunk."""
    first = ranking.groupBy(*per, "doc_id").agg(F.min("rank").alias("_first"))
    position = F.row_number().over(Window.partitionBy(*per).orderBy("_first")).cast("bigint")
    out = first.withColumn("rank", position).drop("_first")
    return out if max_docs is None else out.where(F.col("rank") <= max_docs)


def merged(rankings: Mapping[str, DataFrame]) -> DataFrame:
    """Bag union of rankings with the ranker's name as a column."""
    return union_all([df.withColumn("ranker", F.lit(name)) for name, df in rankings.items()])


def reciprocal_rank_fusion(
    rankings: Mapping[str, DataFrame], k: int, keys: Sequence[str], constant: int = RRF_K
) -> DataFrame:
    """Sum of 1/(constant + rank) over rankers, k best per query.

    Equal sums are ordered by the place in the first ranker, then in the second
    and so on (missing places last), then by key.
    """
    keys = list(keys)
    names = list(rankings)
    votes = merged({n: df.select("query_id", *keys, "rank") for n, df in rankings.items()})
    places = [F.min(F.when(F.col("ranker") == n, F.col("rank"))).alias(f"{n}_rank") for n in names]
    # summed in ranker order, so the double result does not depend on row order
    score = sum((F.coalesce(1.0 / (constant + F.col(f"{n}_rank")), F.lit(0.0)) for n in names), F.lit(0.0))
    fused = votes.groupBy("query_id", *keys).agg(*places).withColumn("score", score)
    order = [F.round("score", 9).desc(), *[F.col(f"{n}_rank").asc_nulls_last() for n in names], *keys]
    position = F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast("bigint")
    return fused.withColumn("rank", position).where(F.col("rank") <= k)


def side_by_side(scores: DataFrame, rankers: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per query with ``<ranker>_<measure>`` columns."""
    cells = [
        F.max(F.when(F.col("ranker") == r, F.col(m))).alias(f"{r}_{m}") for r in rankers for m in measures
    ]
    return scores.groupBy("query_id").agg(*cells)
