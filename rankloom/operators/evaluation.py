"""Scoring rankings against relevance labels.

Labels are rows (query_id, doc_id), never one long array per query, so a query
with very many relevant documents is counted with map-side combining.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.scale import broadcast_if_small

CUTS = (1, 3, 10)


def labels_from_lists(eval_queries: DataFrame) -> DataFrame:
    """(query_id, relevant_doc_ids) to distinct rows; empty and missing lists give none."""
    return eval_queries.select("query_id", F.explode("relevant_doc_ids").alias("doc_id")).distinct()


def top_docs(doc_ranking: DataFrame, n: int = 5, per: Sequence[str] = ("query_id",)) -> DataFrame:
    """The first ``n`` documents joined by ' > '."""
    listed = F.array_sort(F.collect_list(F.struct("rank", F.col("doc_id").cast("string").alias("doc"))))
    return (
        doc_ranking.where(F.col("rank") <= n)
        .groupBy(*per)
        .agg(F.concat_ws(" > ", F.transform(listed, lambda s: s["doc"])).alias("top_docs"))
    )


def query_scores(
    queries: DataFrame,
    doc_ranking: DataFrame,
    labels: DataFrame,
    cuts: Sequence[int] = CUTS,
    rr_cut: int = 10,
    per: Sequence[str] = (),
) -> DataFrame:
    """recall@k (share of relevant found), hit@k (any found) and reciprocal rank per query.

    All are NULL for queries without relevant documents. ``per`` adds columns such
    as a ranker or configuration that ``queries`` must carry too.
    """
    per = list(per)
    relevant = labels.select("query_id", "doc_id").distinct()
    counts = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    found = doc_ranking.join(relevant, ["query_id", "doc_id"], "left_semi")
    tallies = [F.count(F.when(F.col("rank") <= k, 1)).alias(f"_found_{k}") for k in cuts]
    found = found.groupBy(*per, "query_id").agg(*tallies, F.min("rank").alias("_first"))
    base = (
        queries.select(*per, "query_id")
        .join(counts, "query_id", "left")
        .join(found, [*per, "query_id"], "left")
        .withColumn("n_relevant", F.coalesce("n_relevant", F.lit(0)))
    )
    scored = F.col("n_relevant") > 0
    got = {k: F.coalesce(F.col(f"_found_{k}"), F.lit(0)) for k in cuts}
    first = F.when(F.col("_first") <= rr_cut, 1.0 / F.col("_first"))
    return base.select(
        *per,
        "query_id",
        "n_relevant",
        *[F.when(scored, got[k] / F.col("n_relevant")).alias(f"recall_at_{k}") for k in cuts],
        *[F.when(scored, (got[k] > 0).cast("bigint")).alias(f"hit_at_{k}") for k in cuts],
        F.when(scored, F.coalesce(first, F.lit(0.0))).alias("rr"),
    )


def macro_means(scores: DataFrame, cuts: Sequence[int] = CUTS, per: Sequence[str] = ()) -> DataFrame:
    """Means over the queries that have labels, with scored and total counts."""
    return scores.groupBy(*per).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.count("rr").alias("n_scored"),
        *[F.avg(f"recall_at_{k}").alias(f"recall_at_{k}") for k in cuts],
        *[F.avg(f"hit_at_{k}").alias(f"hit_rate_at_{k}") for k in cuts],
        F.avg("rr").alias("mrr"),
    )


def off_topic(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """Queries without any relevant document."""
    return queries.join(labels.select("query_id").distinct(), "query_id", "left_anti")


def scorable(queries: DataFrame, labels: DataFrame) -> DataFrame:
    return queries.join(labels.select("query_id").distinct(), "query_id", "left_semi")


def delta(means: DataFrame, column: str, base: str, other: str, measures: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """``other`` minus ``base`` (values of ``column``) for each measure, with both sides; for each value of ``per``."""
    def side(name: str, measure: str):
        return F.max(F.when(F.col(column) == name, F.col(measure)))

    rows = [
        F.struct(
            F.lit(m).alias("measure"),
            side(base, m).alias("base"),
            side(other, m).alias("other"),
            (side(other, m) - side(base, m)).alias("delta"),
        )
        for m in measures
    ]
    return means.groupBy(*per).agg(F.array(*rows).alias("_rows")).select(*per, F.inline("_rows"))


def cut_over_gate(means: DataFrame, column: str, old: str, new: str, measure: str, tolerance: float) -> DataFrame:
    """Whether the new version may replace the old: new >= old - tolerance."""
    return delta(means, column, old, new, [measure]).select(
        "measure",
        F.col("base").alias("old_value"),
        F.col("other").alias("new_value"),
        (F.col("other") >= F.col("base") - tolerance).alias("cut_over"),
    )


def answerable(hits: DataFrame, threshold: float) -> DataFrame:
    """Per query: best score and whether it reaches the threshold."""
    return (
        hits.groupBy("query_id")
        .agg(F.max("score").alias("top_score"))
        .withColumn("answerable", F.col("top_score") >= threshold)
    )


def drift_alerts(daily: DataFrame, day: str = "day", value: str = "recall5", drop: float = 0.05) -> DataFrame:
    """Alert when a day falls more than ``drop`` below the mean of the seven days before it.

    The input is one row per day, so a single ordered pass is small by nature.
    """
    date = F.unix_date(F.col(day))
    before = Window.partitionBy(F.lit(0)).orderBy(date).rangeBetween(-7, -1)
    return daily.withColumn("baseline", F.avg(value).over(before)).withColumn(
        "alert", F.coalesce(F.col(value) < F.col("baseline") * (1 - drop), F.lit(False))
    )


def sampled_queries(log: DataFrame, n: int, id_col: str, ts_col: str) -> DataFrame:
    """``n`` log rows per month, chosen by hash of the id: the same on every run."""
    month = F.date_trunc("month", F.col(ts_col))
    pick = F.sha2(F.col(id_col).cast("string").cast("binary"), 256)
    place = F.row_number().over(Window.partitionBy("month").orderBy("_pick", id_col)).cast("bigint")
    return (
        log.withColumn("month", month)
        .withColumn("_pick", pick)
        .withColumn("place", place)
        .where(F.col("place") <= n)
        .drop("_pick")
    )


def passage_labels(queries: DataFrame, docs: DataFrame, query: str = "query", text: str = "text") -> DataFrame:
    """(query_id, doc_id) for documents that contain the query text as it stands.

    Text can only be contained where its inner tokens occur, so each query is
    joined on its rarest inner token and then verified; no query meets every
    document. Queries of one or two tokens have no inner one: their longest token
    is part of a document's token, so it is looked up in the distinct vocabulary by
    its first characters, and the tokens found lead to documents. Empty queries
    have no labels.
    """
    found = _labels_by_token(queries, docs, query, text)
    size = F.size(T.ws_tokens(F.col(query)))
    short = queries.where(size.between(1, 2)).select("query_id", query)
    if short.isEmpty():
        return found
    return found.unionByName(_labels_by_part(short, docs, query, text))


def _labels_by_part(queries: DataFrame, docs: DataFrame, query: str, text: str) -> DataFrame:
    tokens = T.ws_tokens(F.col(query))
    longest = F.array_max(F.transform(tokens, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    asked = queries.select("query_id", query, longest.alias("_part")).withColumn("_head", F.substring("_part", 1, 3))
    held = docs.select("doc_id", F.explode(F.array_distinct(T.ws_tokens(F.col(text)))).alias("_token"))

    def heads(size: int) -> Column:
        at = F.when(F.length("_token") >= size, F.sequence(F.lit(1), F.length("_token") - size + 1))
        return F.coalesce(F.transform(at, lambda i: F.substr(F.col("_token"), i, F.lit(size))), F.array().cast("array<string>"))

    words = held.select("_token").distinct()
    words = words.select("_token", F.explode(F.array_distinct(F.concat(*[heads(n) for n in (1, 2, 3)]))).alias("_head"))
    parts = asked.select("_head", "_part").distinct()
    known = words.join(broadcast_if_small(parts), "_head").where(F.contains(F.col("_token"), F.col("_part"))).select("_token", "_part")
    candidates = held.join(known, "_token").select("doc_id", "_part").distinct()
    pairs = candidates.join(asked.select("query_id", query, "_part"), "_part").select("doc_id", "query_id", query)
    return docs.select("doc_id", text).join(pairs, "doc_id").where(F.contains(F.col(text), F.col(query))).select("query_id", "doc_id")


def _labels_by_token(queries: DataFrame, docs: DataFrame, query: str, text: str) -> DataFrame:
    inner = F.array_distinct(F.slice("_t", 2, F.greatest(F.size("_t") - 2, F.lit(0))))
    asked = queries.select("query_id", query, T.ws_tokens(F.col(query)).alias("_t")).select(
        "query_id", query, F.explode(inner).alias("_token")
    )
    tokens = broadcast_if_small(asked.select("_token").distinct())
    held = docs.select("doc_id", F.explode(F.array_distinct(T.ws_tokens(F.col(text)))).alias("_token"))
    held = held.join(tokens, "_token", "left_semi")
    frequency = held.groupBy("_token").agg(F.count(F.lit(1)).alias("_df"))
    rarest = broadcast_if_small(
        asked.join(frequency, "_token")
        .groupBy("query_id")
        .agg(F.min(F.struct("_df", "_token"))["_token"].alias("_token"))
        .join(queries.select("query_id", query), "query_id")
    )
    # candidate pairs carry ids only; the text joins them once, by document
    candidates = held.join(rarest, "_token").drop("_token")
    pairs = docs.select("doc_id", text).join(broadcast_if_small(candidates), "doc_id")
    return pairs.where(F.contains(F.col(text), F.col(query))).select("query_id", "doc_id")
