"""BM25 (Okapi form) for a table of queries."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.operators.ranking import ranked
from rankloom.operators.topk import SCAN_QUERY_ROWS, QueryBlock, scan_candidates
from rankloom.scale import broadcast_if_small, cut_lineage, union_all

# fixed values of the scoring formula
K1 = 1.5
B = 0.75
EPSILON = 0.25


def with_terms(rows: DataFrame, text: str = "text") -> DataFrame:
    return rows.withColumn("terms", T.word_terms(F.col(text)))


def corpus_stats(corpus: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """One row (for each value of ``per``): number of rows and mean length in terms."""
    return corpus.groupBy(*per).agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("terms")).alias("avgdl"))


def document_frequency(corpus: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Rows per term. Terms are made distinct inside the row, so no (row, term) shuffle is needed."""
    terms = corpus.select(*per, F.explode(F.array_distinct("terms")).alias("term"))
    # the filter a join on term would add, so that all uses share one exchange
    return terms.where(F.col("term").isNotNull()).groupBy(*per, "term").agg(F.count(F.lit(1)).alias("df"))


def term_weights(corpus: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """(*per, term, idf, avgdl) of a corpus: the statistics to store beside its index.

    A negative idf becomes EPSILON times the mean idf of the whole vocabulary. With ``per`` each of
    its values is a corpus of its own; there must be few.
    """
    per = list(per)
    if per:
        frequency = document_frequency(corpus, per).join(F.broadcast(corpus_stats(corpus, per)), per)
        frequency = frequency.withColumn("idf", F.ln(F.col("n") - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5))
        floor = frequency.groupBy(*per).agg((F.avg("idf") * EPSILON).alias("floor"))
        frequency = frequency.join(F.broadcast(floor), per)
        idf = F.when(F.col("idf") < 0, F.col("floor")).otherwise(F.col("idf"))
        return frequency.select(*per, "term", idf.alias("idf"), "avgdl")
    stats = corpus_stats(corpus)
    n = stats.select("n").scalar()
    frequency = document_frequency(corpus).withColumn(
        "idf", F.ln(n - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    )
    floor = frequency.agg((F.avg("idf") * EPSILON).alias("floor"))
    idf = F.when(F.col("idf") < 0, floor.scalar()).otherwise(F.col("idf"))
    return frequency.select("term", idf.alias("idf"), stats.select("avgdl").scalar().alias("avgdl"))


def query_weights(queries: DataFrame, weights: DataFrame, text: str = "query", per: Sequence[str] = ()) -> DataFrame:
    """(*per, query_id, term, weight, avgdl): idf times the term's count in the query.

    Terms the corpus lacks drop out.
    """
    asked = (
        queries.select("query_id", F.explode(T.word_terms(F.col(text))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
    return asked.join(weights, "term").select(*per, "query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"), "avgdl")


class TermCounts(NamedTuple):
    """Distinct terms of some rows, (row, term, tf) in row order, and the rows' lengths."""

    terms: pa.Array
    row: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    length: np.ndarray


class LexicalScorer:
    """BM25 of a block of queries against a block of rows.

    Scores are a product of two sparse matrices. Terms that many queries ask for
    would meet every row that holds them, so those go through a dense product;
    the others are added up one by one.
    """

    query_columns = ("term", "weight", "avgdl")
    corpus_columns = ("terms",)
    dense_share = 64  # a term is common when one query in this many asks for it
    dense_cells = 16_000_000

    def prepare(self, queries: pa.Table) -> QueryBlock:
        q = pa.concat_arrays(queries.column("query_id").chunks).dictionary_encode()
        t = pa.concat_arrays(queries.column("term").chunks).dictionary_encode()
        query = q.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        term = t.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        weight = queries.column("weight").to_numpy()
        n, fan = len(q.dictionary), np.bincount(term, minlength=len(t.dictionary))
        common = np.argsort(-fan, kind="stable")[: self.dense_cells // n]
        common = common[fan[common] * self.dense_share >= n]
        # a weight of zero would be lost in the dense product
        zero = np.unique(term[weight == 0])
        common = common[~np.isin(common, zero)]
        place = np.full(len(fan), -1, np.int64)
        place[common] = np.arange(len(common))
        dense = np.zeros((n, len(common)))
        of_common = place[term] >= 0
        dense[query[of_common], place[term[of_common]]] = weight[of_common]
        rare_query, rare_term, rare_weight = query[~of_common], term[~of_common], weight[~of_common]
        order = np.argsort(rare_term, kind="stable")
        state = {
            "vocabulary": t.dictionary,
            "n": n,
            "avgdl": queries.column("avgdl")[0].as_py(),
            "place": place,
            "dense": dense,
            "starts": np.concatenate([[0], np.cumsum(np.bincount(rare_term, minlength=len(fan)))]),
            "query": rare_query[order],
            "weight": rare_weight[order],
            # with weights above zero a score above zero tells that a term matched
            "positive": bool((weight > 0).all()),
        }
        return QueryBlock(q.dictionary, state)

    def read(self, rows: pa.Table) -> TermCounts:
        """The terms of a block of rows, counted once for all blocks of queries."""
        terms = rows.column("terms")
        terms = pa.concat_arrays(terms.chunks) if isinstance(terms, pa.ChunkedArray) else terms
        length = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.float64)
        named = terms.flatten().dictionary_encode()
        known = pc.is_valid(named.indices).to_numpy(zero_copy_only=False)
        term = named.indices.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        row = pc.list_parent_indices(terms).to_numpy(zero_copy_only=False)[known].astype(np.int64)
        n_terms = max(1, len(named.dictionary))
        pair, tf = np.unique(row * n_terms + term, return_counts=True)
        return TermCounts(named.dictionary, pair // n_terms, pair % n_terms, tf, length)

    def scores(self, state: dict, rows: pa.Table | TermCounts) -> np.ndarray:
        rows = rows if isinstance(rows, TermCounts) else self.read(rows)
        asked = pc.fill_null(pc.index_in(rows.terms, value_set=state["vocabulary"]), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        hit = (asked >= 0)[rows.term]
        row, term, tf = rows.row[hit], asked[rows.term[hit]], rows.tf[hit]
        impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * rows.length[row] / state["avgdl"]))
        return self.totals(state, row, term, impact, len(rows.length))

    def totals(self, state: dict, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_rows: int) -> np.ndarray:
        """(queries, rows) scores from the impacts of terms in rows; NaN where no term matches."""
        total = self._product(state, row, term, impact, n_rows)
        if state["positive"]:
            total[total <= 0] = np.nan
        else:
            ones = {**state, "dense": (state["dense"] != 0) * 1.0, "weight": np.ones_like(state["weight"])}
            total[self._product(ones, row, term, np.ones_like(impact), n_rows) == 0] = np.nan
        return total

    @staticmethod
    def _product(state: dict, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_rows: int) -> np.ndarray:
        place = state["place"][term]
        common = place >= 0
        held = np.zeros((n_rows, state["dense"].shape[1]))
        held[row[common], place[common]] = impact[common]
        total = state["dense"] @ held.T
        row, term, impact = row[~common], term[~common], impact[~common]
        fan = state["starts"][term + 1] - state["starts"][term]
        source = np.repeat(np.arange(len(row)), fan)
        ask = np.arange(len(source)) - np.repeat(np.cumsum(fan) - fan - state["starts"][term], fan)
        slot = state["query"][ask] * n_rows + row[source]
        added = np.bincount(slot, weights=impact[source] * state["weight"][ask], minlength=total.size)
        return total + added.reshape(total.shape)


def bm25(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    keys: Sequence[str],
    text: str = "query",
    weights: DataFrame | None = None,
) -> DataFrame:
    """Top-k rows of ``corpus`` (keys, terms) per query; rows sharing no term are no hits.

    ``weights`` are the stored ``term_weights`` of the corpus; they are computed when not given. Every row is
    scored where it lies, so the corpus is never shuffled; more queries than a task can hold go in several passes.
    """
    weights = term_weights(corpus) if weights is None else weights
    asked = cut_lineage(query_weights(queries, weights, text))
    passes = max(1, math.ceil(asked.count() / SCAN_QUERY_ROWS))
    turn = F.pmod(F.xxhash64("query_id"), F.lit(passes))
    found = [scan_candidates(asked.where(turn == i) if passes > 1 else asked, corpus, LexicalScorer(), k, keys) for i in range(passes)]
    return ranked(union_all(found), k, list(keys))


def bm25_by_key(
    queries: DataFrame, corpus: DataFrame, k: int, keys: Sequence[str], text: str = "query", weights: DataFrame | None = None
) -> DataFrame:
    """``bm25`` for a corpus whose keys may repeat: rows of one key are one hit with the sum of their scores.

    Rows of one key and one length count their terms together. Repeated keys are scored by joins, all others in
    place. Queries without an id find nothing.
    """
    keys = list(keys)
    weights = term_weights(corpus) if weights is None else weights
    queries = queries.where(F.col("query_id").isNotNull())
    again = cut_lineage(corpus.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys))
    if again.isEmpty():
        return bm25(queries, corpus, k, keys, text, weights)
    named = broadcast_if_small(again.toDF(*[f"_{key}" for key in keys]))
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    several = corpus.join(named, same, "left_semi").select(*keys, F.size("terms").alias("_length"), F.explode("terms").alias("term"))
    counted = several.groupBy(*keys, "_length", "term").agg(F.count(F.lit(1)).alias("_tf"))
    impact = F.col("_tf") * (K1 + 1) / (F.col("_tf") + K1 * (1 - B + B * F.col("_length") / F.col("avgdl")))
    added = counted.join(query_weights(queries, weights, text), "term").select("query_id", *keys, (F.col("weight") * impact).alias("score"))
    scored = added.groupBy("query_id", *keys).agg(F.sum("score").alias("score"))
    once = bm25(queries, corpus.join(named, same, "left_anti"), k, keys, text, weights)
    return ranked(once.select("query_id", *keys, "score").unionByName(scored), k, keys)
