"""Approximate vector search: cells, random projections, product codes.

All three only choose which rows are scored; the scoring and the cut are the
exact block search, so hot cells are split there and nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import vectors as V
from rankloom.operators.ranking import ranked
from rankloom.operators.topk import QueryBlock, VectorScorer, top_k
from rankloom.scale import broadcast_if_small, through_table


def _as_ml(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.withColumn("_ml", array_to_vector(F.col(column).cast("array<double>")))


def train_cells(vectors: DataFrame, n_cells: int, seed: int = 7, iterations: int = 10):
    """k-means model whose clusters are the cells."""
    return KMeans(k=n_cells, seed=seed, maxIter=iterations, featuresCol="_ml", predictionCol="cell").fit(
        _as_ml(vectors.select("embedding"))
    )


def assign_cells(vectors: DataFrame, model) -> DataFrame:
    return model.transform(_as_ml(vectors)).drop("_ml")


def cell_search(
    queries: DataFrame, celled: DataFrame, model, n_probe: int, k: int, keys: Sequence[str]
) -> DataFrame:
    """Score each query against the rows of its ``n_probe`` nearest cells.

    With ``n_probe`` equal to the number of cells the result is exact.
    """
    spark = queries.sparkSession
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centres = spark.createDataFrame(centres, "cell int, embedding array<double>")
    near = top_k(queries, centres, VectorScorer(metric="l2"), n_probe, ["cell"]).select("query_id", "cell")
    probes = near.join(queries, "query_id")
    return top_k(probes, celled, VectorScorer(), k, keys, cell="cell")


def projection_search(
    queries: DataFrame, vectors: DataFrame, k: int, keys: Sequence[str], tables: int = 4, width: float = 0.5, seed: int = 7
) -> DataFrame:
    """Score each query against the rows that share a random-projection bucket in any table."""
    lsh = BucketedRandomProjectionLSH(
        inputCol="_ml", outputCol="_hashes", bucketLength=width, numHashTables=tables, seed=seed
    )
    model = lsh.fit(_as_ml(vectors))

    def bucketed(df: DataFrame) -> DataFrame:
        hashed = model.transform(_as_ml(df)).drop("_ml")
        opened = hashed.select(*df.columns, F.posexplode("_hashes").alias("_table", "_hash"))
        number = vector_to_array("_hash")[0].cast("bigint")
        return opened.select(*df.columns, F.concat_ws(":", "_table", number).alias("cell"))

    return top_k(bucketed(queries), bucketed(vectors), VectorScorer(), k, keys, cell="cell")


class CodeScorer:
    """Inner products of exact queries with product-coded rows, by table lookup."""

    query_columns = ("embedding",)
    corpus_columns = ("codes",)

    def __init__(self, books: np.ndarray):
        self.books = books  # (parts, codes per part, part length)

    def prepare(self, queries: pa.Table) -> QueryBlock:
        block = VectorScorer().prepare(queries)
        if len(block) == 0:
            return block
        parts, _, length = self.books.shape
        split = block.data.reshape(len(block), parts, length)
        return QueryBlock(block.ids, np.einsum("qpl,pcl->qpc", split, self.books))

    def scores(self, state: np.ndarray, rows: pa.Table) -> np.ndarray:
        codes = VectorScorer("codes")._matrix(rows.column("codes")).astype(np.int64)
        total = np.zeros((len(state), len(codes)))
        for part in range(state.shape[1]):
            total += state[:, part, :][:, codes[:, part]]
        return total


def train_codes(vectors: DataFrame, dim: int, parts: int, codes: int = 16, seed: int = 7):
    """One k-means model per slice of the vector."""
    if dim % parts:
        raise ValueError(f"dimension {dim} does not divide into {parts} parts")
    length = dim // parts
    models = []
    for part in range(parts):
        piece = vectors.select(F.slice("embedding", part * length + 1, length).alias("embedding"))
        models.append(
            KMeans(k=codes, seed=seed, maxIter=5, featuresCol="_ml", predictionCol="code").fit(_as_ml(piece))
        )
    return models


def encode_codes(vectors: DataFrame, models: Sequence) -> DataFrame:
    """Adds ``codes``: the nearest centre of each slice. Runs inside the JVM, no shuffle."""
    out = vectors
    length = len(models[0].clusterCenters()[0])
    for part, model in enumerate(models):
        piece = F.slice("embedding", part * length + 1, length).cast("array<double>")
        out = out.withColumn("_ml", array_to_vector(piece))
        out = model.transform(out).withColumnRenamed("code", f"_code{part}").drop("_ml")
    names = [f"_code{part}" for part in range(len(models))]
    return out.withColumn("codes", F.array(*names)).drop(*names)


def code_search(
    queries: DataFrame, coded: DataFrame, models: Sequence, n_candidates: int, k: int, keys: Sequence[str]
) -> DataFrame:
    """Candidates by product codes, then exact scores for those candidates only."""
    keys = list(keys)
    books = np.stack([np.stack(m.clusterCenters()) for m in models])
    rough = top_k(queries, coded.select(*keys, "codes"), CodeScorer(books), n_candidates, keys)
    candidates = rough.select("query_id", *keys)
    exact = coded.select(*keys, F.col("embedding").alias("_row")).join(broadcast_if_small(candidates), keys)
    asked = queries.select("query_id", "embedding")
    scored = exact.join(asked, "query_id").withColumn("score", V.dot(F.col("embedding"), F.col("_row")))
    return ranked(scored.select("query_id", *keys, "score"), k, keys)


def recall_against(approximate: DataFrame, exact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of the exact hits that the approximate search found, over all queries."""
    on = ["query_id", *keys]
    found = approximate.select(*on).withColumn("_hit", F.lit(1))
    return exact.select(*on).join(found, on, "left").agg(
        F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_found")
    ).withColumn("recall", F.col("n_found") / F.col("n_exact"))


def _label_sums(vectors: DataFrame, label: str, column: str) -> DataFrame:
    """(label, _s, _q, _n): sum of the unit vectors, sum of their squared lengths, count; zero vectors take no part.

    One aggregate per label, combined before the shuffle: a row is never split into its components.
    """
    usable = vectors.where(V.norm(F.col(column)) > 0)
    unit = array_to_vector(V.normalised(F.col(column)))
    made = usable.select(label, unit.alias("_v")).groupBy(label).agg(Summarizer.metrics("sum", "normL2", "count").summary(F.col("_v")).alias("_m"))
    squares = F.aggregate(vector_to_array("_m.normL2"), F.lit(0.0), lambda acc, x: acc + x * x)
    return made.select(label, vector_to_array("_m.sum").alias("_s"), squares.alias("_q"), F.col("_m.count").alias("_n"))


def label_similarity(vectors: DataFrame, label: str = "label", column: str = "embedding") -> DataFrame:
    """Mean cosine of all unordered pairs, per pair of labels, in time linear in the rows.

    Means of pairs follow from sums of unit vectors: across labels (A.B)/(na nb),
    within one (|A|^2 - sum of |a|^2) / (n (n-1)). Only the summed vectors, one per
    label, meet each other; the result has a row for each pair of labels.
    """
    sums = through_table(_label_sums(vectors, label, column), "label-sums")
    a = sums.select(F.col(label).alias("label_a"), F.col("_s").alias("_sa"), F.col("_n").alias("_na"), F.col("_q").alias("_self"))
    b = sums.select(F.col(label).alias("label_b"), F.col("_s").alias("_sb"), F.col("_n").alias("_nb"))
    b = broadcast_if_small(b)
    same = F.col("label_a") == F.col("label_b")
    products = a.join(b, F.col("label_a") <= F.col("label_b")).withColumn("_dot", V.dot(F.col("_sa"), F.col("_sb")))
    pairs = F.when(same, F.col("_na") * (F.col("_na") - 1) / 2).otherwise(F.col("_na") * F.col("_nb"))
    total = F.when(same, (F.col("_dot") - F.col("_self")) / 2).otherwise(F.col("_dot"))
    return products.select(
        "label_a",
        "label_b",
        pairs.cast("bigint").alias("n_pairs"),
        (total / F.nullif(pairs.cast("double"), F.lit(0.0))).alias("mean_cosine"),
    )


def cluster_separation(vectors: DataFrame, label: str = "label", column: str = "embedding") -> DataFrame:
    """Mean cosine within labels minus mean cosine across labels, with a reading of the difference.

    Pairs within labels and pairs of all rows both follow from sums, so labels are
    never paired and their number does not matter.
    """
    sums = through_table(_label_sums(vectors, label, column), "label-sums")
    by_label = sums.select((V.dot(F.col("_s"), F.col("_s")) - F.col("_q")).alias("_t"), "_n")
    within = by_label.agg(
        (F.sum("_t") / 2).alias("_in"), F.sum(F.col("_n") * (F.col("_n") - 1) / 2).alias("_in_pairs")
    )
    whole = sums.agg(
        Summarizer.sum(array_to_vector("_s")).alias("_s"), F.sum("_q").alias("_q"), F.sum("_n").cast("double").alias("_n")
    ).select(vector_to_array("_s").alias("_s"), "_q", "_n")
    total = whole.select(
        ((V.dot(F.col("_s"), F.col("_s")) - F.col("_q")) / 2).alias("_all"), (F.col("_n") * (F.col("_n") - 1) / 2).alias("_all_pairs")
    )
    intra = F.col("_in") / F.nullif(F.col("_in_pairs"), F.lit(0.0))
    inter = (total.select("_all").scalar() - F.col("_in")) / F.nullif(
        total.select("_all_pairs").scalar() - F.col("_in_pairs"), F.lit(0.0)
    )
    means = within.select(intra.alias("intra"), inter.alias("inter"))
    gap = F.col("intra") - F.col("inter")
    band = F.when(gap > 0.35, "strong").when(gap > 0.20, "decent").when(gap < 0.10, "wrong model").otherwise("weak")
    return means.withColumn("separation", gap).withColumn("band", band)
