"""Approximate vector search on indexes that are written once: cells, product codes, a neighbour graph.

Training sees a bounded sample (``TRAIN_ROWS``); every row is indexed. What is scored is chosen by the
index, scores themselves are always exact inner products on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from rankloom.functions import vectors as V
from rankloom.operators.ann import CodeScorer, assign_cells, train_cells
from rankloom.operators.ranking import by_score, ranked
from rankloom.operators.topk import VectorScorer, top_k
from rankloom.scale import broadcast_if_small, cut_lineage, through_table
from rankloom.sources.store import dealt_by, with_dense_id

TRAIN_ROWS = 100_000
#: Cells (folders) at most, and rows of a file.
MOST_CELLS, FILE_ROWS = 4096, 500_000


def training_sample(vectors: DataFrame, keys: Sequence[str], n: int, rows: int = TRAIN_ROWS) -> DataFrame:
    """About ``rows`` of the ``n`` vectors, the same on every run: those with the least hashes of their keys."""
    if n <= rows:
        return vectors
    return vectors.where(F.pmod(F.xxhash64(*keys), F.lit(1_000_000)) < math.ceil(1_000_000 * rows / n))


# ------------------------------------------------------------------------- cells
@dataclass
class CellIndex:
    """Rows in one folder per cell, and the cells' centres."""

    rows: DataFrame
    centres: DataFrame
    n_cells: int


def write_cells(vectors: DataFrame, keys: Sequence[str], path: str, n_cells: int | None = None) -> CellIndex:
    """Train cells on a sample and write every row to its cell's folder; a large cell gets several files.

    Without ``n_cells`` there are about as many cells as rows in a cell.
    """
    n = vectors.count()
    if n:
        n_cells = min(n_cells or round(math.sqrt(n)), MOST_CELLS, n)
        model = train_cells(training_sample(vectors, keys, n), n_cells)
        centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
        celled = assign_cells(vectors, model).withColumn("cell", F.col("cell").cast("int"))
    else:
        centres, celled = [], vectors.withColumn("cell", F.lit(0))
    dealt, _ = dealt_by(celled, ["cell"], FILE_ROWS, keys)
    dealt.write.partitionBy("cell").parquet(f"{path}/rows")
    spark = vectors.sparkSession
    spark.createDataFrame(centres, "cell int, embedding array<double>").write.parquet(f"{path}/centres")
    return open_cells(spark, path, celled.schema)


def open_cells(spark: SparkSession, path: str, schema) -> CellIndex:
    centres = spark.read.schema("cell int, embedding array<double>").parquet(f"{path}/centres")
    return CellIndex(spark.read.schema(schema).parquet(f"{path}/rows"), centres, centres.count())


def probed(queries: DataFrame, index: CellIndex, n_probe: int) -> tuple[DataFrame, DataFrame]:
    """(queries with the cells they look at, the rows of these cells): no other folder is read."""
    near = top_k(queries, index.centres, VectorScorer(metric="l2"), n_probe, ["cell"]).select("query_id", "cell")
    near = cut_lineage(near)
    cells = [r[0] for r in near.select("cell").distinct().collect()]  # at most MOST_CELLS
    return near.join(queries, "query_id"), index.rows.where(F.col("cell").isin(cells))


def search_cells(queries: DataFrame, index: CellIndex, n_probe: int, k: int, keys: Sequence[str]) -> DataFrame:
    """The k best rows among the ``n_probe`` nearest cells of each query; with all cells the result is exact."""
    probes, rows = probed(queries, index, n_probe)
    return top_k(probes, rows, VectorScorer(), k, keys, cell="cell")


# ----------------------------------------------------------------- product codes
def _lloyd(points: np.ndarray, codes: int, rounds: int) -> np.ndarray:
    """Centres of k-means that starts from points far from each other; the same for the same set of points."""
    points = points[np.lexsort(points.T[::-1])]
    centres = points[:1]
    away = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < codes:
        centres = np.vstack([centres, points[int(away.argmax())]])
        away = np.minimum(away, ((points - centres[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        near = ((points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)
        counts = np.bincount(near, minlength=codes)
        sums = np.stack([np.bincount(near, points[:, i], codes) for i in range(points.shape[1])], axis=1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def train_books(vectors: DataFrame, keys: Sequence[str], parts: int, codes: int = 16, rounds: int = 10) -> np.ndarray:
    """(parts, codes, length): centres for each slice of the vectors, all trained in one job on one sample."""
    n = vectors.count()
    sample = training_sample(vectors, keys, n)
    dim = F.size("embedding")
    slices = F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda p: F.struct(p.alias("part"), F.slice("embedding", (p * dim / parts).cast("int") + 1, (dim / parts).cast("int")).alias("x")),
    )

    def fit(key: tuple, rows: pa.Table) -> pa.Table:
        column = rows.column("x").combine_chunks()
        points = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "centres": [_lloyd(points, codes, rounds).ravel().tolist()]})

    found = sample.select(F.inline(slices)).groupBy("part").applyInArrow(fit, "part int, centres array<double>").collect()
    return np.stack([np.array(r.centres).reshape(codes, -1) for r in sorted(found, key=lambda r: r.part)])


def write_codes(vectors: DataFrame, books: np.ndarray, path: str) -> DataFrame:
    """Every row with its ``codes``, the number of the nearest centre of each slice, written once."""
    names = [*vectors.columns, "codes"]
    parts, codes, length = books.shape
    squares = (books**2).sum(axis=2)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            x = np.asarray(column.flatten(), np.float64).reshape(len(column), parts, length)
            near = (squares[None] - 2 * np.einsum("npl,pcl->npc", x, books)).argmin(axis=2).astype(np.int16)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * parts, pa.int32()), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names)

    schema = S.StructType([*vectors.schema.fields, S.StructField("codes", S.ArrayType(S.ShortType()))])
    vectors.mapInArrow(encode, schema).write.parquet(path)
    return vectors.sparkSession.read.schema(schema).parquet(path)


def search_codes(queries: DataFrame, coded: DataFrame, books: np.ndarray, n_candidates: int, k: int, keys: Sequence[str]) -> DataFrame:
    """Candidates by lookups in the code table, ranked again by exact scores. The scan of candidates reads codes only."""
    keys = list(keys)
    rough = top_k(queries, coded.select(*keys, "codes"), CodeScorer(books), n_candidates, keys).select("query_id", *keys)
    exact = coded.select(*keys, F.col("embedding").alias("_row")).join(broadcast_if_small(rough), keys)
    asked = queries.select("query_id", "embedding")
    scored = exact.join(asked, "query_id").withColumn("score", V.dot(F.col("embedding"), F.col("_row")))
    return ranked(scored.select("query_id", *keys, "score"), k, keys)


# ------------------------------------------------------------------------- graph
def _direction(dim: int, turn: int) -> Column:
    """A fixed direction of ones and minus ones, another one each turn."""
    signs = np.random.default_rng(1000 + turn).choice([-1.0, 1.0], dim)
    return F.array(*[F.lit(float(s)) for s in signs])


class Graph:
    """A graph of near neighbours: each row has at most ``degree`` of them, found without comparing all pairs.

    Rows start with those next to them on a few random projections. Then neighbours of a common row are
    compared with each other, since near rows have near neighbours, until a round changes little. Each pair is
    compared once at most. ``scored`` is the number of pairs compared. A search also follows the first, rather
    random links (``projections`` x ``beside`` each way), which lead from one cluster to another.
    """

    def __init__(self, vectors: DataFrame, key: str, degree: int = 8, projections: int = 4, beside: int = 1, rounds: int = 6, least_change: float = 0.02):
        self.key, self.degree = key, degree
        self.vectors = through_table(vectors.select(F.col(key).alias("id"), F.col("embedding").alias("x")), "graph-vectors")
        self.n = self.vectors.count()
        first = self.vectors.select(F.size("x")).first()
        self.dim = first[0] if first else 0
        self.scored = 0
        self.edges = self.links = None
        if self.n > 1:
            first = self._begun(projections, beside)
            self.edges = self._refined(first, rounds, least_change)
            near = self.edges.select("id", "other").unionByName(first.select(F.col("a").alias("id"), F.col("b").alias("other")))
            # followed both ways, so every row that has a link can be reached
            self.links = through_table(near.unionByName(near.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "graph-links")

    def _scores(self, pairs: DataFrame) -> DataFrame:
        """(a, b, score) of pairs (a, b)."""
        one = self.vectors.select(F.col("id").alias("a"), F.col("x").alias("_x"))
        other = self.vectors.select(F.col("id").alias("b"), F.col("x").alias("_y"))
        both = pairs.join(one, "a").join(other, "b")
        scored = cut_lineage(both.select("a", "b", V.dot(F.col("_x"), F.col("_y")).alias("score")))
        self.scored += scored.count()
        return scored

    def _begun(self, projections: int, beside: int) -> DataFrame:
        pairs = None
        for turn in range(projections):
            on = V.dot(F.col("x"), _direction(self.dim, turn))
            placed = with_dense_id(self.vectors.select("id", on.alias("on")), ["on", "id"], "place").select("id", "place")
            placed = cut_lineage(placed)
            places = F.transform(F.sequence(F.lit(1), F.lit(beside)), lambda step: F.col("place") + step)
            ahead = placed.select(F.col("id").alias("a"), F.explode(places).alias("place"))
            near = ahead.join(placed.withColumnRenamed("id", "b"), "place").select("a", "b")
            pairs = near if pairs is None else pairs.unionByName(near)
        return self._scores(self._ordered(pairs))

    @staticmethod
    def _ordered(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return ordered.where(F.col("a") != F.col("b")).distinct()

    def _nearest(self, edges: DataFrame) -> DataFrame:
        """The best ``degree`` edges of each row."""
        order = Window.partitionBy("id").orderBy(F.desc("score"), "other")
        return edges.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= self.degree).drop("_at")

    @staticmethod
    def _both_ways(scored: DataFrame, new: bool) -> DataFrame:
        there = scored.select(F.col("a").alias("id"), F.col("b").alias("other"), "score")
        back = scored.select(F.col("b").alias("id"), F.col("a").alias("other"), "score")
        return there.unionByName(back).withColumn("new", F.lit(new))

    def _refined(self, scored: DataFrame, rounds: int, least_change: float) -> DataFrame:
        seen = scored.select("a", "b")
        edges = cut_lineage(self._nearest(self._both_ways(scored, True)))
        for _ in range(rounds):
            # who has this row among its best is company too, up to the same number
            back = edges.select(F.col("other").alias("id"), F.col("id").alias("other"), "score", "new")
            company = self._nearest(edges.unionByName(back).groupBy("id", "other").agg(F.max("score").alias("score"), F.max("new").alias("new")))
            company = cut_lineage(company)
            left = company.select("id", F.col("other").alias("a"), F.col("new").alias("na"))
            right = company.select("id", F.col("other").alias("b"), F.col("new").alias("nb"))
            # at most degree x degree pairs around a row, and only those with a new side
            met = left.join(right, "id").where((F.col("a") < F.col("b")) & (F.col("na") | F.col("nb")))
            fresh = met.select("a", "b").distinct().join(seen, ["a", "b"], "left_anti")
            scored = self._scores(fresh)
            seen = cut_lineage(seen.unionByName(scored.select("a", "b")))
            better = self._nearest(edges.withColumn("new", F.lit(False)).unionByName(self._both_ways(scored, True)))
            edges = cut_lineage(better)
            if edges.where("new").count() <= least_change * self.n * self.degree:
                break
        return edges.select("id", "other", "score")

    def search(self, queries: DataFrame, k: int, width: int = 32, beam: int = 8, entries: int = 32, rounds: int = 20) -> DataFrame:
        """(query_id, key, score, rank) by best-first rounds for queries (query_id, embedding).

        A query starts at some fixed rows. Each round it opens the ``beam`` best rows that it has not opened, and
        scores their neighbours; it keeps the ``width`` best and stops when these are all open.
        """
        schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, {self.key} {self.vectors.schema['id'].dataType.simpleString()}"
        if self.n == 0:
            return queries.sparkSession.createDataFrame([], f"{schema}, score double, rank bigint")
        asked = broadcast_if_small(queries.select("query_id", F.col("embedding").alias("_q")))
        start = F.array(*[F.lit(r[0]) for r in self.vectors.orderBy(F.xxhash64("id"), "id").limit(entries).select("id").collect()])
        links = self.links if self.links is not None else self.vectors.select("id", F.col("id").alias("other"))

        def scored(wanted: DataFrame) -> DataFrame:
            joined = wanted.join(self.vectors, "id").join(asked, "query_id")
            out = cut_lineage(joined.select("query_id", "id", V.dot(F.col("x"), F.col("_q")).alias("score")))
            self.scored += out.count()
            return out

        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        seen = scored(asked.select("query_id", F.explode(start).alias("id"))).withColumn("open", F.lit(False))
        for _ in range(rounds):
            best = cut_lineage(seen.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= width).drop("_at"))
            closed = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
            turn = cut_lineage(best.where("not open").withColumn("_at", F.row_number().over(closed)).where(F.col("_at") <= beam).select("query_id", "id"))
            if turn.isEmpty():
                break
            found = turn.join(links, "id").select("query_id", F.col("other").alias("id")).distinct()
            fresh = scored(found.join(seen.select("query_id", "id"), ["query_id", "id"], "left_anti"))
            opened = seen.join(turn.withColumn("_turn", F.lit(True)), ["query_id", "id"], "left")
            opened = opened.select("query_id", "id", "score", (F.col("open") | F.col("_turn").isNotNull()).alias("open"))
            seen = cut_lineage(opened.unionByName(fresh.withColumn("open", F.lit(False))))
        hits = seen.select("query_id", F.col("id").alias(self.key), "score")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(*by_score([self.key]))).cast("bigint")
        return hits.withColumn("rank", place).where(F.col("rank") <= k)


# ----------------------------------------------------------------------- quality
def quality(found: DataFrame, exact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: hits of both searches, the share of exact hits found, and how many found scores differ from the exact ones.

    ``exact`` may go deeper than ``found``; its first ranks are what is to be found.
    """
    on = ["query_id", *keys]
    depth = found.agg(F.max("rank")).first()[0] or 0
    wanted = exact.where(F.col("rank") <= depth).select(*on, F.col("score").alias("_exact"))
    both = wanted.join(found.select(*on, "score"), on, "full_outer")
    return both.agg(
        F.count("_exact").alias("n_exact"),
        F.count("score").alias("n_found"),
        F.count(F.when(F.col("score").isNotNull() & F.col("_exact").isNotNull(), 1)).alias("n_right"),
        F.count(F.when(F.abs(F.col("score") - F.col("_exact")) > 1e-6, 1)).alias("n_wrong_scores"),
    )
