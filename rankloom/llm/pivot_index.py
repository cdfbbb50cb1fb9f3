"""Exact top-k by inner product on a pivot-distance index.

The largest inner product is turned into the smallest distance: a row x gets one more
component sqrt(M^2 - |x|^2), where M is the largest norm, and a query gets 0 there; then
|q' - x'|^2 = M^2 + |q|^2 - 2 q.x. Rows are keyed by their nearest pivot and the distance
to it, range-partitioned by that key, and cut into annuli (distance ranges of a pivot).

A query orders the annuli by the bound that the triangle inequality gives for their
scores. It first searches the best ones; its k-th score there stops the expansion: only
annuli whose bound reaches that score are searched after them. Distances are doubles,
so bounds are widened by a relative 1e-9; scores are exact integers. Blocks are searched
where they lie: queries come in passes of bounded bytes, and k rows per query leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import BestHits, as_rows, from_rows, passes, prepare, stored, vectors_of, wide
from rankloom.scale import spread, union_all

SCALE = 1024
#: Rows that pivots are chosen from (least id hashes), and pivots.
SAMPLE, PIVOTS = 512, 16
#: Rows of a block, annuli in all (about), and queries that are scored together.
BLOCK_ROWS, MOST_ANNULI, QUERY_ROWS = 1024, 4096, 1000
#: Rows of a range partition of the index.
PARTITION_ROWS = 65_536
#: Annuli that are searched before the others: at least so many, with at least k candidates.
FIRST_ANNULI = 2
#: Largest squared norm of a scaled vector; sums of products then fit into 64 bits.
MOST_NORM = float(1 << 62)


def scaled(rows: DataFrame) -> DataFrame:
    """(vec_id, v, norm2): floor(SCALE * x) of every component as doubles in bytes; unfit rows are left out.

    A vector whose products may not fit into 64 bits is an error, since it can be neither scored nor left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, matrix = vectors_of(batch.column(1))
            matrix = np.floor(SCALE * matrix)
            norms = (matrix * matrix).sum(axis=1)
            ids = batch.column(0).take(pa.array(good))
            if (norms >= MOST_NORM).any():
                raise ValueError(f"vector {ids[int(norms.argmax())]} is too long: its scores may pass 64 bits")
            yield pa.RecordBatch.from_arrays([ids, pa.array(as_rows(matrix, "<f8"), pa.binary()), pa.array(norms)], ["vec_id", "v", "norm2"])

    known = rows.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return known.mapInArrow(run, "vec_id long, v binary, norm2 double")


def lifted(matrix: np.ndarray, most: float) -> np.ndarray:
    """Rows with the component that makes all norms sqrt(most)."""
    rest = np.sqrt(np.maximum(most - (matrix * matrix).sum(axis=1), 0.0))
    return np.column_stack([matrix, rest])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], b.shape[1])
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * wide(a, width) @ wide(b, width).T, 0.0))


class Pivots:
    """Pivots spread over a sample: each is the farthest from those before it."""

    def __init__(self, sample: np.ndarray, most: float):
        self.most, self.width = most, sample.shape[1]
        points = lifted(sample, most)
        chosen = [0]
        nearest = distances(points, points[:1])[:, 0]
        while len(chosen) < PIVOTS and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(points, points[chosen[-1:]])[:, 0])
        self.points = points[chosen]

    def to(self, matrix: np.ndarray, query: bool = False) -> np.ndarray:
        """Distances of rows (or queries) to the pivots."""
        last = np.zeros((len(matrix), 1)) if query else lifted(matrix, self.most)[:, -1:]
        width = max(self.width, matrix.shape[1])
        pivots = np.column_stack([wide(self.points[:, :-1], width), self.points[:, -1:]])
        return distances(np.column_stack([wide(matrix, width), last]), pivots)


def build(vectors: DataFrame) -> tuple[DataFrame, Pivots] | None:
    """The stored index (annulus, pivot, low, high, n, ids, v), a row for each block, and its pivots."""
    spark = vectors.sparkSession
    n, most = vectors.agg(F.count("*"), F.max("norm2")).first()
    if not n:
        return None
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    pivots = Pivots(from_rows(sample.column(0).to_pylist(), "<f8"), most)
    shared = spark.sparkContext.broadcast(pivots)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = shared.value.to(from_rows(batch.column(1).to_pylist(), "<f8"))
                near = away.argmin(axis=1)
                columns = [*batch.columns[:2], pa.array(near, pa.int32()), pa.array(away[np.arange(len(near)), near])]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "pivot", "away"])

    rows_each = max(BLOCK_ROWS, -(-n // MOST_ANNULI))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, annulus, held, filled = TaskContext.get().partitionId(), 0, [], 0
        names = ["annulus", "pivot", "low", "high", "n", "ids", "v"]

        def block() -> pa.RecordBatch:
            ids, vs, pivot, away = zip(*held)
            body = from_rows(vs, "<f8").astype("<f8").tobytes()
            row = [[part << 32 | annulus], [pivot[0]], [min(away)], [max(away)], [len(ids)], [np.array(ids, "<i8").tobytes()], [body]]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                turned = bool(held) and row[2] != held[-1][2]
                if held and (turned or len(held) >= BLOCK_ROWS):
                    filled += len(held)
                    yield block()
                    if turned or filled >= rows_each:
                        annulus, filled = annulus + 1, 0
                    held = []
                held.append(row)
        if held:
            yield block()

    keyed = vectors.select("vec_id", "v").mapInArrow(key, "vec_id long, v binary, pivot int, away double")
    ranged = keyed.repartitionByRange(max(1, min(MOST_ANNULI, -(-n // PARTITION_ROWS))), "pivot", "away", "vec_id")
    ordered = ranged.sortWithinPartitions("pivot", "away", "vec_id")
    return stored(ordered.mapInArrow(cut, "annulus long, pivot int, low double, high double, n int, ids binary, v binary"), "annuli"), pivots


class Annuli:
    """All annuli's ranges; their number is bounded by MOST_ANNULI and the numbers of pivots and partitions."""

    def __init__(self, index: DataFrame):
        found = index.groupBy("annulus", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        got = found.toArrow().sort_by("annulus")
        self.ids, self.pivot, self.low, self.high, self.n = (got.column(c).to_numpy() for c in ("annulus", "pivot", "low", "high", "n"))

    def bounds(self, pivots: Pivots, queries: np.ndarray) -> np.ndarray:
        """(queries, annuli): no row of the annulus scores higher."""
        away = pivots.to(queries, query=True)[:, self.pivot]
        return highest(away, self.low, self.high, pivots.most + (queries * queries).sum(axis=1)[:, None])


def highest(away: np.ndarray, low: np.ndarray | float, high: np.ndarray | float, most: np.ndarray) -> np.ndarray:
    """What no row scores more than whose distance to a pivot is low..high; ``away`` are the queries' distances to it.

    ``most``: the squared norms of the lifted rows and the queries, added up.
    """
    slack = 1e-9 * (away + np.sqrt(most)) + 1e-6
    gap = np.maximum(np.maximum(away - high, low - away) - slack, 0.0)
    top = most - gap * gap
    return top / 2 + 1e-9 * np.abs(top) + 1.0


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    width = max(q.shape[1], v.shape[1])
    q, v = wide(q, width), wide(v, width)
    largest = np.sqrt((q * q).sum(axis=1).max(initial=0)) * np.sqrt((v * v).sum(axis=1).max(initial=0))
    if largest < float(1 << 52):
        return (q @ v.T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


def search(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner products, ties to smaller vec_id.

    ``rows`` and ``queries``: vec_id, embedding. A query's own id is no candidate. Vectors
    that are null, empty or hold null or non-finite numbers take no part, nor do null ids. A finite vector whose
    squared norm after scaling reaches MOST_NORM raises an error: its scores may not fit into 64 bits. Repeated rows count once. Fewer candidates
    than k are all returned; an empty side gives no rows. Shorter vectors count as filled up
    with zeros. Extra columns play no part.
    """
    spark = prepare(rows.sparkSession)
    built = build(stored(scaled(rows), "scaled-vectors"))
    schema = "query_id long, vec_id long, score long"
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index, pivots = built
    asked = stored(scaled(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    shared = spark.sparkContext.broadcast((pivots, Annuli(index)))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the annuli that a query searches first."""
        pivots, annuli = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            bounds = annuli.bounds(pivots, from_rows(batch.column(1).to_pylist(), "<f8"))
            order = np.argsort(-bounds, axis=1, kind="stable")
            before = np.cumsum(annuli.n[order], axis=1) - annuli.n[order]
            first = (before <= k) | (np.arange(len(annuli.ids)) < FIRST_ANNULI)
            ends = np.concatenate([[0], np.cumsum(first.sum(axis=1))])
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(annuli.ids[order[first]], pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], ["vec_id", "v", "first"])

    asked = stored(asked.mapInArrow(choose, "vec_id long, v binary, first array<long>"), "asked-annuli")
    blocks = spread(index.select("annulus", "pivot", "low", "high", "ids", "v"))

    def searched(wanted: Broadcast, later: bool) -> DataFrame:
        """Hits of a pass in the first annuli of its queries, or in those that the k-th score leaves."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, best = wanted.value.column(0).to_numpy(), None
            if not len(names):
                return
            for batch in batches:
                for row in zip(*batch.columns):
                    annulus, pivot, low, high = (c.as_py() for c in row[:4])
                    if best is None:
                        pivots, _ = shared.value
                        queries = from_rows(wanted.value.column(1).to_pylist(), "<f8")
                        best = BestHits(len(names), k, np.int64, by_id=False)
                        lists = wanted.value.column(2).combine_chunks()
                        first, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                        by = np.argsort(first, kind="stable")
                        first, owner = first[by], owner[by]
                        if later:
                            best.least[:] = wanted.value.column(3).to_numpy()
                            away, most = pivots.to(queries, query=True), pivots.most + (queries * queries).sum(axis=1)
                    mine = owner[slice(*np.searchsorted(first, [annulus, annulus + 1]))]
                    if later:
                        reach = highest(away[:, pivot], low, high, most) >= best.least
                        reach[mine] = False
                        mine = np.flatnonzero(reach)
                    ids = np.frombuffer(row[4].as_buffer(), np.int64)
                    v = np.frombuffer(row[5].as_buffer(), "<f8").reshape(len(ids), -1)
                    few = not later and len(ids) > k + 1 and len(np.unique(ids)) == len(ids)
                    for start in range(0, len(mine), QUERY_ROWS):
                        some = mine[start : start + QUERY_ROWS]
                        scores = _scores(queries[some], v)
                        least = best.least[some]
                        if few:  # the best k + 1 rows, own one included, and those that equal the last
                            least = np.maximum(least, np.partition(scores, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1])
                        at, column = np.nonzero((scores >= least[:, None]) & (ids != names[some][:, None]))
                        best.add(some[at], ids[column], scores[at, column])
            if best is not None:
                yield from best.batches(names)

        return blocks.mapInArrow(run, schema)

    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = stored(union_all([searched(wanted, False) for wanted in passes(asked)]), "first-annuli")
    ranked = first.distinct().withColumn("rank", F.row_number().over(place))
    reached = ranked.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    lowest = F.lit(-(1 << 63)).cast("long")
    going_on = stored(asked.join(reached, "vec_id", "left").select("vec_id", "v", "first", F.coalesce("least", lowest).alias("least")), "asked-further")
    rest = union_all([searched(wanted, True) for wanted in passes(going_on)])
    found = first.unionByName(rest).distinct().withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
