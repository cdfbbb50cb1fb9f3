"""Approximate nearest neighbours by cosine: a vantage-point tree per shard.

Vectors are scaled to length one, where nearness by cosine is nearness by distance.
A tree splits a shard at the median distance from a vantage point, down to small
leaves. A query goes down the near side first; the far side is left out if the
distance to the border, times ``factor``, exceeds the k-th distance found so far.
With factor 1 that is the triangle inequality, and the search is exact; a larger
factor leaves out more.

A shard is a run of rows of a task, so building moves nothing and no shard is large.
Every query meets every shard where the shard lies: queries come in passes of bounded
bytes, and what leaves a task is k rows per query, over all of its shards.
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

SHARD_ROWS, LEAF_ROWS, QUERY_ROWS = 4096, 64, 2000
#: How much the distance to a border counts for; 1 is exact.
FACTOR = 4.0
_PLACES, _STEPS, _FAR = 13, float(1 << 40), np.iinfo(np.int64).max


class Tree:
    """nodes: (vantage row, median distance, inside node, outside node) or, with vantage -1, a leaf's rows low..high."""

    def __init__(self, order: np.ndarray, nodes: np.ndarray, medians: np.ndarray):
        self.order, self.nodes, self.medians = order, nodes, medians

    @classmethod
    def build(cls, unit: np.ndarray) -> Tree:
        order, nodes, medians = np.arange(len(unit), dtype=np.int32), [], []

        def split(low: int, high: int) -> int:
            at = len(nodes)
            nodes.append((-1, low, high))
            medians.append(0.0)
            if high - low <= LEAF_ROWS:
                return at
            rows = order[low:high]
            vantage = rows[len(rows) // 2]
            away = lengths(unit[vantage : vantage + 1], unit[rows])[0]
            middle = (high - low) // 2
            by = np.argpartition(away, middle)
            order[low:high] = rows[by]
            median = float(away[by[middle]])
            if away.max() <= median and away.min() >= median:  # all equally far: no border to split at
                return at
            inside = split(low, low + middle)
            outside = split(low + middle, high)
            nodes[at], medians[at] = (vantage, inside, outside), median
            return at

        split(0, len(unit))
        return cls(order, np.array(nodes, np.int32), np.array(medians))

    def search(self, unit: np.ndarray, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, factor: float) -> np.ndarray:
        """The k nearest rows of each query, nearest first, ties to smaller ids; -1 where there are fewer.

        What is compared is one whole number for each row: its squared distance in steps of
        2^-40, then its id's place in the shard.
        """
        place = np.empty(len(ids), np.int64)
        place[np.lexsort((np.arange(len(ids)), ids))] = np.arange(len(ids))
        at_place = np.argsort(place)
        best = np.full((len(queries), k), _FAR)
        last = np.full(len(queries), _FAR)  # the largest of ``best``
        inner = np.flatnonzero(self.nodes[:, 0] >= 0)
        column = np.zeros(len(self.nodes), np.int64)
        column[inner] = np.arange(len(inner))
        borders = lengths(queries, unit[self.nodes[inner, 0]]) - self.medians[inner]

        def visit(at: int, some: np.ndarray) -> None:
            if not len(some):
                return
            vantage, left, right = self.nodes[at]
            if vantage < 0:
                inside = self.order[left:right]
                squared = np.maximum(2 - 2 * (queries[some] @ unit[inside].T), 0.0)
                # most queries have k nearer rows by now, and nothing of the leaf comes in
                near = (squared * _STEPS <= (last[some] >> _PLACES)[:, None] + 1.0).any(axis=1)
                some, squared = some[near], squared[near]
                if not len(some):
                    return
                away = np.rint(squared * _STEPS).astype(np.int64) << _PLACES | place[inside]
                away[own[some][:, None] == ids[inside][None]] = _FAR
                both = np.concatenate([best[some], away], axis=1)
                kept = np.partition(both, k - 1, axis=1)[:, :k]
                best[some], last[some] = kept, kept.max(axis=1)
                return
            border = borders[some, column[at]]
            near = border <= 0
            visit(left, some[near])
            visit(right, some[~near])
            kth = np.sqrt((last[some] >> _PLACES) / _STEPS)
            open_ = np.abs(border) * factor <= kth + 1e-6
            visit(right, some[near & open_])
            visit(left, some[~near & open_])

        visit(0, np.arange(len(queries)))
        best.sort(axis=1)
        return np.where(best == _FAR, -1, at_place[best & ((1 << _PLACES) - 1)] if len(ids) else -1)


def lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between rows of length one."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0.0))


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v): vectors as doubles in bytes; null, zero and non-finite ones and null ids are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, matrix = vectors_of(batch.column(1))
            some = (matrix != 0).any(axis=1) if len(matrix) else np.zeros(0, bool)
            ids = batch.column(0).take(pa.array(good[some]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(as_rows(matrix[some], "<f8"), pa.binary())], ["vec_id", "v"])

    known = rows.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return known.mapInArrow(run, "vec_id long, v binary")


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    largest = np.abs(matrix).max(axis=1, keepdims=True)
    matrix = matrix / largest
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def build(rows: DataFrame) -> DataFrame:
    """The stored index (part, run, one, ids, v, order, nodes, medians), a row for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, vs = TaskContext.get().partitionId(), 0, [], []
        names = ["part", "run", "one", "ids", "v", "order", "nodes", "medians"]

        def shard(ids: list, vs: list, number: int) -> pa.RecordBatch:
            ids, vs = zip(*dict.fromkeys(zip(ids, vs)))  # repeated rows once
            matrix = from_rows(vs, "<f8")
            tree = Tree.build(unit_rows(matrix))
            row = [[part], [number], [1], [np.array(ids, "<i8").tobytes()], [matrix.tobytes()], [tree.order.tobytes()], [tree.nodes.tobytes()], [tree.medians.tobytes()]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds)], names)

        for batch in batches:
            ids += batch.column(0).to_pylist()
            vs += batch.column(1).to_pylist()
            while len(ids) >= SHARD_ROWS:
                yield shard(ids[:SHARD_ROWS], vs[:SHARD_ROWS], number)
                ids, vs, number = ids[SHARD_ROWS:], vs[SHARD_ROWS:], number + 1
        if ids:
            yield shard(ids, vs, number)

    schema = "part int, run long, one long, ids binary, v binary, order binary, nodes binary, medians binary"
    return stored(usable(rows).mapInArrow(run, schema), "vantage-trees")


def search(rows: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows found nearest by cosine, ties to smaller vec_id.

    ``rows`` and ``queries``: vec_id, embedding. A query's own id is no candidate. Vectors
    that are null, empty, zero or hold null or non-finite numbers take no part, nor do null
    ids. Repeated rows count once. Fewer candidates than k are all returned; an empty side
    gives no rows. Shorter vectors count as filled up with zeros. Extra columns play no part.
    """
    prepare(rows.sparkSession)
    index = build(rows)
    asked = stored(usable(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    shards = spread(index.select("ids", "v", "order", "nodes", "medians"))

    def searched(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, best = shared.value.column(0).to_numpy(), None
            for batch in batches:
                for row in zip(*batch.columns):
                    if best is None:
                        queries = from_rows(shared.value.column(1).to_pylist(), "<f8")
                        best = BestHits(len(names), k, np.float64, by_id=True)
                    ids, v, order, nodes, medians = (c.as_buffer() for c in row)
                    ids = np.frombuffer(ids, "<i8")
                    v = np.frombuffer(v, "<f8").reshape(len(ids), -1)
                    tree = Tree(np.frombuffer(order, np.int32), np.frombuffer(nodes, np.int32).reshape(-1, 3), np.frombuffer(medians, np.float64))
                    width = max(queries.shape[1], v.shape[1])
                    v = wide(v, width)
                    unit, norms = unit_rows(v), np.sqrt((v * v).sum(axis=1))
                    for start in range(0, len(names), QUERY_ROWS):
                        q, own = wide(queries[start : start + QUERY_ROWS], width), names[start : start + QUERY_ROWS]
                        found = tree.search(unit, unit_rows(q), own, ids, 2 * k, factor)  # some more than k, for equal scores
                        at, column = np.nonzero(found >= 0)
                        row = found[at, column]
                        a = q[at]
                        score = (a * v[row]).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * norms[row])
                        best.add(at + start, ids[row], score)
            if best is not None:
                yield from best.batches(names)

        return shards.mapInArrow(run, "query_id long, vec_id long, score double")

    found = union_all([searched(shared) for shared in passes(asked)])
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
