"""Exact top-k of a query table against a corpus of any size.

The score of every (query, row) pair is computed in blocks inside a task. A task
keeps the k best scores of each query so far and lets only rows out that reach
them, so pairs are never shuffled. Two layouts, same result:

* ``scan``: the query side has been measured and is broadcast; the corpus is read
  in place, with no shuffle of it.
* ``grid``: query side of any size. Both sides are dealt into blocks of bounded
  size and each (query block, corpus block) is scored by its own task.

In both, ``cell`` restricts scoring to rows of the query's own cell (a topic, an
access group, an index cell). A hot cell is read where it lies (scan) or gets
more blocks (grid).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from rankloom.operators.ranking import ranked
from rankloom.scale import broadcast_if_small, cut_lineage, is_small

QUERY_TILE = 400
ROW_TILE = 10_000
CORPUS_BLOCK = 100_000
QUERY_BLOCK = 20_000
SCAN_QUERY_ROWS = 500_000
SCAN_QUERY_BYTES = 128 * 1024 * 1024


class Scorer(Protocol):
    """Block scoring; instances travel to the tasks, so they hold parameters only.

    A scorer may have ``read(rows)``: what it makes of rows once, for ``scores`` of all blocks of queries.
    """

    query_columns: Sequence[str]
    corpus_columns: Sequence[str]

    def prepare(self, queries: pa.Table) -> QueryBlock:
        """State for a block of queries, made once per task."""
        ...

    def scores(self, state, rows: pa.Table) -> np.ndarray:
        """(queries, rows) doubles; NaN where the row is no candidate."""
        ...


class QueryBlock:
    """Query ids of a block, the scorer's own state, and the best scores seen so far."""

    def __init__(self, ids: pa.Array, data):
        self.ids = ids
        self.data = data
        self.best: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.ids)

    def admit(self, q: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Which of the hits (at most k per query, best first) may still be among the k best.

        A hit below the k-th best score seen so far cannot be; an equal one can,
        as keys decide between equals.
        """
        if self.best is None:
            self.best = np.full((len(self), k), -np.inf)
        keep = score >= self.best.min(axis=1)[q]
        fresh = np.full((len(self), k), -np.inf)
        fresh[q, np.arange(len(q)) - np.searchsorted(q, np.arange(len(self)))[q]] = score
        self.best = np.partition(np.concatenate([self.best, fresh], axis=1), k, axis=1)[:, k:]
        return keep


def best_positions(scores: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, 9-place score) of the k best per query; equal scores keep row order.

    With ``least``, a finite 9-place score per query, lower scores may be left out.
    """
    if least is not None and np.isfinite(least).all():
        # rounding moves a score by half a unit of the ninth place; few are left to be rounded and ordered
        keep = scores >= (least - 1e-9 * (1 + np.abs(least)))[:, None]
        q, r = np.nonzero(keep)
        if len(q) <= keep.size // 8:
            score = np.round(scores[q, r], 9)
            order = np.lexsort((r, -score, q))
            q, r, score = q[order], r[order], score[order]
            some = np.arange(len(q)) - np.searchsorted(q, np.arange(len(scores)))[q] < k
            return q[some], r[some], score[some]
    rounded = np.round(scores, 9)
    rounded[np.isnan(rounded)] = -np.inf
    if rounded.shape[1] > k:
        kth = np.partition(rounded, rounded.shape[1] - k, axis=1)[:, rounded.shape[1] - k]
        keep = (rounded >= kth[:, None]) & (rounded > -np.inf)
    else:
        keep = rounded > -np.inf
    q, r = np.nonzero(keep)
    order = np.lexsort((r, -rounded[q, r], q))
    q, r = q[order], r[order]
    place = np.arange(len(q)) - np.searchsorted(q, np.arange(len(scores)))[q]
    q, r = q[place < k], r[place < k]
    return q, r, rounded[q, r]


def _flat(column) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def query_blocks(scorer: Scorer, queries: pa.Table, size: int | None = None) -> list[QueryBlock]:
    """The query table in blocks of ``size`` queries; a query may have several rows."""
    if queries.num_rows == 0:
        return []
    number = _flat(queries.column("query_id").combine_chunks().dictionary_encode()).indices.to_numpy(zero_copy_only=False)
    order = np.argsort(number, kind="stable")
    ordered = queries.take(pa.array(order))
    size = size or QUERY_TILE
    edges = np.searchsorted(number[order], np.arange(0, number.max() + 1 + size, size))
    return [scorer.prepare(ordered.slice(lo, hi - lo)) for lo, hi in zip(edges, edges[1:], strict=False) if hi > lo]


def _hits(
    scorer: Scorer, blocks: list[QueryBlock], rows: pa.Table, keys: list[str], k: int
) -> Iterator[pa.RecordBatch]:
    for start in range(0, rows.num_rows, ROW_TILE):
        tile = rows.slice(start, ROW_TILE).combine_chunks()
        tile = tile.take(pc.sort_indices(tile, [(key, "ascending") for key in keys]))
        seen = scorer.read(tile) if hasattr(scorer, "read") else tile
        for block in blocks:
            scores = scorer.scores(block.data, seen)
            q, r, rounded = best_positions(scores, k, None if block.best is None else block.best.min(axis=1))
            keep = block.admit(q, rounded, k)
            q, r = q[keep], r[keep]
            if len(q) == 0:
                continue
            columns = [block.ids.take(pa.array(q))]
            columns += [_flat(tile.column(key)).take(pa.array(r)) for key in keys]
            columns.append(pa.array(scores[q, r], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, ["query_id", *keys, "score"])


def _by_cell(rows: pa.Table) -> Iterator[tuple[object, pa.Table]]:
    """Rows of each cell; the order of rows within a cell does not matter."""
    cells = _flat(rows.column("_cell").combine_chunks()).dictionary_encode()
    number = cells.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(number, kind="stable")
    ordered = rows.take(pa.array(order))
    edges = np.searchsorted(number[order], np.arange(len(cells.dictionary) + 1))
    for i, cell in enumerate(cells.dictionary.to_pylist()):
        yield cell, ordered.slice(edges[i], edges[i + 1] - edges[i])


def _schema(queries: DataFrame, corpus: DataFrame, keys: Sequence[str]) -> S.StructType:
    fields = [S.StructField("query_id", queries.schema["query_id"].dataType)]
    fields += [S.StructField(key, corpus.schema[key].dataType) for key in keys]
    return S.StructType([*fields, S.StructField("score", S.DoubleType())])


def scan_candidates(
    queries: DataFrame, corpus: DataFrame, scorer: Scorer, k: int, keys: Sequence[str], cell: str | None = None
) -> DataFrame:
    """Local candidates with the measured, bounded query side broadcast to every task."""
    keys = list(keys)
    asked_cell = [F.col(cell).alias("_cell")] if cell else []
    table = queries.select("query_id", *scorer.query_columns, *asked_cell).toArrow()
    shared = corpus.sparkSession.sparkContext.broadcast(table)
    schema = _schema(queries, corpus, keys)

    def hits(batches):
        blocks = query_blocks(scorer, shared.value)
        for batch in batches:
            yield from _hits(scorer, blocks, pa.Table.from_batches([batch]), keys, k)

    def hits_in_cells(batches):
        asked = dict(_by_cell(shared.value))
        blocks = {}
        for batch in batches:
            for name, rows in _by_cell(pa.Table.from_batches([batch])):
                if name in asked:
                    if name not in blocks:
                        blocks[name] = query_blocks(scorer, asked[name])
                    yield from _hits(scorer, blocks[name], rows, keys, k)

    if cell is None:
        return corpus.select(*keys, *scorer.corpus_columns).mapInArrow(hits, schema)
    wanted = F.broadcast(queries.select(F.col(cell).alias("_cell")).distinct())
    visible = corpus.select(*keys, *scorer.corpus_columns, F.col(cell).alias("_cell"))
    return visible.join(wanted, "_cell", "left_semi").mapInArrow(hits_in_cells, schema)


def grid_candidates(
    queries: DataFrame,
    corpus: DataFrame,
    scorer: Scorer,
    k: int,
    keys: Sequence[str],
    cell: str | None = None,
    corpus_block: int = CORPUS_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Local candidates from blocks of bounded size on both sides."""
    keys = list(keys)
    q = queries.select("query_id", *scorer.query_columns, (F.col(cell) if cell else F.lit(0)).alias("_cell"))
    # fresh column ids, so a table may be searched with its own rows
    fields = [F.col(name).alias(name) for name in [*keys, *scorer.corpus_columns]]
    c = corpus.select(*fields, (F.col(cell) if cell else F.lit(0)).alias("_cell"))

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    counts = blocks(q, query_block, "_qn").join(blocks(c, corpus_block, "_cn"), "_cell")
    counts = broadcast_if_small(counts)
    q = (
        q.join(counts, "_cell")
        .withColumn("_qb", F.pmod(F.xxhash64("query_id"), "_qn"))
        .withColumn("_cb", F.explode(F.transform(F.sequence(F.lit(0), F.col("_cn") - 1), lambda b: b.cast("bigint"))))
        .drop("_qn", "_cn")
    )
    c = (
        c.join(counts, "_cell")
        .withColumn("_cb", F.pmod(F.xxhash64(*keys), "_cn"))
        .withColumn("_qb", F.explode(F.transform(F.sequence(F.lit(0), F.col("_qn") - 1), lambda b: b.cast("bigint"))))
        .drop("_qn", "_cn")
    )
    schema = _schema(queries, corpus, keys)
    names = [f.name for f in schema.fields]

    def hits(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(_hits(scorer, query_blocks(scorer, left), right, keys, k))
        if found:
            return pa.Table.from_batches(found)
        types = [left.schema.field("query_id").type, *[right.schema.field(key).type for key in keys], pa.float64()]
        return pa.table([pa.array([], t) for t in types], names=names)

    on = ["_cell", "_qb", "_cb"]
    return q.groupBy(*on).cogroup(c.groupBy(*on)).applyInArrow(hits, schema)


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    scorer: Scorer,
    k: int,
    keys: Sequence[str],
    cell: str | None = None,
) -> DataFrame:
    """(query_id, *keys, score, rank), rank 1..k by score then key.

    A row may sit in several cells of one query (shared groups, hash tables);
    it is ranked once.
    """
    keys = list(keys)
    columns = ["query_id", *scorer.query_columns, *([cell] if cell else [])]
    queries = cut_lineage(queries.select(*columns))
    layout = scan_candidates if is_small(queries, SCAN_QUERY_ROWS, SCAN_QUERY_BYTES) else grid_candidates
    found = layout(queries, corpus, scorer, k, keys, cell)
    if cell is not None:
        found = found.groupBy("query_id", *keys).agg(F.max("score").alias("score"))
    return ranked(found, k, keys)


class VectorScorer:
    """Inner products in double; equals cosine on unit vectors."""

    def __init__(self, column: str = "embedding", metric: str = "dot"):
        if metric not in ("dot", "cosine", "l2"):
            raise ValueError(f"unknown metric {metric}")
        self.query_columns = [column]
        self.corpus_columns = [column]
        self.column = column
        self.metric = metric

    def _matrix(self, column) -> np.ndarray:
        array = _flat(column)
        matrix = np.asarray(array.flatten(), dtype=np.float64).reshape(len(array), -1)
        if self.metric == "cosine":
            with np.errstate(invalid="ignore", divide="ignore"):
                matrix = matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]
        return matrix

    def prepare(self, queries: pa.Table) -> QueryBlock:
        return QueryBlock(_flat(queries.column("query_id")), self._matrix(queries.column(self.column)))

    def scores(self, state: np.ndarray, rows: pa.Table) -> np.ndarray:
        other = self._matrix(rows.column(self.column))
        products = state @ other.T
        if self.metric != "l2":
            return products
        squares = (state * state).sum(axis=1)[:, None] + (other * other).sum(axis=1)[None, :]
        return -np.sqrt(np.maximum(squares - 2 * products, 0.0))
