"""Stored vector indexes against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import stored_ann, topk


@pytest.fixture(scope="module")
def vectors(spark):
    """400 unit vectors around 20 centres, one of them three times under other keys."""
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 16))
    rows = [centres[i % 20] + 0.35 * draw.normal(size=16) for i in range(400)] + [centres[0]] * 3
    unit = [(i, [float(x) for x in v / np.linalg.norm(v)]) for i, v in enumerate(rows)]
    return spark.createDataFrame(unit, "vec_id bigint, embedding array<float>").cache()


def asked(vectors):
    return vectors.where("vec_id % 9 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def exact(vectors, k):
    return topk.top_k(asked(vectors), vectors, topk.VectorScorer(), k, ["vec_id"])


def test_cells_are_exact_when_all_are_probed_and_read_only_probed_folders(spark, vectors, tmp_path):
    index = stored_ann.write_cells(vectors, ["vec_id"], str(tmp_path / "cells"))
    assert index.n_cells == 20 and index.rows.count() == 403
    found = stored_ann.search_cells(asked(vectors), index, index.n_cells, 5, ["vec_id"])
    want = {(r.query_id, r["rank"]): r.vec_id for r in exact(vectors, 5).collect()}
    assert {(r.query_id, r["rank"]): r.vec_id for r in found.collect()} == want
    one = asked(vectors).where("query_id = 9")
    _, rows = stored_ann.probed(one, index, 3)
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows.select("cell").distinct().count() == 3
    near = stored_ann.quality(stored_ann.search_cells(asked(vectors), index, 5, 5, ["vec_id"]), exact(vectors, 5), ["vec_id"]).first()
    assert near.n_right >= 0.9 * near.n_exact and near.n_wrong_scores == 0


def test_codes_find_most_and_score_exactly(vectors, tmp_path):
    books = stored_ann.train_books(vectors, ["vec_id"], parts=4)
    assert books.shape == (4, 16, 4)
    coded = stored_ann.write_codes(vectors, books, str(tmp_path / "codes"))
    found = stored_ann.search_codes(asked(vectors), coded, books, 40, 5, ["vec_id"])
    near = stored_ann.quality(found, exact(vectors, 5), ["vec_id"]).first()
    assert near.n_right >= 0.9 * near.n_exact and near.n_wrong_scores == 0


def test_graph_finds_most_with_few_comparisons(vectors):
    graph = stored_ann.Graph(vectors, "vec_id")
    assert graph.edges.groupBy("id").count().agg(F.max("count")).first()[0] <= graph.degree
    found = graph.search(asked(vectors), 5)
    near = stored_ann.quality(found, exact(vectors, 5), ["vec_id"]).first()
    assert near.n_right >= 0.9 * near.n_exact and near.n_wrong_scores == 0
    assert graph.scored < 0.3 * graph.n * graph.n


def test_empty_tables(spark, vectors, tmp_path):
    none = vectors.limit(0)
    index = stored_ann.write_cells(none, ["vec_id"], str(tmp_path / "none"))
    assert stored_ann.search_cells(asked(vectors), index, 3, 5, ["vec_id"]).collect() == []
    assert stored_ann.Graph(none, "vec_id").search(asked(vectors), 5).collect() == []
