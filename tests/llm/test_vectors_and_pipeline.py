import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankloom.llm import common, pivot_index, toxicity, vantage

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, annulus string")


def odd_vectors():
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 6)) * rng.choice([0.1, 1, 30], (300, 1)))]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # equal vectors
    return rows + [rows[3], (2000, None), (2001, [1.0, None, 2.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, rows[0][1]), (2004, []), (2100, [0.0] * 6)]


def good(rows, zero):
    out = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = np.array(np.array(v, np.float32), float)
    return out


def test_pivot_search_is_exact(spark):
    rows = odd_vectors()
    df = frame(spark, rows)
    got = {}
    for r in pivot_index.search(df, df.where("vec_id % 10 = 0"), 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    held = {i: np.floor(1024 * v).astype(np.int64) for i, v in good(rows, True).items()}
    assert set(got) == {i for i in held if i % 10 == 0}
    for query, found in got.items():
        want = sorted((-int(held[query] @ v), i) for i, v in held.items() if i != query)[:10]
        assert sorted(found) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
    assert pivot_index.search(df.limit(0), df, 3).count() == 0 and pivot_index.search(df, df.limit(0), 3).count() == 0
    assert pivot_index.search(df.where("vec_id < 2"), df.where("vec_id = 0"), 5).count() == 1


@pytest.mark.parametrize("factor", [1.0, vantage.FACTOR])
def test_vantage_search_against_brute_force(spark, factor):
    rows = odd_vectors()
    df = frame(spark, rows)
    got = {}
    for r in vantage.search(df, df.where("vec_id % 10 = 0"), 5, factor).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    held = {i: v / np.linalg.norm(v) for i, v in good(rows, False).items()}
    assert set(got) == {i for i in held if i % 10 == 0}
    hits = total = 0
    for query, found in got.items():
        want = sorted((-round(float(held[query] @ v), 12), i) for i, v in held.items() if i != query)[:5]
        hits += len({i for _, i in want} & {i for _, i, _ in found})
        total += len(want)
        assert all(score == pytest.approx(held[query] @ held[i], abs=1e-12) for _, i, score in found)
    assert hits == total if factor == 1.0 else hits >= 0.9 * total
    assert vantage.search(df.limit(0), df, 3).count() == 0 and vantage.search(df, df.limit(0), 3).count() == 0


def test_pipeline_equals_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and kept.count() == len(ids)
    chain = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    chances = dict(zip(texts, chain.predict(list(texts.values()))[:, 1]))
    assert not ids & {i for i, p in chances.items() if p >= toxicity.THRESHOLD} and ids
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids
    assert pieces.groupBy("doc_id").agg((F.sum("length") == F.max("doc_tokens")).alias("whole")).where("not whole").count() == 0


def test_vectors_beyond_64_bits_are_an_error(spark):
    rows = spark.createDataFrame([(0, [1e10] * 4), (1, [1.0] * 4)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too long"):
        pivot_index.search(rows, rows, 2).collect()


@pytest.mark.parametrize("search", [pivot_index.search, vantage.search])
def test_queries_in_several_passes_find_the_same_and_are_not_copied_for_each_block(spark, monkeypatch, search):
    df = frame(spark, odd_vectors())
    asked = df.where("vec_id % 10 = 0")
    whole = sorted(tuple(r) for r in search(df, asked, 5).collect())
    monkeypatch.setattr(common, "PASS_BYTES", 800)
    monkeypatch.setattr(common, "POOL_ROWS", 20)
    monkeypatch.setattr(common, "HIT_ROWS", 7)
    found = search(df, asked, 5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") >= 2 and "Join" not in plan  # a pass each, and no query travels to a block
    assert sorted(tuple(r) for r in found.collect()) == whole


def test_best_hits_keep_ties_to_smaller_ids_and_count_equal_ones_once():
    draw = np.random.default_rng(5)
    query, ids, scores = (draw.integers(0, n, 3000) for n in (7, 60, 12))
    for by_id in (False, True):
        best = common.BestHits(7, 9, np.int64, by_id)
        for some in np.array_split(np.arange(3000), 40):
            best.add(query[some], ids[some], scores[some])
            best.cut()
        got = [tuple(r.values()) for b in best.batches(np.arange(7) * 100) for r in b.to_pylist()]
        want = []
        for q in range(7):
            hits = {(-s, i) for x, i, s in zip(query.tolist(), ids.tolist(), scores.tolist()) if x == q}
            if by_id:
                hits = {(min(s for s, other in hits if other == i), i) for _, i in hits}
            want += [(q * 100, i, -s) for s, i in sorted(hits)[:9]]
        assert got == want
