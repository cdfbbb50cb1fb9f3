import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.functions import vectors as V
from rankloom.operators import ann, encoding, evaluation, lexical, ranking, rerank, topk


def vector_frame(spark, matrix, key="vec_id", **extra):
    rows = [(i, [float(x) for x in v], *[c[i] for c in extra.values()]) for i, v in enumerate(matrix)]
    kinds = "".join(f", {name} {'string' if isinstance(c[0], str) else 'bigint'}" for name, c in extra.items())
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<float>{kinds}")


def unit(n, dim=8, seed=3):
    m = np.random.default_rng(seed).normal(size=(n, dim))
    return (m / np.linalg.norm(m, axis=1)[:, None]).astype(np.float32)


def brute(queries, rows, k, allowed=lambda q, r: True):
    out = []
    for q, v in enumerate(queries):
        scored = [
            (-round(float(np.dot(v.astype(float), w.astype(float))), 9), r) for r, w in enumerate(rows) if allowed(q, r)
        ]
        out += [(q, r, i + 1) for i, (_, r) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(hits):
    return sorted((r.query_id, r.vec_id, r["rank"]) for r in hits.collect())


def test_scan_and_grid_equal_brute_force_with_many_copies(spark, monkeypatch):
    rows = unit(60)
    rows[20:45] = rows[7]  # one text copied into more than a third of the rows
    asked = unit(9, seed=5)
    queries, corpus = vector_frame(spark, asked, "query_id"), vector_frame(spark, rows)
    want = brute(asked, rows, 6)
    assert found(topk.top_k(queries, corpus, topk.VectorScorer(), 6, ["vec_id"])) == want
    monkeypatch.setattr(topk, "QUERY_TILE", 2)
    monkeypatch.setattr(topk, "ROW_TILE", 8)
    tiled = topk.scan_candidates(queries, corpus.coalesce(1), topk.VectorScorer(), 6, ["vec_id"])
    assert found(ranking.ranked(tiled, 6, ["vec_id"])) == want
    assert tiled.count() < 9 * 60  # rows below the best so far stay in the task
    grid = topk.grid_candidates(queries, corpus, topk.VectorScorer(), 6, ["vec_id"], corpus_block=7, query_block=2)
    assert found(ranking.ranked(grid, 6, ["vec_id"])) == want


def test_search_within_cells_splits_a_hot_cell(spark):
    rows, asked = unit(50), unit(6, seed=9)
    cells = ["hot" if i % 5 else "cold" for i in range(50)]
    mine = ["hot", "cold", "hot", "hot", "none", "cold"]
    queries = vector_frame(spark, asked, "query_id", cell=mine)
    corpus = vector_frame(spark, rows, cell=cells)
    grid = topk.grid_candidates(queries, corpus, topk.VectorScorer(), 4, ["vec_id"], "cell", corpus_block=6, query_block=1)
    got = found(ranking.ranked(grid, 4, ["vec_id"]))
    assert got == brute(asked, rows, 4, lambda q, r: mine[q] == cells[r])
    assert found(topk.top_k(queries, corpus, topk.VectorScorer(), 4, ["vec_id"], cell="cell")) == got


def test_fewer_rows_than_k_and_ties_by_key(spark):
    two = np.array([[1, 0], [1, 0]], np.float32)
    hits = topk.top_k(vector_frame(spark, two[:1], "query_id"), vector_frame(spark, two), topk.VectorScorer(), 5, ["vec_id"])
    assert found(hits) == [(0, 0, 1), (0, 1, 2)]


def test_empty_sides(spark):
    queries, corpus = vector_frame(spark, unit(2), "query_id"), vector_frame(spark, unit(3))
    assert topk.top_k(queries.where("false"), corpus, topk.VectorScorer(), 2, ["vec_id"]).count() == 0
    assert topk.top_k(queries, corpus.where("false"), topk.VectorScorer(), 2, ["vec_id"]).count() == 0


# ------------------------------------------------------------------------------ BM25
def brute_bm25(queries, texts):
    docs = [[t.lower() for t in text.split()] for text in texts]
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    scores = {}
    for q, query in enumerate(queries):
        for i, d in enumerate(docs):
            tf = Counter(d)
            for t in query.lower().split():
                if t in tf:
                    part = idf[t] * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(d) / avgdl))
                    scores[q, i] = scores.get((q, i), 0.0) + part
    return scores


def text_frame(spark, texts, key, name):
    return spark.createDataFrame(list(enumerate(texts)), f"{key} bigint, {name} string")


@pytest.mark.parametrize("share", [1, 64, 10**9])
def test_bm25_equals_brute_force(spark, share, monkeypatch):
    monkeypatch.setattr(lexical.LexicalScorer, "dense_share", share)
    rng = random.Random(1)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    texts = [" ".join(rng.sample(words, rng.randint(1, 40))) for _ in range(60)] + ["w1 w1 w1"] * 30
    asked = [" ".join(rng.sample(words, 8)) for _ in range(12)] + ["w1 w1", "unknownterm"]
    corpus = lexical.with_terms(text_frame(spark, texts, "doc_id", "text"))
    weights = lexical.query_weights(text_frame(spark, asked, "query_id", "query"), lexical.term_weights(corpus))
    want = brute_bm25(asked, texts)
    for layout in (
        topk.scan_candidates(weights, corpus, lexical.LexicalScorer(), 1000, ["doc_id"]),
        topk.grid_candidates(weights, corpus, lexical.LexicalScorer(), 1000, ["doc_id"], corpus_block=13, query_block=40),
    ):
        got = {(r.query_id, r.doc_id): r.score for r in layout.collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_bm25_zero_weight_term_still_matches(spark):
    # the term is in exactly half of the rows: its idf is zero, the rows are hits all the same
    corpus = lexical.with_terms(text_frame(spark, ["a b", "a c", "d e", "f g"], "doc_id", "text"))
    hits = lexical.bm25(text_frame(spark, ["a"], "query_id", "query"), corpus, 10, ["doc_id"])
    assert [(r.doc_id, r.score) for r in hits.orderBy("rank").collect()] == [(0, 0.0), (1, 0.0)]


def test_repeated_query_term_doubles_the_score(spark):
    corpus = lexical.with_terms(text_frame(spark, ["x y", "z z", "q r", "s t"], "doc_id", "text"))
    hits = lexical.bm25(text_frame(spark, ["x", "x x"], "query_id", "query"), corpus, 5, ["doc_id"])
    scores = {r.query_id: r.score for r in hits.collect()}
    assert scores[1] == pytest.approx(2 * scores[0])


# --------------------------------------------------------------------------- encoding
def test_encoder_bodies_agree(spark):
    frame = text_frame(spark, ["Err-42 Café err", "", "ñ", "a b c a"], "doc_id", "text")
    a = {r.doc_id: r.embedding for r in encoding.embed(frame).collect()}
    b = {r.doc_id: r.embedding for r in encoding.hashed_embedding(frame).collect()}
    assert a == b
    assert sum(x * x for x in a[0]) == pytest.approx(1, abs=1e-6)
    assert not any(a[1]) and not any(a[2])


def test_embed_distinct_covers_all_copies(spark, monkeypatch):
    from rankloom import scale
    from rankloom.operators import chunking

    frame = spark.createDataFrame([(i, "same text" if i < 8 else f"text {i}") for i in range(12)], "doc_id bigint, text string")
    chunks = chunking.fixed_chunks(frame, 4, 0)
    monkeypatch.setattr(encoding, "skew_join", lambda a, b, on: scale.skew_join(a, b, on, hot_rows=3))
    got = {r.doc_id: r.embedding for r in encoding.embed_distinct(chunks).collect()}
    assert got == {r.doc_id: r.embedding for r in encoding.embed(chunks).collect()}


def test_only_new_texts_are_encoded(spark):
    from rankloom.operators import chunking

    frame = text_frame(spark, ["a", "b", "b"], "doc_id", "text")
    chunks = chunking.fixed_chunks(frame, 4, 0)
    first = encoding.not_yet_embedded(chunks, chunks.where("false"))
    assert first.count() == 2
    assert encoding.not_yet_embedded(chunks, first).count() == 0


def test_vector_functions(spark):
    row = (
        spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
        .select(
            V.dot(F.col("a"), F.col("b")).alias("dot"),
            V.cosine(F.col("a"), F.col("b")).alias("cos"),
            V.cosine(F.col("a"), F.col("z")).alias("none"),
            V.l2_distance(F.col("a"), F.col("b")).alias("l2"),
            V.normalised(F.col("a")).alias("unit"),
            V.normalised(F.col("z")).alias("zero"),
            V.shortened(F.col("a"), 1).alias("short"),
        )
        .first()
    )
    assert (row.dot, row.cos, row.none) == (24.0, 0.96, None)
    assert row.l2 == pytest.approx(math.sqrt(2))
    assert row.unit == pytest.approx([0.6, 0.8]) and row.zero == [0.0, 0.0] and row.short == [1.0]


# ----------------------------------------------------------------- fusion and collapse
def ranked_frame(spark, rows):
    return spark.createDataFrame(rows, "query_id bigint, doc_id string, rank bigint")


def test_reciprocal_rank_fusion(spark):
    fused = ranking.reciprocal_rank_fusion(
        {"vec": ranked_frame(spark, [(1, "a", 1), (1, "b", 2)]), "bm25": ranked_frame(spark, [(1, "b", 1), (1, "c", 2)])},
        10,
        ["doc_id"],
    )
    got = [(r.doc_id, r.score) for r in fused.orderBy("rank").collect()]
    assert got == [("b", 1 / 62 + 1 / 61), ("a", 1 / 61), ("c", 1 / 62)]


def test_documents_take_the_place_of_their_first_chunk(spark):
    docs = ranking.documents_of(ranked_frame(spark, [(1, "a", 1), (1, "a", 2), (1, "b", 3), (1, "c", 4)]), 2)
    assert sorted((r.doc_id, r["rank"]) for r in docs.collect()) == [("a", 1), ("b", 2)]


def scores(spark, retrieved, relevant):
    queries = spark.createDataFrame([(1,)], "query_id bigint")
    docs = spark.createDataFrame([(1, d, i + 1) for i, d in enumerate(retrieved)], "query_id bigint, doc_id string, rank bigint")
    lists = spark.createDataFrame([(1, relevant)], "query_id bigint, relevant_doc_ids array<string>")
    return evaluation.query_scores(queries, docs, evaluation.labels_from_lists(lists)).first()


def test_query_scores(spark):
    row = scores(spark, ["r1", "x", "y"], ["r1", "r2", "r3"])
    assert (row.recall_at_1, row.hit_at_1, row.rr) == (1 / 3, 1, 1.0)
    late = scores(spark, [f"x{i}" for i in range(10)] + ["r1"], ["r1"])
    assert (late.rr, late.recall_at_10) == (0.0, 0.0)
    assert scores(spark, ["d1"], ["d1", "d1"]).recall_at_1 == 1.0
    none = scores(spark, ["d1"], [])
    assert (none.n_relevant, none.recall_at_1, none.hit_at_3, none.rr) == (0, None, None, None)


def test_means_skip_unscored_queries(spark):
    frame = spark.createDataFrame(
        [(1, 1.0, 1), (2, None, None), (3, 0.0, 0)], "query_id bigint, rr double, hit_at_1 bigint"
    ).withColumn("recall_at_1", F.col("rr"))
    row = evaluation.macro_means(frame, cuts=(1,)).first()
    assert (row.n_queries, row.n_scored, row.mrr, row.hit_rate_at_1) == (3, 2, 0.5, 0.5)


def test_passage_labels_equal_brute_force(spark):
    texts = ["the cat sat on a mat today", "xcat sat on a matter", "a mat", "the cat sat"] + ["sat on sat on"] * 5
    asked = ["cat sat on a mat", "the cat sat", "sat on sat on", "not there at all", "mat", "cat sat", "at on"]
    docs, queries = text_frame(spark, texts, "doc_id", "text"), text_frame(spark, asked, "query_id", "query")
    want = sorted((q, d) for q, a in enumerate(asked) for d, t in enumerate(texts) if a in t)
    assert sorted(tuple(r) for r in evaluation.passage_labels(queries, docs).collect()) == want


def test_drift_alert_needs_a_drop_of_more_than_five_percent(spark):
    days = [(f"2024-01-{d:02d}", 0.8 if d in (12, 25) else 0.9) for d in range(1, 31)]
    daily = spark.createDataFrame(days, "day string, recall5 double").withColumn("day", F.to_date("day"))
    out = evaluation.drift_alerts(daily).orderBy("day").collect()
    assert out[0].baseline is None and out[0].alert is False
    assert [r.day.day for r in out if r.alert] == [12, 25]


def test_rerank_by_cover_and_by_model(spark):
    texts = lexical.with_terms(text_frame(spark, ["a b", "a", "c"], "doc_id", "text"))
    queries = text_frame(spark, ["a b"], "query_id", "query")
    candidates = spark.createDataFrame([(0, 2, 1, 0.9), (0, 1, 2, 0.8), (0, 0, 3, 0.7)], "query_id bigint, doc_id bigint, rank bigint, score double")
    best = rerank.by_token_cover(candidates, queries, texts, ["doc_id"], 2)
    assert [(r.doc_id, r.score) for r in best.orderBy("rank").collect()] == [(0, 1.0), (1, 0.5)]

    def make():
        return lambda query, text: text.str.len().astype(float)

    longest = rerank.by_model(candidates, queries, texts, ["doc_id"], 1, make)
    assert [r.doc_id for r in longest.collect()] == [0]


# ------------------------------------------------------------------------ approximate
def test_cell_search_recall_rises_to_one(spark):
    rows = unit(200, seed=11)
    corpus = vector_frame(spark, rows)
    queries = corpus.withColumnRenamed("vec_id", "query_id")
    exact = topk.top_k(queries, corpus, topk.VectorScorer(), 5, ["vec_id"])
    model = ann.train_cells(corpus, 6)
    celled = ann.assign_cells(corpus, model)
    recalls = [
        ann.recall_against(ann.cell_search(queries, celled, model, p, 5, ["vec_id"]), exact, ["vec_id"]).first().recall
        for p in (1, 3, 6)
    ]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_projection_and_code_search_find_the_row_itself(spark):
    rows = unit(120, seed=13)
    corpus = vector_frame(spark, rows)
    queries = corpus.withColumnRenamed("vec_id", "query_id")
    near = ann.projection_search(queries, corpus, 3, ["vec_id"])
    assert near.where("rank = 1 and query_id = vec_id").count() == 120
    models = ann.train_codes(corpus, 8, 2, codes=8)
    coded = ann.encode_codes(corpus, models)
    hits = ann.code_search(queries, coded, models, 120, 3, ["vec_id"])
    exact = topk.top_k(queries, corpus, topk.VectorScorer(), 3, ["vec_id"])
    assert found(hits.select("query_id", "vec_id", "rank")) == found(exact)


def test_separation_equals_pairs(spark):
    rows = unit(40, seed=17)
    labels = ["a" if i % 3 else "b" for i in range(40)]
    frame = vector_frame(spark, rows, label=labels)
    sims = {True: [], False: []}
    for i in range(40):
        for j in range(i + 1, 40):
            sims[labels[i] == labels[j]].append(float(rows[i].astype(float) @ rows[j].astype(float)))
    row = ann.cluster_separation(frame).first()
    assert row.intra == pytest.approx(np.mean(sims[True]), abs=1e-6)
    assert row.inter == pytest.approx(np.mean(sims[False]), abs=1e-6)


def test_short_passages_are_found_whatever_their_number(spark):
    texts = ["ab cde f", "xcdey", "", "f ab", "cde", "a b", "zab cdx"]
    asked = ["cde", "ab cd", "f", "b", "", "  ", "qq", "f ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    want = sorted((q, d) for q, a in enumerate(asked) for d, t in enumerate(texts) if a.strip() and a in t)
    assert sorted(tuple(r) for r in evaluation.passage_labels(queries, docs).collect()) == want
    many = spark.range(10_001).select(F.col("id").alias("query_id"), F.concat(F.lit("w"), "id").alias("query"))
    some = spark.createDataFrame([(1, "w10000 v")], "doc_id long, text string")
    assert evaluation.passage_labels(many, some).count() == 5  # w1, w10, w100, w1000, w10000


@pytest.mark.parametrize("most", [3, 500_000])
def test_rows_of_one_key_are_one_hit(spark, monkeypatch, most):
    """Copies of a row count their terms together, rows of other lengths add their scores; several passes find the same."""
    rows = [(1, "a b"), (1, "a b"), (1, "a c d"), (2, "a b"), (3, "b c c"), (None, "a"), (None, "a"), (4, None), (5, "e f")]
    corpus = lexical.with_terms(spark.createDataFrame(rows, "doc_id bigint, text string"))
    asked = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "f x"), (None, "a")], "query_id bigint, query string")
    weights = lexical.term_weights(corpus)
    monkeypatch.setattr(lexical, "SCAN_QUERY_ROWS", most)
    found = lexical.bm25_by_key(asked, corpus, 3, ["doc_id"], weights=weights)
    weight = {r.term: (r.idf, r.avgdl) for r in weights.collect()}
    counts = {}
    for doc, text in rows:
        for term in (text or "").split():
            at = (doc, len(text.split()), term)
            counts[at] = counts.get(at, 0) + 1
    want = {}
    for query, text in [(1, "a b"), (2, "c"), (3, "f")]:
        scores = {}
        for (doc, length, term), tf in counts.items():
            if term in text.split():
                idf, mean = weight[term]
                scores[doc] = scores.get(doc, 0) + idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean))
        best = sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0] is not None, x[0]))[:3]
        want |= {(query, at + 1): (doc, round(score, 9)) for at, (doc, score) in enumerate(best)}
    assert {(r.query_id, r["rank"]): (r.doc_id, round(r.score, 9)) for r in found.collect()} == want


def test_encoder_gets_texts_by_bytes(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(encoding, "ENCODE_BYTES", 10)
    texts = ["aaaa", None, "bbbb", "c" * 30, "dd", "ee", "ff", "gg", "hh", "ii"]
    parts = list(encoding._parts(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text", 4))
    assert [p.column("text").to_pylist() for p in parts] == [texts[:3], texts[3:4], texts[4:8], texts[8:]]


def test_vector_searches_ask_every_row(spark, tmp_path):
    from rankloom.plans import catalogue

    draw = np.random.default_rng(2).normal(size=(320, 8))
    rows = [(i, [float(x) for x in v / np.linalg.norm(v)], i % 3) for i, v in enumerate(draw)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = {n: catalogue.QUERIES[n](spark, str(tmp_path)).collect() for n in ("nearest_vectors", "nearest_vectors_in_blocks", "cell_search_all_cells", "cell_search")}
    assert all({r.query_id for r in hits} == set(range(320)) for hits in found.values())
    exact = {(r.query_id, r["rank"]): r.vec_id for r in found["nearest_vectors"]}
    assert exact == {(r.query_id, r["rank"]): r.vec_id for r in found["nearest_vectors_in_blocks"]}
    assert {(r.query_id, r["rank"]): r.vec_id for r in found["cell_search_all_cells"]} == {k: v for k, v in exact.items() if k[1] <= 5}


def test_positions_below_what_is_known_are_left_out():
    draw = np.random.default_rng(4)
    scores = draw.integers(0, 40, size=(30, 200)) / 40 + draw.choice([0, 4e-10], size=(30, 200))
    scores[:, 3], scores[2, 7] = np.nan, -np.inf
    least = np.round(np.sort(np.nan_to_num(scores, nan=-1, neginf=-1), axis=1)[:, -12], 9)
    q, r, best = topk.best_positions(scores, 5)
    some = best >= least[q]
    found = topk.best_positions(scores, 5, least)
    again = found[2] >= least[found[0]]
    assert [list(a[some]) for a in (q, r, best)] == [list(a[again]) for a in found]


def test_terms_of_rows_are_counted_once_for_all_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_TILE", 1)
    words = ["a", "b", "c", "d", "e"]
    docs = spark.createDataFrame([(i, [words[(i * j) % 5] for j in range(i % 7)]) for i in range(30)] + [(30, None)], "doc_id long, terms array<string>")
    claims = spark.createDataFrame([(q, f"{words[q % 5]} {words[q // 5]} x") for q in range(20)], "query_id long, query string")
    asked = lexical.query_weights(claims, lexical.term_weights(docs.where("doc_id < 30"))).toArrow()
    scorer, calls = lexical.LexicalScorer(), []
    rows = docs.toArrow()
    blocks = topk.query_blocks(scorer, asked)
    assert len(blocks) == 20
    whole = [scorer.scores(b.data, rows) for b in blocks]
    read = lexical.LexicalScorer.read
    monkeypatch.setattr(lexical.LexicalScorer, "read", lambda self, tile: calls.append(1) or read(self, tile))
    hits = [r for b in topk._hits(scorer, blocks, rows, ["doc_id"], 3) for r in b.to_pylist()]
    assert len(calls) == 1
    for block, scores in zip(blocks, whole):
        name = block.ids[0].as_py()
        want = sorted((-round(s, 9), i) for i, s in enumerate(scores[0]) if s == s)[:3]
        assert sorted((-round(h["score"], 9), h["doc_id"]) for h in hits if h["query_id"] == name) == want


def test_recall_queries_ask_every_row(spark, tmp_path):
    from rankloom.plans import catalogue

    draw = np.random.default_rng(2).normal(size=(320, 32))
    rows = [(i, [float(x) for x in v / np.linalg.norm(v)], i % 3) for i, v in enumerate(draw)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    judged = {n: catalogue.QUERIES[n](spark, str(tmp_path)).first() for n in ("cell_search_recall", "product_code_recall", "graph_search_recall", "projection_search_recall")}
    assert [row.n_exact for row in judged.values()] == [5 * 320, 5 * 320, 5 * 16, 5 * 16] and all(row.scores_exact for row in judged.values())
