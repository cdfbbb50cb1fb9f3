import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators import lexical, postings


@pytest.fixture
def corpus(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    texts = [(i, " ".join(rng.sample(words, rng.randint(1, 30)))) for i in range(80)]
    texts += [(80 + i, "w1 w1 w2") for i in range(40)] + [(200, ""), (201, None)]
    return lexical.with_terms(spark.createDataFrame(texts, "doc_id bigint, text string"))


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query string")


def found(hits):
    return {(r.query_id, r["rank"]): (r.doc_id, round(r.score, 8)) for r in hits.collect()}


@pytest.mark.parametrize("named", [0, 1000])
def test_postings_give_the_rows_of_the_block_scorer(spark, corpus, tmp_path, monkeypatch, named):
    monkeypatch.setattr(postings, "NAMED_TERMS", named)
    asked = queries(spark, "w1 w1 w3", "w2 w7 w12 w40", "unknownterm", "", None)
    weights = lexical.term_weights(corpus)
    held = postings.store(postings.postings(corpus, ["doc_id"]), str(tmp_path / "held"))
    want = found(lexical.bm25(asked, corpus, 7, ["doc_id"]))
    assert want and found(postings.search(asked, held, weights, 7, ["doc_id"])) == want


def test_scan_is_pruned_and_stays_in_the_jvm(spark, corpus, tmp_path):
    held = postings.store(postings.postings(corpus, ["doc_id"]), str(tmp_path / "held"))
    few = postings.asked_for(held, spark.createDataFrame([("w1",), ("w2",)], "term string"))
    plan = few._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(term, [" in plan and "Python" not in plan
    assert few.select("term").distinct().count() == 2
    files = few.select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 2 < held.select(F.input_file_name().alias("f")).distinct().count()


def test_no_queries_and_no_rows(spark, corpus, tmp_path):
    weights = lexical.term_weights(corpus)
    held = postings.store(postings.postings(corpus, ["doc_id"]), str(tmp_path / "held"))
    assert postings.search(queries(spark, "w1").where("false"), held, weights, 5, ["doc_id"]).isEmpty()
    assert postings.search(queries(spark, "w1"), held.where(F.lit(False)), weights, 5, ["doc_id"]).isEmpty()


def long_corpus(spark):
    """Rows of very different lengths over a skewed vocabulary, some with several copies of a rare term."""
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(6000)]
    texts = [(i, i % 7, " ".join(rng.choices(words, k=rng.choice([3, 8, 40, 200])))) for i in range(600)]
    return lexical.with_terms(spark.createDataFrame(texts, "doc_id bigint, part int, text string"))


@pytest.mark.parametrize("block", [16, 512])
def test_bounds_leave_postings_out_and_lose_nothing(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(postings, "BLOCK_ROWS", block)
    corpus = long_corpus(spark)
    texts = [r.text for r in corpus.where("size(terms) between 30 and 60").limit(6).collect()]
    asked = queries(spark, *texts, "w2 w3 w5 w9 w17 w40 w80")
    weights = lexical.term_weights(corpus)
    held = postings.store(postings.postings(corpus, ["doc_id"]), str(tmp_path / "held"))
    for k in (3, 30):
        want = found(lexical.bm25(asked, corpus, k, ["doc_id"], weights=weights))
        assert found(postings.search(asked, held, weights, k, ["doc_id"])) == want
    terms = lexical.query_weights(asked, weights).select("query_id", "term", "weight")
    search = postings.Search(terms, held, 3, ["doc_id"])
    search.run().collect()
    df = held.groupBy("term").agg(F.sum("n").alias("df"))
    every = terms.join(df, "term").agg(F.sum("df")).first()[0]
    opened = sum(frame.count() for frame in search.opened)
    assert opened < (0.75 if block == 16 else 1) * every  # long blocks hold nearly every term, and bound less


def test_queries_that_few_rows_answer(spark, corpus, tmp_path):
    """Fewer hits than k, terms without weight, and a term that every row holds."""
    weights = lexical.term_weights(corpus).withColumn("idf", F.when(F.col("term") == "w2", 0.0).otherwise(F.col("idf")))
    held = postings.store(postings.postings(corpus, ["doc_id"]), str(tmp_path / "held"))
    asked = queries(spark, "w2", "w2 w1", "w99999", "w1 w2 w3 w4")
    want = found(lexical.bm25(asked, corpus, 500, ["doc_id"], weights=weights))
    assert found(postings.search(asked, held, weights, 500, ["doc_id"])) == want


def test_spaces_are_searched_apart(spark, tmp_path):
    corpus = long_corpus(spark).withColumn("config", F.concat(F.lit("c"), F.col("part").cast("string")))
    asked = queries(spark, "w1 w4 w9", "w2 w2 w30")
    held = postings.store(postings.postings(corpus, ["doc_id"], space="config"), str(tmp_path / "held"))
    weights = lexical.term_weights(corpus, ["config"])
    got = postings.search(asked, held, weights, 5, ["doc_id"], space="config")
    for name in ("c0", "c3"):
        one = corpus.where(F.col("config") == name)
        want = found(lexical.bm25(asked, one, 5, ["doc_id"]))
        assert want and found(got.where(F.col("config") == name)) == want


def test_blocks_are_scored_in_tasks_not_by_joins_of_pairs(spark, tmp_path):
    """No pair of a query and a row leaves a task unless it may be among the k best; rows with a repeated key are counted together."""
    corpus = long_corpus(spark)
    held = postings.store(postings.postings(corpus.unionByName(corpus.limit(5)), ["doc_id"]), str(tmp_path / "held"))
    asked = queries(spark, "w1 w2 w3", "w1 w5").select("query_id", F.explode(F.split("query", " ")).alias("term"), F.lit(1.0).alias("weight"))
    found = postings.by_blocks(asked, held, 2, ["doc_id"])
    assert found.count() < asked.join(held, "term").agg(F.sum("n")).first()[0] / 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Join") <= 1
