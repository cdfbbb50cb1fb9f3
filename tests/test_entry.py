import re

import __spark_entry__ as entry
from rankloom.plans import catalogue


def test_queries_and_sql_belong_together():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    queries, sql = catalogue.QUERIES, catalogue.SQL
    assert set(queries) <= set(entry.queries()) and set(sql) <= set(queries)
    assert len(queries) >= 100
    assert set(queries) - set(sql) == {
        "cell_search", "graph_search", "projection_search", "product_code_search", "encoder_comparison", "stage_latency_p99_sketch",
    }
    assert not any(re.fullmatch(r"op\d+_.*|pipeline.*", name) for name in queries)


def test_entry_works_without_the_training_data_part(monkeypatch):
    def gone(name):
        raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(entry.importlib, "import_module", gone)
    assert set(entry.queries()) == set(catalogue.QUERIES)
    assert set(entry.oracle_sql()) == set(catalogue.SQL)


def test_flagship_runs(spark):
    rows = {r.ranker: r for r in entry.entry(spark).collect()}
    assert set(rows) == {"vec", "bm25", "hybrid"}
    assert all(r.n_queries == 40 and r.n_scored == 3 for r in rows.values())


def test_ranking_is_cut_before_the_shuffle(spark):
    from rankloom.plans import retrieval

    plan = retrieval.bm25_chunks(spark, "/root/testdata/sf0.001", 30)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "embedding" not in scan and "text" not in scan.split("Location")[0]


def test_topic_filter_reaches_the_scan(spark):
    from pyspark.sql import functions as F

    from rankloom.plans import tables

    index = tables.chunk_index(spark, "/root/testdata/sf0.001").where(F.col("topic") == "src3").select("doc_id")
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "(topic" in plan.split("PartitionFilters: [")[1].split("]")[0]  # only this topic's folder is read
