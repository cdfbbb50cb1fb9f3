"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import time

from rankloom.plans import catalogue, tables
from rankloom.session import local_session

HEADLINE = [
    "bm25_search",
    "bm25_scan_search",
    "bm25_chunk_search",
    "vector_chunk_search",
    "semantic_search",
    "topic_search",
    "hybrid_search",
    "hybrid_evaluation",
    "config_sweep_evaluation",
    "filtered_evaluation",
    "rerank_search",
    "grounding_check",
    "nearest_vectors",
    "cell_search",
    "cluster_separation",
    "fixed_chunks",
    "sentence_chunks",
    "chunk_size_sweep",
    "hashed_embedding",
    "incremental_embedding",
    "upsert_chunks",
    "apply_change_feed",
    "acl_search",
    "audit_reconciliation",
    "metadata_sidecar",
    "user_sessions",
    "running_totals",
    "stage_latency_p99",
    "clicks_near_purchases",
    "stream_tumbling",
    "stream_change_feed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spent: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        spent[name] = round(time.perf_counter() - start, 3)

    # start-up of the JVM and of the Python workers is not part of any query
    spark.range(1000).mapInArrow(lambda batches: batches, "id bigint").count()
    # tables the searches share are built first and timed on their own
    timed("build_chunk_index", lambda: tables.chunk_index(spark, sf_dir))
    timed("build_chunk_weights", lambda: tables.chunk_weights(spark, sf_dir))
    timed("build_document_index", lambda: tables.doc_index(spark, sf_dir))
    timed("build_document_weights", lambda: tables.doc_weights(spark, sf_dir))
    timed("build_document_postings", lambda: tables.doc_postings(spark, sf_dir))
    timed("build_relevance", lambda: tables.relevance(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda name=name: catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
