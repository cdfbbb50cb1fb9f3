"""Search and evaluation queries over ``documents`` with ``benchmark`` passages as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.functions import vectors as V
from rankloom.operators import chunking, encoding, evaluation, lexical, postings, ranking, rerank, topk
from rankloom.plans import duck as D
from rankloom.plans import tables
from rankloom.plans.registry import query
from rankloom.scale import broadcast_if_small, through_table, union_all

KEYS = ["doc_id", "chunk_index"]
CANDIDATES = 40  # chunks looked at before collapsing to documents (pure rankers)
FUSION_CANDIDATES = 30  # chunks per ranker before fusion
MAX_DOCS = 10
MEASURES = ["recall_at_1", "recall_at_3", "recall_at_10", "mrr"]

CHUNK_VECTORS = D.hashed("chunks", "doc_id, chunk_index", "text", "cv")


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def bm25_chunks(spark, sf_dir, k, size=32, overlap=8) -> DataFrame:
    index, weights = tables.chunk_index(spark, sf_dir, size, overlap), tables.chunk_weights(spark, sf_dir, size, overlap)
    return lexical.bm25_by_key(tables.eval_queries(spark, sf_dir), index.select(*KEYS, "terms"), k, KEYS, weights=weights)


def bm25_documents(spark, sf_dir, queries, k) -> DataFrame:
    index, weights = tables.doc_index(spark, sf_dir).select("doc_id", "terms"), tables.doc_weights(spark, sf_dir)
    return lexical.bm25_by_key(queries, index, k, ["doc_id"], weights=weights)


def vector_chunks(spark, sf_dir, k, size=32, overlap=8) -> DataFrame:
    index = tables.chunk_index(spark, sf_dir, size, overlap)
    return topk.top_k(tables.query_vectors(spark, sf_dir), index, topk.VectorScorer(), k, KEYS)


def fused_chunks(spark, sf_dir, size=32, overlap=8) -> DataFrame:
    rankings = {
        "vec": vector_chunks(spark, sf_dir, FUSION_CANDIDATES, size, overlap),
        "bm25": bm25_chunks(spark, sf_dir, FUSION_CANDIDATES, size, overlap),
    }
    return ranking.reciprocal_rank_fusion(rankings, FUSION_CANDIDATES, KEYS)


def doc_rankings(spark, sf_dir, size=32, overlap=8, rankers=("vec", "bm25", "hybrid")) -> DataFrame:
    """Document rankings of the rankers asked for; each ranker's chunks are computed once."""
    wanted = {
        "vec": lambda: vector_chunks(spark, sf_dir, FUSION_CANDIDATES, size, overlap),
        "bm25": lambda: bm25_chunks(spark, sf_dir, FUSION_CANDIDATES, size, overlap),
    }
    # a few rows per query, written once because fusion reads them again
    used = [n for n in wanted if n in rankers or "hybrid" in rankers]
    made = {n: through_table(wanted[n](), f"{n}-ranking") for n in used}
    if "hybrid" in rankers:
        made["hybrid"] = ranking.reciprocal_rank_fusion(
            {"vec": made["vec"], "bm25": made["bm25"]}, FUSION_CANDIDATES, KEYS
        )
    return ranking.merged(
        {n: ranking.documents_of(made[n].select("query_id", *KEYS, "rank"), MAX_DOCS) for n in rankers}
    )


def ranker_scores(spark, sf_dir, size=32, overlap=8, rankers=("vec", "bm25", "hybrid")) -> DataFrame:
    """Per ranker and query: recall, hit and reciprocal rank."""
    queries = tables.eval_queries(spark, sf_dir).select("query_id")
    asked = queries.withColumn("ranker", F.explode(F.array(*[F.lit(r) for r in rankers])))
    ranked = doc_rankings(spark, sf_dir, size, overlap, rankers)
    return evaluation.query_scores(asked, ranked, tables.relevance(spark, sf_dir), per=["ranker"])


def _hybrid_sql(size=32, overlap=8) -> list[str]:
    return [
        D.QUERIES,
        D.LABELS,
        D.chunks(size, overlap),
        CHUNK_VECTORS,
        D.QUERY_VECTORS,
        D.vector_rank("cv", "doc_id, chunk_index", 30, "vec"),
        D.bm25_rank("chunks", "doc_id, chunk_index", 30, "bm25"),
        D.fuse("vec", "bm25", "doc_id, chunk_index", 30, "hybrid"),
        D.collapse("vec", 10, "vec_docs"),
        D.collapse("bm25", 10, "bm25_docs"),
        D.collapse("hybrid", 10, "hybrid_docs"),
        D.scores("vec_docs", "vec_scores"),
        D.scores("bm25_docs", "bm25_scores"),
        D.scores("hybrid_docs", "hybrid_scores"),
        """all_scores AS (SELECT 'vec' AS ranker, * FROM vec_scores UNION ALL SELECT 'bm25', * FROM bm25_scores
           UNION ALL SELECT 'hybrid', * FROM hybrid_scores)""",
    ]


SCORE_COLUMNS = """query_id, n_relevant, round(recall_at_1, 6) AS recall_at_1, round(recall_at_3, 6) AS recall_at_3,
round(recall_at_10, 6) AS recall_at_10, hit_at_1, hit_at_3, hit_at_10, round(rr, 6) AS rr"""


def _round_scores(df: DataFrame) -> DataFrame:
    return _rounded(df, "recall_at_1", "recall_at_3", "recall_at_10", "rr")


def _round_means(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if c.startswith(("recall", "hit_rate")) or c == "mrr"]
    return _rounded(df, *names)


# ------------------------------------------------------------------ single rankers
@query(
    "bm25_search",
    D.with_(D.QUERIES, D.bm25_rank("documents", "doc_id", 10, "r"))
    + "SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r",
)
def bm25_search(spark, sf_dir):
    """Keyword search over whole documents."""
    hits = bm25_documents(spark, sf_dir, tables.eval_queries(spark, sf_dir), 10)
    return _rounded(hits, "score")


@query(
    "bm25_scan_search",
    D.with_(D.QUERIES, D.bm25_rank("documents", "doc_id", 10, "r"))
    + "SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r",
)
def bm25_scan_search(spark, sf_dir):
    """The same search by scoring every document in blocks: the form for query tables that ask for most of the vocabulary."""
    index, weights = tables.doc_index(spark, sf_dir), tables.doc_weights(spark, sf_dir)
    return _rounded(lexical.bm25(tables.eval_queries(spark, sf_dir), index, 10, ["doc_id"], weights=weights), "score")


@query(
    "bm25_postings_search",
    D.with_(D.QUERIES, D.bm25_rank("documents", "doc_id", 10, "r"))
    + "SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r",
)
def bm25_postings_search(spark, sf_dir):
    """The same search from stored postings, opened by hand: only the buckets of the queries' terms are read."""
    held, weights = tables.doc_postings(spark, sf_dir), tables.doc_weights(spark, sf_dir)
    return _rounded(postings.search(tables.eval_queries(spark, sf_dir), held, weights, 10, ["doc_id"]), "score")


@query(
    "bm25_chunk_search",
    D.with_(D.QUERIES, D.chunks(), D.bm25_rank("chunks", "doc_id, chunk_index", 30, "r"))
    + "SELECT query_id, doc_id, chunk_index, round(score, 6) AS score, rank FROM r",
)
def bm25_chunk_search(spark, sf_dir):
    hits = bm25_chunks(spark, sf_dir, FUSION_CANDIDATES)
    return _rounded(hits, "score").withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


@query(
    "vector_chunk_search",
    D.with_(
        D.QUERIES, D.chunks(), CHUNK_VECTORS, D.QUERY_VECTORS, D.vector_rank("cv", "doc_id, chunk_index", 30, "r")
    )
    + "SELECT query_id, doc_id, chunk_index, round(score, 6) AS score, rank FROM r",
)
def vector_chunk_search(spark, sf_dir):
    hits = vector_chunks(spark, sf_dir, FUSION_CANDIDATES)
    return _rounded(hits, "score").withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


@query(
    "semantic_search",
    D.with_(
        D.QUERIES, D.chunks(), CHUNK_VECTORS, D.QUERY_VECTORS, D.vector_rank("cv", "doc_id, chunk_index", 5, "r")
    )
    + """SELECT query_id, rank, round(score, 6) AS similarity, round(1 - score, 6) AS distance, r.doc_id, topic, chunk_id,
  CASE WHEN length(text) > 160 THEN substr(replace(text, chr(10), ' '), 1, 157) || '...'
       ELSE replace(text, chr(10), ' ') END AS preview,
  substr(text, 1, 120) || '...' AS short_preview
FROM r JOIN chunks USING (doc_id, chunk_index)""",
)
def semantic_search(spark, sf_dir):
    """Search hits with their texts: ranked on (key, vector) only, text joined after the cut."""
    index = tables.chunk_index(spark, sf_dir)
    hits = vector_chunks(spark, sf_dir, 5)
    details = index.select(*KEYS, "topic", "chunk_id", "text")
    joined = details.join(broadcast_if_small(hits), KEYS)
    distance = 1 - F.col("score")
    return joined.select(
        "query_id",
        "rank",
        F.round(V.similarity_from_distance(distance), 6).alias("similarity"),
        F.round(distance, 6).alias("distance"),
        "doc_id",
        "topic",
        "chunk_id",
        T.preview(F.col("text")).alias("preview"),
        T.short_preview(F.col("text")).alias("short_preview"),
    )


def _topic_sql(where: str) -> str:
    return (
        D.with_(
            D.QUERIES,
            D.chunks(),
            "wanted AS (SELECT * FROM chunks WHERE " + where + ")",
            D.hashed("wanted", "doc_id, chunk_index", "text", "cv"),
            D.QUERY_VECTORS,
            D.vector_rank("cv", "doc_id, chunk_index", 5, "r"),
        )
        + "SELECT query_id, doc_id, chunk_index, round(score, 6) AS score, rank FROM r"
    )


def _filtered_search(spark, sf_dir, condition) -> DataFrame:
    """Filter first, then rank: exact, and pushed to the scan of the index."""
    index = tables.chunk_index(spark, sf_dir).where(condition)
    hits = topk.top_k(tables.query_vectors(spark, sf_dir), index, topk.VectorScorer(), 5, KEYS)
    return _rounded(hits, "score").withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


@query("topic_search", _topic_sql("topic = 'src3'"))
def topic_search(spark, sf_dir):
    return _filtered_search(spark, sf_dir, F.col("topic") == "src3")


@query("multi_topic_search", _topic_sql("topic IN ('src1', 'src4', 'src7')"))
def multi_topic_search(spark, sf_dir):
    return _filtered_search(spark, sf_dir, F.col("topic").isin("src1", "src4", "src7"))


@query("absent_topic_search", _topic_sql("topic = 'no such topic'"))
def absent_topic_search(spark, sf_dir):
    """A topic the corpus lacks gives no rows."""
    return _filtered_search(spark, sf_dir, F.col("topic") == "no such topic")


@query(
    "answer_confidence",
    D.with_(D.QUERIES, D.chunks(), CHUNK_VECTORS, D.QUERY_VECTORS, D.vector_rank("cv", "doc_id, chunk_index", 5, "r"))
    + """SELECT query_id, round(max(score), 6) AS top_score, max(score) >= 0.85 AS answerable,
  CASE WHEN max(score) < 0.95 THEN 'limited context' ELSE 'ok' END AS confidence FROM r GROUP BY query_id""",
)
def answer_confidence(spark, sf_dir):
    """Refuse below one threshold, warn below another."""
    flags = evaluation.answerable(vector_chunks(spark, sf_dir, 5), 0.85)
    return flags.select(
        "query_id",
        F.round("top_score", 6).alias("top_score"),
        "answerable",
        F.when(F.col("top_score") < 0.95, "limited context").otherwise("ok").alias("confidence"),
    )


@query(
    "best_document",
    D.with_(D.QUERIES, D.bm25_rank("documents", "doc_id", None, "r"))
    + """SELECT query_id, doc_id, round(score, 6) AS score FROM r
ORDER BY round(score, 9) DESC, query_id, doc_id LIMIT 10""",
)
def best_document(spark, sf_dir):
    """The ten strongest matches over all queries: one ordered limit, no window."""
    hits = bm25_documents(spark, sf_dir, tables.eval_queries(spark, sf_dir), 10)
    best = ranking.single_query_top(hits, 10, ["query_id", "doc_id"])
    return _rounded(best.select("query_id", "doc_id", "score"), "score")


# ---------------------------------------------------------------- hybrid and evaluation
@query(
    "hybrid_search",
    D.with_(*_hybrid_sql()[2:8], D.collapse("hybrid", 10, "docs")).replace("WITH", f"WITH {D.QUERIES},", 1)
    + "SELECT query_id, doc_id, rank FROM docs",
)
def hybrid_search(spark, sf_dir):
    """Vector and keyword rankings fused by reciprocal rank, as documents."""
    return ranking.documents_of(fused_chunks(spark, sf_dir), MAX_DOCS)


@query(
    "fused_chunk_scores",
    D.with_(D.QUERIES, *_hybrid_sql()[2:8])
    + """SELECT query_id, doc_id, chunk_index, r1 AS vec_rank, r2 AS bm25_rank, round(score, 6) AS score, rank FROM hybrid""",
)
def fused_chunk_scores(spark, sf_dir):
    fused = fused_chunks(spark, sf_dir).withColumn("chunk_index", F.col("chunk_index").cast("bigint"))
    return _rounded(fused, "score")


@query("hybrid_evaluation", D.with_(*_hybrid_sql()) + D.means("all_scores", "ranker"))
def hybrid_evaluation(spark, sf_dir):
    """Flagship: recall, hit rate and MRR of vector, keyword and hybrid search."""
    return _round_means(evaluation.macro_means(ranker_scores(spark, sf_dir), per=["ranker"]))


@query("ranker_query_scores", D.with_(*_hybrid_sql()) + f"SELECT ranker, {SCORE_COLUMNS} FROM all_scores")
def ranker_query_scores(spark, sf_dir):
    return _round_scores(ranker_scores(spark, sf_dir))


@query(
    "ranker_comparison",
    D.with_(*_hybrid_sql())
    + """SELECT query_id,
  max(round(recall_at_3, 6)) FILTER (ranker = 'vec') AS vec_recall_at_3, max(round(rr, 6)) FILTER (ranker = 'vec') AS vec_rr,
  max(round(recall_at_3, 6)) FILTER (ranker = 'bm25') AS bm25_recall_at_3, max(round(rr, 6)) FILTER (ranker = 'bm25') AS bm25_rr,
  max(round(recall_at_3, 6)) FILTER (ranker = 'hybrid') AS hybrid_recall_at_3, max(round(rr, 6)) FILTER (ranker = 'hybrid') AS hybrid_rr
FROM all_scores GROUP BY query_id""",
)
def ranker_comparison(spark, sf_dir):
    scores = _round_scores(ranker_scores(spark, sf_dir))
    return ranking.side_by_side(scores, ["vec", "bm25", "hybrid"], ["recall_at_3", "rr"])


@query(
    "evaluation_delta",
    D.with_(*_hybrid_sql(), f"m AS ({D.means('all_scores', 'ranker')})")
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, a.{m} AS base, b.{m} AS other, round(b.{m} - a.{m}, 6) AS delta
FROM m a, m b WHERE a.ranker = 'vec' AND b.ranker = 'hybrid'"""
        for m in MEASURES
    ),
)
def evaluation_delta(spark, sf_dir):
    """What fusion adds to pure vector search."""
    means = _round_means(evaluation.macro_means(ranker_scores(spark, sf_dir), per=["ranker"]))
    return _rounded(evaluation.delta(means, "ranker", "vec", "hybrid", MEASURES), "delta")


def _config_sql(size: int, overlap: int) -> str:
    """One configuration as a derived table of its own."""
    return (
        "("
        + D.with_(*_hybrid_sql(size, overlap))
        + f"SELECT '{size}/{overlap}' AS config, * FROM ({D.means('all_scores', 'ranker')}))"
    )


@query(
    "config_sweep_evaluation",
    f"SELECT * FROM {_config_sql(32, 8)} UNION ALL SELECT * FROM {_config_sql(64, 16)}",
)
def config_sweep_evaluation(spark, sf_dir):
    """The whole evaluation under two chunking configurations, in one plan with the configuration as a key."""
    return _round_means(_config_means(spark, sf_dir))


def _config_words(spark, sf_dir, config: str) -> DataFrame:
    """The keyword ranking of the chunks of one configuration."""
    index = tables.config_index(spark, sf_dir).where(F.col("config") == config).select(*KEYS, "terms")
    weights = tables.config_weights(spark, sf_dir).where(F.col("config") == config)
    hits = lexical.bm25_by_key(tables.eval_queries(spark, sf_dir), index, FUSION_CANDIDATES, KEYS, weights=weights)
    return hits.withColumn("config", F.lit(config))


def _config_means(spark, sf_dir) -> DataFrame:
    """Means per configuration and ranker; index, vector search, fusion and group-by are one for all configurations."""
    index, queries = tables.config_index(spark, sf_dir), tables.eval_queries(spark, sf_dir)
    configs = F.array(*[F.lit(f"{size}/{overlap}") for size, overlap in tables.CONFIGS])
    named = F.concat_ws("|", "config", "query_id").alias("query_id")
    asked = tables.query_vectors(spark, sf_dir).withColumn("config", F.explode(configs)).select(named, "config", "embedding")
    by_vector = topk.top_k(asked, index, topk.VectorScorer(), FUSION_CANDIDATES, KEYS, cell="config")
    by_words = union_all([_config_words(spark, sf_dir, f"{size}/{overlap}") for size, overlap in tables.CONFIGS])
    made = {
        "vec": through_table(by_vector.select("query_id", *KEYS, "rank"), "vec-ranking"),
        "bm25": through_table(by_words.select(named, *KEYS, "rank"), "bm25-ranking"),
    }
    made["hybrid"] = ranking.reciprocal_rank_fusion(made, FUSION_CANDIDATES, KEYS).select("query_id", *KEYS, "rank")
    docs = ranking.documents_of(ranking.merged(made), MAX_DOCS, per=["ranker", "query_id"])
    apart = F.split("query_id", r"\|")
    kind = queries.schema["query_id"].dataType
    docs = docs.select("ranker", apart[0].alias("config"), apart[1].cast(kind).alias("query_id"), "doc_id", "rank")
    rankers = F.explode(F.array(*[F.lit(r) for r in made]))
    wanted = queries.select("query_id", F.explode(configs).alias("config")).withColumn("ranker", rankers)
    scores = evaluation.query_scores(wanted, docs, tables.relevance(spark, sf_dir), per=["config", "ranker"])
    return evaluation.macro_means(scores, per=["config", "ranker"])


def _config_delta_sql() -> str:
    sides = " UNION ALL ".join(f"SELECT * FROM {_config_sql(*c)}" for c in tables.CONFIGS)
    sizes = " UNION ALL ".join(
        f"SELECT '{s}/{o}' AS config, (SELECT count(*) FROM (" + D.with_(D.chunks(s, o)) + "SELECT doc_id FROM chunks)) AS n_chunks"
        for s, o in tables.CONFIGS
    )
    (bs, bo), (os_, oo) = tables.CONFIGS
    return f"WITH means AS ({sides}), sizes AS ({sizes}) " + " UNION ALL ".join(
        f"""SELECT a.ranker, '{m}' AS measure, a.{m} AS base, b.{m} AS other, round(b.{m} - a.{m}, 6) AS delta,
  x.n_chunks * 256 AS base_bytes, y.n_chunks * 256 AS other_bytes
FROM means a JOIN means b ON a.ranker = b.ranker AND a.config = '{bs}/{bo}' AND b.config = '{os_}/{oo}'
JOIN sizes x ON x.config = a.config JOIN sizes y ON y.config = b.config"""
        for m in MEASURES
    )


@query("config_delta", _config_delta_sql())
def config_delta(spark, sf_dir):
    """What a change of the chunk size does to each ranker's measures, with the bytes of both indexes' vectors."""
    means = _round_means(_config_means(spark, sf_dir))
    base, other = (f"{size}/{overlap}" for size, overlap in tables.CONFIGS)
    changes = evaluation.delta(means, "config", base, other, MEASURES, per=["ranker"])
    bytes_ = tables.config_index(spark, sf_dir).groupBy("config").agg((F.sum(F.size("embedding")) * 4).alias("bytes"))
    sizes = {n: bytes_.where(F.col("config") == c).select("bytes").scalar() for c, n in ((base, "base_bytes"), (other, "other_bytes"))}
    return _rounded(changes, "delta").withColumns(sizes)


CHUNK_EVAL = [
    D.QUERIES,
    D.LABELS,
    D.chunks(),
    D.bm25_rank("chunks", "doc_id, chunk_index", 40, "bm25"),
    D.collapse("bm25", 10, "docs"),
    D.scores("docs", "scored"),
]


@query("retrieval_evaluation", D.with_(*CHUNK_EVAL) + f"SELECT {SCORE_COLUMNS} FROM scored")
def retrieval_evaluation(spark, sf_dir):
    """One ranker scored per query: 40 chunks, at most 10 documents."""
    docs = ranking.documents_of(bm25_chunks(spark, sf_dir, CANDIDATES), MAX_DOCS)
    queries = tables.eval_queries(spark, sf_dir)
    return _round_scores(evaluation.query_scores(queries, docs, tables.relevance(spark, sf_dir)))


@query(
    "retrieval_summary",
    D.with_(*CHUNK_EVAL, f"m AS ({D.means('scored')})")
    + "SELECT *, CASE WHEN recall_at_3 > 0.75 THEN 'strong' WHEN recall_at_3 >= 0.5 THEN 'typical' ELSE 'investigate' END AS band FROM m",
)
def retrieval_summary(spark, sf_dir):
    """Macro means with the acceptance band of recall@3."""
    means = _round_means(evaluation.macro_means(retrieval_evaluation(spark, sf_dir)))
    recall = F.col("recall_at_3")
    band = F.when(recall > 0.75, "strong").when(recall >= 0.5, "typical").otherwise("investigate")
    return means.withColumn("band", band)


@query(
    "any_hit_evaluation",
    D.with_(*CHUNK_EVAL[:4], D.collapse("bm25", None, "docs"), D.scores("docs", "scored"))
    + f"SELECT {SCORE_COLUMNS} FROM scored WHERE n_relevant > 0",
)
def any_hit_evaluation(spark, sf_dir):
    """Scored queries only; all documents of the 40 chunks, reciprocal rank cut at 10."""
    labels = tables.relevance(spark, sf_dir)
    docs = ranking.documents_of(bm25_chunks(spark, sf_dir, CANDIDATES), None)
    queries = evaluation.scorable(tables.eval_queries(spark, sf_dir), labels)
    return _round_scores(evaluation.query_scores(queries, docs, labels))


@query(
    "ranked_doc_strings",
    D.with_(*CHUNK_EVAL)
    + "SELECT query_id, string_agg(doc_id, ' > ' ORDER BY rank) AS top_docs FROM docs WHERE rank <= 5 GROUP BY query_id",
)
def ranked_doc_strings(spark, sf_dir):
    docs = ranking.documents_of(bm25_chunks(spark, sf_dir, CANDIDATES), MAX_DOCS)
    return evaluation.top_docs(docs, 5)


@query(
    "off_topic_queries",
    D.with_(D.QUERIES, D.LABELS)
    + """SELECT query_id, CASE WHEN query_id IN (SELECT query_id FROM relevant) THEN 'scoring' ELSE 'off-topic' END AS class
FROM queries""",
)
def off_topic_queries(spark, sf_dir):
    queries, labels = tables.eval_queries(spark, sf_dir), tables.relevance(spark, sf_dir)
    scoring = evaluation.scorable(queries, labels).select("query_id", F.lit("scoring").alias("class"))
    rest = evaluation.off_topic(queries, labels).select("query_id", F.lit("off-topic").alias("class"))
    return scoring.unionByName(rest)


@query("passage_relevance", D.with_(D.LABELS) + "SELECT query_id, doc_id FROM relevant")
def passage_relevance(spark, sf_dir):
    return tables.relevance(spark, sf_dir)


@query(
    "relevance_membership",
    D.with_(*CHUNK_EVAL)
    + """SELECT query_id, doc_id, rank, (query_id, doc_id) IN (SELECT (query_id, doc_id) FROM relevant) AS is_relevant FROM docs""",
)
def relevance_membership(spark, sf_dir):
    """Each retrieved document marked as relevant or not."""
    docs = ranking.documents_of(bm25_chunks(spark, sf_dir, CANDIDATES), MAX_DOCS)
    labels = tables.relevance(spark, sf_dir).withColumn("_hit", F.lit(True))
    joined = docs.join(labels, ["query_id", "doc_id"], "left")
    return joined.select("query_id", "doc_id", "rank", F.coalesce("_hit", F.lit(False)).alias("is_relevant"))


@query(
    "filtered_evaluation",
    D.with_(
        D.QUERIES,
        D.LABELS,
        D.chunks(),
        CHUNK_VECTORS,
        D.QUERY_VECTORS,
        "qt AS (SELECT DISTINCT r.query_id, d.source AS topic FROM relevant r JOIN documents d USING (doc_id))",
        "ct AS (SELECT c.*, t.topic FROM cv c JOIN (SELECT doc_id, source AS topic FROM documents) t USING (doc_id))",
        "qvt AS (SELECT q.*, t.topic FROM qv q JOIN qt t USING (query_id))",
        """s AS (SELECT q.query_id, c.doc_id, c.chunk_index, sum(q.w * c.w) AS score FROM qvt q JOIN ct c USING (topic, b)
               GROUP BY ALL)""",
        """vec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id,
                 chunk_index) AS rank FROM s) WHERE rank <= 40)""",
        D.collapse("vec", 10, "docs"),
        D.scores("docs", "scored"),
    )
    + f"SELECT {SCORE_COLUMNS} FROM scored WHERE n_relevant > 0",
)
def filtered_evaluation(spark, sf_dir):
    """Each query searches the topics of its relevant documents only."""
    labels = tables.relevance(spark, sf_dir)
    topics = tables.documents(spark, sf_dir).select("doc_id", "topic").join(labels, "doc_id")
    asked = tables.query_vectors(spark, sf_dir).join(topics.select("query_id", "topic").distinct(), "query_id")
    index = tables.chunk_index(spark, sf_dir)
    hits = topk.top_k(asked, index, topk.VectorScorer(), CANDIDATES, KEYS, cell="topic")
    docs = ranking.documents_of(hits, MAX_DOCS)
    queries = evaluation.scorable(tables.eval_queries(spark, sf_dir), labels)
    return _round_scores(evaluation.query_scores(queries, docs, labels))


@query(
    "parent_documents",
    D.with_(D.QUERIES, D.chunks(), D.bm25_rank("chunks", "doc_id, chunk_index", 20, "r"), D.collapse("r", 3, "docs"))
    + """SELECT query_id, rank, doc_id, source AS topic, lang, length(text) AS n_chars, sha256(text)[1:16] AS content_id
FROM docs JOIN documents USING (doc_id)""",
)
def parent_documents(spark, sf_dir):
    """Chunk hits answered with their whole documents."""
    docs = ranking.documents_of(bm25_chunks(spark, sf_dir, 20), 3)
    parents = tables.documents(spark, sf_dir)
    return parents.join(broadcast_if_small(docs), "doc_id").select(
        "query_id",
        "rank",
        "doc_id",
        "topic",
        "lang",
        F.length("text").cast("bigint").alias("n_chars"),
        T.content_key(F.col("text")).alias("content_id"),
    )


RERANK_SQL = [
    D.QUERIES,
    D.chunks(),
    CHUNK_VECTORS,
    D.QUERY_VECTORS,
    D.vector_rank("cv", "doc_id, chunk_index", 20, "vec"),
    f"""cover AS (
  SELECT v.query_id, v.doc_id, v.chunk_index, v.rank AS first_rank,
         len(list_intersect(list_distinct({D.terms('q.query')}), {D.terms('c.text')})) / len(list_distinct({D.terms('q.query')})) AS score
  FROM vec v JOIN queries q USING (query_id) JOIN chunks c USING (doc_id, chunk_index))""",
]


@query(
    "rerank_search",
    D.with_(*RERANK_SQL)
    + """SELECT * FROM (SELECT query_id, doc_id, chunk_index, first_rank, round(score, 6) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, first_rank, doc_id, chunk_index) AS rank FROM cover)
WHERE rank <= 3""",
)
def rerank_search(spark, sf_dir):
    """Twenty vector candidates scored again by token cover, best three kept."""
    candidates = vector_chunks(spark, sf_dir, 20)
    texts = tables.chunk_index(spark, sf_dir).select(*KEYS, "terms")
    queries = tables.eval_queries(spark, sf_dir)
    hits = rerank.by_token_cover(candidates, queries, texts, KEYS, 3)
    return _rounded(hits, "score").withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


@query(
    "grounding_check",
    D.with_(
        "claims AS (SELECT conv_id, turn AS claim, text AS query FROM conversations WHERE role = 'assistant')",
        "queries AS (SELECT concat_ws('-', conv_id, claim) AS query_id, query FROM claims)",
        D.bm25_rank("documents", "doc_id", 3, "r"),
        f"""cover AS (SELECT r.query_id, max(len(list_intersect(list_distinct({D.terms('q.query')}), {D.terms('d.text')}))
                      / len(list_distinct({D.terms('q.query')}))) AS best
               FROM r JOIN queries q USING (query_id) JOIN documents d USING (doc_id) GROUP BY r.query_id)""",
    )
    + """SELECT query_id, round(coalesce(best, 0), 6) AS best_cover, coalesce(best, 0) >= 1 AS grounded
FROM queries LEFT JOIN cover USING (query_id)""",
)
def grounding_check(spark, sf_dir):
    """Every assistant turn as a claim: is it covered by one of the documents retrieved for it?"""
    claims = (
        tables.table(spark, sf_dir, "conversations")
        .where(F.col("role") == "assistant")
        .select(F.concat_ws("-", "conv_id", "turn").alias("query_id"), F.col("text").alias("query"))
    )
    index = tables.doc_index(spark, sf_dir)
    hits = bm25_documents(spark, sf_dir, claims, 3)
    checked = rerank.grounded(claims, hits, index.select("doc_id", "terms"), ["doc_id"])
    return _rounded(checked, "best_cover")


@query(
    "model_cut_over",
    D.with_(
        D.QUERIES,
        D.LABELS,
        D.hashed("documents", "doc_id", "text", "old"),
        D.hashed("documents", "doc_id", "text", "new", 256),
        D.hashed("queries", "query_id", "query", "q_old"),
        D.hashed("queries", "query_id", "query", "q_new", 256),
        D.vector_rank("old", "doc_id", 10, "r_old", "q_old"),
        D.vector_rank("new", "doc_id", 10, "r_new", "q_new"),
        D.scores("r_old", "s_old"),
        D.scores("r_new", "s_new"),
    )
    + """SELECT 'recall_at_3' AS measure, round(a, 6) AS old_value, round(b, 6) AS new_value, b >= a - 0.05 AS cut_over
FROM (SELECT avg(recall_at_3) AS a FROM s_old), (SELECT avg(recall_at_3) AS b FROM s_new)""",
)
def model_cut_over(spark, sf_dir):
    """Shadow evaluation of a wider encoder against the one in use."""
    docs = tables.documents(spark, sf_dir).select("doc_id", "text")
    queries, labels = tables.eval_queries(spark, sf_dir), tables.relevance(spark, sf_dir)
    runs = []
    for version, dim in (("old", 64), ("new", 256)):
        def encoder(dim=dim):
            return encoding.HashedEncoder(dim)

        asked = encoding.embed(queries, encoder, text="query")
        hits = topk.top_k(asked, encoding.embed(docs, encoder), topk.VectorScorer(), 10, ["doc_id"])
        scores = evaluation.query_scores(queries, hits, labels)
        runs.append(scores.withColumn("version", F.lit(version)))
    means = evaluation.macro_means(union_all(runs), per=["version"])
    gate = evaluation.cut_over_gate(means, "version", "old", "new", "recall_at_3", 0.05)
    return _rounded(gate, "old_value", "new_value")


@query("encoder_comparison")
def encoder_comparison(spark, sf_dir):
    """Another encoder under the same evaluation: weighted term counts against the default."""
    index = tables.doc_index(spark, sf_dir).select("doc_id", "terms", "embedding")
    queries = lexical.with_terms(tables.eval_queries(spark, sf_dir), "query")
    docs, model = index.drop("embedding"), encoding.tfidf_model(index.select("terms"), 256)
    sides = {
        "hashed": (encoding.embed(queries, text="query"), index),
        "tfidf": (encoding.embed_with_model(queries, model), encoding.embed_with_model(docs, model)),
    }
    labels, scored = tables.relevance(spark, sf_dir), []
    for name, (asked, corpus) in sides.items():
        hits = topk.top_k(asked, corpus, topk.VectorScorer(), 10, ["doc_id"])
        scored.append(evaluation.query_scores(queries, hits, labels).withColumn("encoder", F.lit(name)))
    return _round_means(evaluation.macro_means(union_all(scored), per=["encoder"]))


@query(
    "sampled_eval_queries",
    """SELECT * FROM (SELECT event_id, date_trunc('month', ts) AS month,
  row_number() OVER (PARTITION BY date_trunc('month', ts) ORDER BY sha256(CAST(event_id AS VARCHAR)), event_id) AS place
FROM events) WHERE place <= 20""",
)
def sampled_eval_queries(spark, sf_dir):
    """Twenty log entries per month for labelling, the same on every run."""
    picked = evaluation.sampled_queries(tables.events(spark, sf_dir), 20, "event_id", "ts")
    return picked.select("event_id", tables.plain_ts(F.col("month")).alias("month"), "place")


@query(
    "quality_drift",
    """WITH daily AS (SELECT CAST(ts AS DATE) AS day, 1 - avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END) AS recall5
  FROM events GROUP BY 1),
b AS (SELECT day, recall5, avg(recall5) OVER (ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS baseline
  FROM daily)
SELECT day, round(recall5, 6) AS recall5, round(baseline, 6) AS baseline, coalesce(recall5 < baseline * 0.95, false) AS alert FROM b""",
)
def quality_drift(spark, sf_dir):
    """A daily success share against the mean of the seven days before."""
    failed = F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)
    daily = tables.events(spark, sf_dir).groupBy(F.to_date("ts").alias("day")).agg((1 - F.avg(failed)).alias("recall5"))
    return _rounded(evaluation.drift_alerts(daily), "recall5", "baseline")
