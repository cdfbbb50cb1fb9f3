"""Ingest, storage, contract, lifecycle and access-control queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.operators import access, chunking, encoding, lifecycle, ranking, topk
from rankloom.plans import duck as D
from rankloom.plans import tables
from rankloom.plans.registry import query
from rankloom.scale import scratch_path, through_table
from rankloom.sources import jsonl, store, versioned

SIZE, OVERLAP = tables.CHUNK
STRATEGY = chunking.strategy_id("v1", "fixed", SIZE, OVERLAP, "hashed-64")


def _docs(spark, sf_dir) -> DataFrame:
    return tables.documents(spark, sf_dir).select("doc_id", "topic", "text")


def _chunks(spark, sf_dir) -> DataFrame:
    return chunking.fixed_chunks(_docs(spark, sf_dir), SIZE, OVERLAP, strategy=STRATEGY)


def _big(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# ------------------------------------------------------------------------ sources
@query(
    "corpus_jsonl_scan",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN lang = 'en' THEN 'unknown' ELSE source END AS topic,
  sha256(text)[1:16] AS content_id FROM documents""",
)
def corpus_jsonl_scan(spark, sf_dir):
    """Documents as JSON Lines, English ones without a topic, read back with the schema."""
    path = scratch_path(spark, "corpus-jsonl")
    topic = F.when(F.col("lang") != "en", F.col("topic"))
    jsonl.write_jsonl(tables.documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_id"), topic.alias("topic"), "text"), path)
    return jsonl.read_corpus(spark, path).select("doc_id", "topic", T.content_key(F.col("text")).alias("content_id"))


@query(
    "chunk_jsonl_scan",
    D.with_(D.chunks())
    + "SELECT chunk_id, CAST(doc_id AS VARCHAR) AS doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, topic, n_tokens_ws FROM chunks",
)
def chunk_jsonl_scan(spark, sf_dir):
    """Chunks written as JSON Lines and loaded again."""
    path = scratch_path(spark, "chunks-jsonl")
    chunks = _chunks(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("string"))
    jsonl.write_jsonl(chunks.select(*jsonl.CHUNKS.names), path)
    return _big(jsonl.read_chunks(spark, path).drop("text"), "chunk_index", "n_tokens_ws")


@query(
    "eval_query_jsonl_scan",
    D.with_(D.QUERIES, D.LABELS)
    + """SELECT CAST(query_id AS VARCHAR) AS query_id, sha256(query)[1:16] AS content_id,
  (SELECT count(*) FROM relevant r WHERE r.query_id = q.query_id) AS n_relevant FROM queries q""",
)
def eval_query_jsonl_scan(spark, sf_dir):
    """Evaluation queries as JSON Lines; off-topic ones have no list at all."""
    path = scratch_path(spark, "queries-jsonl")
    # one line per relevant document, so that no list has to be gathered
    rows = tables.eval_queries(spark, sf_dir).join(tables.relevance(spark, sf_dir), "query_id", "left")
    one = F.when(F.col("doc_id").isNotNull(), F.array(F.col("doc_id").cast("string")))
    jsonl.write_jsonl(rows.select(F.col("query_id").cast("string").alias("query_id"), "query", one.alias("relevant_doc_ids")), path)
    read = jsonl.read_eval_queries(spark, path)
    return read.groupBy("query_id", T.content_key(F.col("query")).alias("content_id")).agg(
        F.sum(F.size("relevant_doc_ids")).alias("n_relevant")
    )


@query(
    "metadata_sidecar",
    D.with_(D.chunks())
    + """SELECT row_number() OVER (ORDER BY doc_id, chunk_index) - 1 AS vec_id, doc_id, CAST(chunk_index AS BIGINT) AS chunk_index,
  chunk_id, topic FROM chunks""",
)
def metadata_sidecar(spark, sf_dir):
    """Chunk metadata as Parquet with dense ids in key order."""
    path = scratch_path(spark, "metadata")
    meta = _chunks(spark, sf_dir).select("doc_id", "chunk_index", "chunk_id", "topic")
    store.write_table(store.with_dense_id(meta, ["doc_id", "chunk_index"]), path)
    return _big(store.read_table(spark, path), "chunk_index").select("vec_id", "doc_id", "chunk_index", "chunk_id", "topic")


@query(
    "vector_metadata_lookup",
    D.with_(D.chunks())
    + "SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk_id, topic, n_tokens_ws, CAST(64 AS BIGINT) AS dim FROM chunks",
)
def vector_metadata_lookup(spark, sf_dir):
    """Vectors joined to their metadata by key, both stored apart."""
    index = tables.chunk_index(spark, sf_dir)
    vectors = index.select("doc_id", "chunk_index", F.size("embedding").cast("bigint").alias("dim"))
    meta = index.select("doc_id", "chunk_index", "chunk_id", "topic", "n_tokens_ws")
    return _big(vectors.join(meta, ["doc_id", "chunk_index"]), "chunk_index", "n_tokens_ws")


@query(
    "vector_store_roundtrip",
    """SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
)
def vector_store_roundtrip(spark, sf_dir):
    """Vectors persisted apart from any index, as the table every index is built from."""
    path = scratch_path(spark, "vectors")
    store.write_table(tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return store.read_table(spark, path).select(
        "vec_id", F.size("embedding").cast("bigint").alias("dim"), F.round(total, 6).alias("total")
    )


PER_TOPIC = "SELECT topic, count(*) AS n_chunks, count(DISTINCT doc_id) AS n_docs FROM chunks GROUP BY topic"


@query("full_refresh_load", D.with_(D.chunks()) + PER_TOPIC)
def full_refresh_load(spark, sf_dir):
    """A second load replaces the first; then rows are counted per topic."""
    path = scratch_path(spark, "chunk-table")
    chunks = _chunks(spark, sf_dir)
    store.write_table(chunks.where(F.col("topic") == "src0"), path, ["topic"])
    store.write_table(chunks, path, ["topic"])
    return store.per_topic(store.read_table(spark, path))


@query("load_verification", D.with_(D.chunks()) + PER_TOPIC)
def load_verification(spark, sf_dir):
    return store.per_topic(tables.chunk_index(spark, sf_dir))


@query(
    "topic_partition_scan",
    """SELECT CAST(doc_id AS BIGINT) AS doc_id, source AS topic, length(text) AS n_chars FROM documents WHERE source = 'src5'""",
)
def topic_partition_scan(spark, sf_dir):
    """One directory per topic; a topic filter reads its own directory only."""
    path = scratch_path(spark, "by-topic")
    store.write_table(_docs(spark, sf_dir), path, ["topic"])
    wanted = store.read_table(spark, path).where(F.col("topic") == "src5")
    return wanted.select("doc_id", "topic", F.length("text").cast("bigint").alias("n_chars"))


@query(
    "contract_report",
    D.with_(D.chunks())
    + """SELECT 'null chunk_id' AS "check", count(*) FILTER (chunk_id IS NULL) AS violations FROM chunks
UNION ALL SELECT 'null doc_id', count(*) FILTER (doc_id IS NULL) FROM chunks
UNION ALL SELECT 'null topic', count(*) FILTER (topic IS NULL) FROM chunks
UNION ALL SELECT 'null text', count(*) FILTER (text IS NULL) FROM chunks
UNION ALL SELECT 'wrong dimension', 0
UNION ALL SELECT 'not unit length', count(*) FILTER (len(regexp_extract_all(text, '[A-Za-z0-9]+')) = 0) FROM chunks
UNION ALL SELECT 'duplicate key', count(*) FROM (SELECT 1 FROM chunks GROUP BY doc_id, chunk_index HAVING count(*) > 1)""",
)
def contract_report(spark, sf_dir):
    """Violations of the vector table's contract."""
    index = tables.chunk_index(spark, sf_dir)
    return store.contract_report(
        index, ["doc_id", "chunk_index"], ["chunk_id", "doc_id", "topic", "text"], "embedding", 64
    )


@query(
    "alignment_check",
    """SELECT (SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)) AS vectors_only,
  (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS metadata_only,
  (SELECT count(*) FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)) AS matched""",
)
def alignment_check(spark, sf_dir):
    vectors = tables.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return store.alignment(vectors, _docs(spark, sf_dir), ["doc_id"])


# ----------------------------------------------------------------------- chunking
@query(
    "fixed_chunks",
    D.with_(D.chunks())
    + f"""SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk_id, topic, n_tokens_ws, '{STRATEGY}' AS chunk_strategy_id
FROM chunks""",
)
def fixed_chunks(spark, sf_dir):
    return _big(_chunks(spark, sf_dir).drop("text"), "chunk_index", "n_tokens_ws")


def _sentence_sql(size: int = 64) -> str:
    return rf"""WITH RECURSIVE parts AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents),
clean AS (SELECT doc_id, list_filter(list_transform(s, lambda x: array_to_string({D.TOKENS.format('x').replace('lambda x: x', 'lambda y: y')}, ' ')),
                                     lambda z: z <> '') AS s FROM parts),
sent AS (SELECT doc_id, unnest(s) AS sentence, unnest(range(1, len(s) + 1)) AS pos FROM clean),
counted AS (SELECT doc_id, pos, sentence, len(string_split(sentence, ' ')) AS c FROM sent),
packed AS (
  SELECT doc_id, pos, sentence, c AS n, 0 AS chunk_index FROM counted WHERE pos = 1
  UNION ALL
  SELECT c.doc_id, c.pos, c.sentence, CASE WHEN p.n + c.c <= {size} THEN p.n + c.c ELSE c.c END,
         CASE WHEN p.n + c.c <= {size} THEN p.chunk_index ELSE p.chunk_index + 1 END
  FROM packed p JOIN counted c ON c.doc_id = p.doc_id AND c.pos = p.pos + 1)
SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, CAST(max(n) AS BIGINT) AS n_tokens_ws,
       sha256(string_agg(sentence, ' ' ORDER BY pos))[1:16] AS chunk_id FROM packed GROUP BY doc_id, chunk_index"""


@query("sentence_chunks", _sentence_sql())
def sentence_chunks(spark, sf_dir):
    """Whole sentences packed up to 64 tokens."""
    chunks = chunking.sentence_chunks(_docs(spark, sf_dir).drop("topic"), 64)
    return _big(chunks.drop("text"), "chunk_index", "n_tokens_ws")


@query(
    "ingest_counts",
    D.with_(D.chunks())
    + """SELECT (SELECT count(*) FROM documents) AS n_docs, count(*) AS n_chunks,
  round(count(*) / (SELECT greatest(count(*), 1) FROM documents), 6) AS chunks_per_doc FROM chunks""",
)
def ingest_counts(spark, sf_dir):
    counts = chunking.ingest_counts(_docs(spark, sf_dir), _chunks(spark, sf_dir))
    return counts.withColumn("chunks_per_doc", F.round("chunks_per_doc", 6))


SWEEP = [(16, 4), (32, 8), (64, 16), (128, 0), (200, 0)]


def _sweep_sql() -> str:
    parts = []
    for size, overlap in SWEEP:
        parts.append(
            "(" + D.with_(D.chunks(size, overlap))
            + f"""SELECT CAST({size} AS BIGINT) AS size, CAST({overlap} AS BIGINT) AS overlap, count(*) AS n_chunks,
  round(count(*) / (SELECT count(*) FROM documents), 2) AS chunks_per_doc, round(avg(n_tokens_ws), 1) AS avg_len,
  CAST(max(n_tokens_ws) AS BIGINT) AS max_len FROM chunks)"""
        )
    return " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts)


@query("chunk_size_sweep", _sweep_sql())
def chunk_size_sweep(spark, sf_dir):
    """Chunk counts and lengths under five configurations, in one pass over the text."""
    return _big(chunking.size_sweep(_docs(spark, sf_dir), SWEEP), "size", "overlap", "max_len")


@query(
    "run_metrics",
    " UNION ALL ".join(
        f"SELECT config, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM (SELECT size || '/' || overlap AS config, * FROM ({_sweep_sql()}))"
        for m in ("n_chunks", "avg_len", "max_len")
    ),
)
def run_metrics(spark, sf_dir):
    """Sweep results appended to a metrics table, one run at a time, and read back."""
    path = scratch_path(spark, "run-metrics")
    sweep = chunking.size_sweep(_docs(spark, sf_dir), SWEEP).withColumn("config", F.concat_ws("/", "size", "overlap"))
    rows = store.metric_rows(sweep, "config", {m: F.col(m) for m in ("n_chunks", "avg_len", "max_len")})
    store.append_table(rows.where(F.col("config") == "32/8"), path)
    store.append_table(rows.where(F.col("config") != "32/8"), path)
    return store.read_table(spark, path)


@query(
    "content_dedup",
    D.with_(D.chunks())
    + """SELECT chunk_id, min((doc_id, chunk_index))[1] AS doc_id, CAST(min((doc_id, chunk_index))[2] AS BIGINT) AS chunk_index,
  count(*) AS copies FROM chunks GROUP BY chunk_id""",
)
def content_dedup(spark, sf_dir):
    """One row per distinct chunk text, the first copy kept."""
    return _big(chunking.distinct_content(_chunks(spark, sf_dir)).drop("text"), "chunk_index")


@query(
    "strategy_guard",
    D.with_(D.chunks()) + f"SELECT '{STRATEGY}' AS chunk_strategy_id, count(*) AS n_chunks FROM chunks",
)
def strategy_guard(spark, sf_dir):
    """Counts chunks of the one expected strategy; a mixed table would fail here."""
    guarded = chunking.one_strategy(_chunks(spark, sf_dir), STRATEGY)
    return guarded.groupBy("chunk_strategy_id").agg(F.count(F.lit(1)).alias("n_chunks"))


@query(
    "token_functions",
    rf"""SELECT doc_id, CAST(len({D.tokens()}) AS BIGINT) AS n_tokens, CAST(len({D.terms()}) AS BIGINT) AS n_terms,
  sha256(text)[1:16] AS content_id, sha256(array_to_string({D.tokens()}, ' '))[1:16] AS rejoined_id,
  CASE WHEN length(text) > 160 THEN substr(replace(text, chr(10), ' '), 1, 157) || '...' ELSE replace(text, chr(10), ' ') END AS preview
FROM documents""",
)
def token_functions(spark, sf_dir):
    """White-space tokens, word terms, content keys and previews of whole documents."""
    text = F.col("text")
    return _docs(spark, sf_dir).select(
        "doc_id",
        F.size(T.ws_tokens(text)).cast("bigint").alias("n_tokens"),
        F.size(T.word_terms(text)).cast("bigint").alias("n_terms"),
        T.content_key(text).alias("content_id"),
        T.content_key(T.rejoin(T.ws_tokens(text))).alias("rejoined_id"),
        T.preview(text).alias("preview"),
    )


@query(
    "blank_lines",
    r"""SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) = '' AS blank, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '\s+', '', 'g') = '')) AS BIGINT) AS n_blank_lines FROM documents""",
)
def blank_lines(spark, sf_dir):
    """Blank documents, and the blank lines of each."""
    lines = F.split("text", "\n", -1)
    return _docs(spark, sf_dir).select(
        "doc_id",
        T.is_blank(F.col("text")).alias("blank"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.size(F.filter(lines, T.is_blank)).cast("bigint").alias("n_blank_lines"),
    )


@query(
    "event_properties",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"user":' || user_id || ',"kind":"' || event_type || '"}' AS line
FROM events""",
)
def event_properties(spark, sf_dir):
    """JSON parsed into a column and rows written as JSON text."""
    parsed = F.from_json("props", "k bigint")["k"]
    line = F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")))
    return tables.events(spark, sf_dir).select("event_id", parsed.alias("k"), line.alias("line"))


# ---------------------------------------------------------------------- lifecycle
@query(
    "incremental_embedding",
    D.with_(D.chunks())
    + """SELECT chunk_id, min((doc_id, chunk_index))[1] AS doc_id, CAST(min((doc_id, chunk_index))[2] AS BIGINT) AS chunk_index
FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM chunks c JOIN documents d USING (doc_id) WHERE d.lang = 'en')
GROUP BY chunk_id""",
)
def incremental_embedding(spark, sf_dir):
    """Chunks still to encode when English documents are stored already."""
    chunks = _chunks(spark, sf_dir)
    english = tables.documents(spark, sf_dir).where(F.col("lang") == "en").select("doc_id")
    stored = chunks.join(english, "doc_id", "left_semi").select("chunk_id").distinct()
    return _big(encoding.not_yet_embedded(chunks, stored).drop("text", "copies"), "chunk_index")


REVISED = "SELECT doc_id, source, text || ' revised' AS text FROM documents WHERE lang = 'fr'"


@query(
    "incremental_second_run",
    D.with_(D.chunks())
    + "SELECT count(DISTINCT chunk_id) AS n_new FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM chunks)",
)
def incremental_second_run(spark, sf_dir):
    """A second run over unchanged chunks finds nothing to encode."""
    chunks = _chunks(spark, sf_dir)
    stored = chunks.select("chunk_id").distinct()
    return encoding.not_yet_embedded(chunks, stored).agg(F.count(F.lit(1)).alias("n_new"))


def _merged_sql(docs: str) -> str:
    return (
        D.with_(f"source_docs AS ({docs})", D.chunks().replace("FROM documents", "FROM source_docs"))
        + "SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk_id FROM chunks"
    )


@query(
    "upsert_chunks",
    _merged_sql(
        "SELECT doc_id, source, CASE WHEN lang = 'fr' THEN text || ' revised' ELSE text END AS text FROM documents"
    ),
)
def upsert_chunks(spark, sf_dir):
    """French documents grow by a word; their chunks replace the stored ones by key, and only their buckets are written."""
    table = _versioned_chunks(spark, sf_dir)
    version = lifecycle.upsert_into(table, _revised_chunks(spark, sf_dir), CHUNK_KEY, base=0)
    current = table.rows(version).where(F.col("chunk_strategy_id") == STRATEGY)
    return _big(current.select("doc_id", "chunk_index", "chunk_id"), "chunk_index")


CHUNK_KEY = ["doc_id", "chunk_strategy_id", "chunk_index"]
OTHER_STRATEGY = chunking.strategy_id("v1", "fixed", 64, 16, "hashed-64")


def _versioned_chunks(spark, sf_dir) -> versioned.VersionedTable:
    """Chunks under two strategies in one table, in buckets of the document; version 0 stays as loaded."""

    def build() -> DataFrame:
        return _chunks(spark, sf_dir).unionByName(chunking.fixed_chunks(_docs(spark, sf_dir), 64, 16, strategy=OTHER_STRATEGY))

    def keep(rows: DataFrame, label: str) -> versioned.VersionedTable:
        return versioned.create(rows, ["doc_id"], scratch_path(spark, f"{label}-versions"))

    return tables._once(spark, ("versioned-chunks", sf_dir), build, keep=keep)


def _revised_chunks(spark, sf_dir) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    revised = docs.where(F.col("lang") == "fr").withColumn("text", F.concat("text", F.lit(" revised")))
    return chunking.fixed_chunks(revised.select("doc_id", "topic", "text"), SIZE, OVERLAP, strategy=STRATEGY)


@query(
    "upsert_two_strategies",
    D.with_(
        """revised AS (SELECT doc_id, source, CASE WHEN lang = 'fr' THEN text || ' revised' ELSE text END AS text FROM documents)""",
        D.chunks(name="small").replace("FROM documents", "FROM revised"),
        D.chunks(64, 16, name="large"),
    )
    + f"""SELECT doc_id, '{STRATEGY}' AS chunk_strategy_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk_id FROM small
UNION ALL SELECT doc_id, '{OTHER_STRATEGY}', CAST(chunk_index AS BIGINT), chunk_id FROM large""",
)
def upsert_two_strategies(spark, sf_dir):
    """The same change where chunks of another size share the table: the strategy is part of the key, so they stay."""
    table = _versioned_chunks(spark, sf_dir)
    version = lifecycle.upsert_into(table, _revised_chunks(spark, sf_dir), CHUNK_KEY, base=0)
    return _big(table.rows(version).select("doc_id", "chunk_strategy_id", "chunk_index", "chunk_id"), "chunk_index")


@query(
    "append_embeddings",
    D.with_(
        D.chunks(),
        "languages AS (SELECT c.chunk_id, bool_and(d.lang = 'de') AS late FROM chunks c JOIN documents d USING (doc_id) GROUP BY 1)",
    )
    + """SELECT chunk_id, CAST(64 AS BIGINT) AS dim, CASE WHEN late THEN 1 ELSE 0 END AS run,
  (SELECT count(*) FROM languages WHERE late) AS n_second, 0 AS n_third FROM languages""",
)
def append_embeddings(spark, sf_dir):
    """Vectors of all but German texts are stored; a second run over all texts appends what is new, a third nothing."""
    chunks = _chunks(spark, sf_dir)
    german = tables.documents(spark, sf_dir).where(F.col("lang") == "de").select("doc_id")
    vectors = encoding.embed(chunking.distinct_content(chunks)).select("chunk_id", "embedding")
    vectors = through_table(vectors, "all-vectors")
    first = chunks.join(german, "doc_id", "left_anti").select("chunk_id").distinct()
    table = versioned.create(vectors.join(first, "chunk_id", "left_semi"), ["chunk_id"], scratch_path(spark, "vector-store"))
    n_second = table.append_new(vectors, ["chunk_id"])
    n_third = table.append_new(vectors, ["chunk_id"])
    before = table.rows(0).select("chunk_id", F.lit(0).alias("run"))
    rows = table.rows().join(before, "chunk_id", "left").withColumn("run", F.coalesce("run", F.lit(1)))
    return rows.select(
        "chunk_id", F.size("embedding").cast("bigint").alias("dim"), "run", F.lit(n_second).cast("bigint").alias("n_second"), F.lit(n_third).alias("n_third")
    )


CHANGED_DOCS = """SELECT doc_id, source, CASE WHEN lang = 'es' THEN text || ' revised' ELSE text END AS text
FROM documents WHERE lang <> 'de'"""


def change_feed(docs: DataFrame) -> DataFrame:
    """Every document first inserted, French ones twice as long; then German ones deleted, French ones shrunk, Spanish ones extended."""
    lang = F.col("lang")
    op = F.when(lang == "de", "delete").when(lang.isin("fr", "es"), "update").otherwise("insert")
    text = F.when(lang == "es", F.concat("text", F.lit(" revised"))).otherwise(F.col("text"))
    before = F.when(lang == "fr", F.concat_ws(" ", "text", "text")).otherwise(F.col("text"))
    first = docs.select("doc_id", "topic", before.alias("text"), F.lit("insert").alias("op"), F.lit(1).cast("bigint").alias("seq"))
    return first.unionByName(docs.select("doc_id", "topic", text.alias("text"), op.alias("op"), F.lit(2).cast("bigint").alias("seq")))


@query("apply_change_feed", _merged_sql(CHANGED_DOCS))
def apply_change_feed(spark, sf_dir):
    """Inserts, updates and deletes applied to a chunk table; shrunken documents leave no rest."""
    def build(docs: DataFrame) -> DataFrame:
        return chunking.fixed_chunks(docs, SIZE, OVERLAP, strategy=STRATEGY)

    feed = change_feed(tables.documents(spark, sf_dir))
    table = _versioned_chunks(spark, sf_dir)
    # chunks of the other strategy are not what this feed speaks of
    version = lifecycle.apply_changes_to(table, feed, build, base=0, scope=F.col("chunk_strategy_id") == STRATEGY)
    merged = table.rows(version).where(F.col("chunk_strategy_id") == STRATEGY)
    return _big(merged.select("doc_id", "chunk_index", "chunk_id"), "chunk_index")


@query("delete_reconciliation", "SELECT doc_id FROM documents WHERE lang = 'de' AND length(trim(text)) > 0")
def delete_reconciliation(spark, sf_dir):
    """Indexed documents the source has dropped (here: German ones)."""
    source = tables.documents(spark, sf_dir).where(F.col("lang") != "de")
    return lifecycle.deleted_from_source(tables.chunk_index(spark, sf_dir), source)


DATED = "SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) AS created_at FROM documents"


def _dated(spark, sf_dir) -> DataFrame:
    start = F.lit("2024-01-01").cast("timestamp")
    return tables.documents(spark, sf_dir).withColumn(
        "created_at", F.timestamp_add("DAY", (F.col("doc_id") % 30).cast("int"), start)
    )


@query(
    "recent_documents",
    f"SELECT doc_id, created_at FROM ({DATED}) WHERE created_at >= TIMESTAMP '2024-01-20'",
)
def recent_documents(spark, sf_dir):
    recent = lifecycle.newer_than(_dated(spark, sf_dir), "created_at", F.lit("2024-01-20").cast("timestamp"))
    return recent.select("doc_id", tables.plain_ts(F.col("created_at")).alias("created_at"))


@query(
    "retained_orders",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >=
  (SELECT CAST(max(CAST(o_orderdate AS DATE)) - INTERVAL 60 MONTHS AS DATE) FROM orders)""",
)
def retained_orders(spark, sf_dir):
    """Orders of the five years up to the newest one."""
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    newest = orders.agg(F.to_date(F.max("o_orderdate")).alias("d")).scalar()
    return lifecycle.within_retention(orders, "o_orderdate", newest)


@query(
    "source_of_truth",
    f"""SELECT topic, doc_id, is_canonical, updated_at FROM (
  SELECT d.source AS topic, d.doc_id, coalesce(l.quality, 0) = 1 AS is_canonical, d.created_at AS updated_at,
    row_number() OVER (PARTITION BY d.source ORDER BY coalesce(l.quality, 0) DESC, d.created_at DESC, d.doc_id) AS r
  FROM ({DATED}) d LEFT JOIN labels l USING (doc_id)) WHERE r = 1""",
)
def source_of_truth(spark, sf_dir):
    """Per topic the version to trust: labelled good first, then the most recent."""
    labels = tables.table(spark, sf_dir, "labels").select("doc_id", "quality")
    versions = _dated(spark, sf_dir).join(labels, "doc_id", "left")
    versions = versions.withColumn("is_canonical", F.coalesce(F.col("quality") == 1, F.lit(False)))
    best = lifecycle.source_of_truth(
        versions.withColumnRenamed("created_at", "updated_at"), "topic", "is_canonical", "updated_at", "doc_id"
    )
    return best.withColumn("updated_at", tables.plain_ts(F.col("updated_at")))


@query(
    "migration_backlog",
    """SELECT d.doc_id, length(d.text) AS priority FROM documents d
WHERE CASE WHEN lang = 'en' THEN '2' ELSE '1' END <> '2'""",
)
def migration_backlog(spark, sf_dir):
    """Documents whose vectors come from an older encoder, longest first."""
    version = F.when(F.col("lang") == "en", "2").otherwise("1")
    stored = tables.documents(spark, sf_dir).select(
        "doc_id", F.length("text").cast("bigint").alias("priority"), version.alias("model_version")
    )
    return lifecycle.migration_backlog(stored, "2", "priority").drop("model_version")


# ----------------------------------------------------------------- access control
ACL_SQL = [
    D.QUERIES,
    "asked AS (SELECT query_id, query_id + 1 AS user_id FROM queries)",
    """user_groups AS (SELECT c_custkey AS user_id,
      CASE WHEN c_mktsegment = 'BUILDING' THEN ['src' || c_nationkey, 'public'] ELSE ['src' || c_nationkey] END AS groups
      FROM customer WHERE c_acctbal > 0)""",
    "acl AS (SELECT doc_id, CASE WHEN lang = 'en' THEN [source, 'public'] ELSE [source] END AS acl_groups FROM documents)",
    D.hashed("documents", "doc_id", "text", "dv"),
    D.QUERY_VECTORS,
    """allowed AS (SELECT q.query_id, d.doc_id FROM asked q JOIN user_groups g USING (user_id)
       JOIN acl d ON list_has_any(d.acl_groups, g.groups))""",
]


def user_groups(spark, sf_dir) -> DataFrame:
    """Groups of customers in good standing; the others have no entry."""
    own = F.concat(F.lit("src"), F.col("c_nationkey").cast("string"))
    groups = F.when(F.col("c_mktsegment") == "BUILDING", F.array(own, F.lit("public"))).otherwise(F.array(own))
    customers = tables.table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return customers.select(F.col("c_custkey").alias("user_id"), groups.alias("groups"))


def doc_acl(spark, sf_dir) -> DataFrame:
    groups = F.when(F.col("lang") == "en", F.array(F.col("topic"), F.lit("public"))).otherwise(F.array("topic"))
    return tables.doc_index(spark, sf_dir).withColumn("acl_groups", groups)


def asking_users(spark, sf_dir) -> DataFrame:
    return tables.query_vectors(spark, sf_dir).withColumn("user_id", F.col("query_id") + 1)


def _acl_hits(spark, sf_dir, k: int = 5) -> DataFrame:
    corpus = doc_acl(spark, sf_dir).select("doc_id", "embedding", "acl_groups")
    return access.search_as_user(
        asking_users(spark, sf_dir), corpus, user_groups(spark, sf_dir), topk.VectorScorer(), k, ["doc_id"]
    )


@query(
    "acl_search",
    D.with_(
        *ACL_SQL,
        """s AS (SELECT a.query_id, a.doc_id, coalesce(sum(q.w * d.w), 0) AS score FROM allowed a
           LEFT JOIN dv d USING (doc_id) LEFT JOIN qv q ON q.query_id = a.query_id AND q.b = d.b GROUP BY ALL)""",
    )
    + """SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s) WHERE rank <= 5""",
)
def acl_search(spark, sf_dir):
    """Documents each user may see, ranked; users without groups get nothing."""
    return _acl_hits(spark, sf_dir).withColumn("score", F.round("score", 6))


@query(
    "acl_post_filter",
    D.with_(*ACL_SQL, D.vector_rank("dv", "doc_id", 50, "r"))
    + """SELECT query_id, count(a.doc_id) FILTER (a.doc_id IS NOT NULL AND n <= 5) AS n_found,
  5 - count(a.doc_id) FILTER (a.doc_id IS NOT NULL AND n <= 5) AS missing
FROM queries q LEFT JOIN (SELECT r.query_id, r.doc_id, row_number() OVER (PARTITION BY r.query_id ORDER BY r.rank) AS n
  FROM r JOIN allowed USING (query_id, doc_id)) a USING (query_id) GROUP BY query_id""",
)
def acl_post_filter(spark, sf_dir):
    """Rank 50 first, drop what the user may not see, and report how many of 5 are missing."""
    queries = asking_users(spark, sf_dir)
    acl = doc_acl(spark, sf_dir)
    over_fetched = topk.top_k(queries, acl, topk.VectorScorer(), 50, ["doc_id"])
    seen = access.drop_unauthorised(
        over_fetched, queries, acl.select("doc_id", "acl_groups"), user_groups(spark, sf_dir), ["doc_id"]
    )
    return access.shortfall(queries, seen, 5).withColumn("missing", F.col("missing").cast("bigint"))


@query(
    "audit_log",
    D.with_(
        *ACL_SQL,
        """s AS (SELECT a.query_id, a.doc_id, coalesce(sum(q.w * d.w), 0) AS score FROM allowed a
           LEFT JOIN dv d USING (doc_id) LEFT JOIN qv q ON q.query_id = a.query_id AND q.b = d.b GROUP BY ALL)""",
        """r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
           FROM s) WHERE rank <= 5)""",
        "l AS (SELECT query_id, string_agg(doc_id, ',' ORDER BY rank) AS docs FROM r GROUP BY query_id)",
    )
    + """SELECT DATE '2024-02-01' AS day, query_id, user_id, coalesce(docs, '') AS returned, coalesce(array_to_string(groups, ','), '') AS groups
FROM asked LEFT JOIN l USING (query_id) LEFT JOIN user_groups USING (user_id)""",
)
def audit_log(spark, sf_dir):
    """One appended audit row per query, partitioned by day."""
    path = scratch_path(spark, "audit")
    at = F.lit("2024-02-01 08:00:00").cast("timestamp")
    rows = access.audit_events(_acl_hits(spark, sf_dir), asking_users(spark, sf_dir), user_groups(spark, sf_dir), at)
    store.append_table(rows.withColumn("day", F.to_date("ts")), path, ["day"])
    return store.read_table(spark, path).select(
        "day",
        "query_id",
        "user_id",
        F.concat_ws(",", F.col("returned_doc_ids").cast("array<string>")).alias("returned"),
        F.concat_ws(",", "user_acl_groups").alias("groups"),
    )


WEEKS = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"]


@query(
    "audit_reconciliation",
    """WITH audit AS (SELECT event_id, user_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS doc_id, 'src' || (user_id % 20) AS g FROM events),
snap AS (SELECT doc_id, TIMESTAMP '2024-01-01' + to_days(CAST(7 * w AS INTEGER)) AS snapshot_ts, 'src' || ((doc_id + w) % 20) AS acl
  FROM documents, range(5) t(w)),
j AS (SELECT a.event_id, a.user_id, a.doc_id, a.g, s.acl, s.snapshot_ts,
  row_number() OVER (PARTITION BY a.event_id ORDER BY s.snapshot_ts DESC) AS r
  FROM audit a JOIN snap s ON s.doc_id = a.doc_id AND s.snapshot_ts <= a.ts)
SELECT event_id, user_id, doc_id, snapshot_ts FROM j WHERE r = 1 AND acl <> g""",
)
def audit_reconciliation(spark, sf_dir):
    """Returned documents replayed against the weekly permission snapshot then in force."""
    k = F.from_json("props", "k bigint")["k"]
    audit = tables.events(spark, sf_dir).select(
        "event_id",
        "user_id",
        "ts",
        F.array(F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string"))).alias("user_acl_groups"),
        F.array(k).alias("returned_doc_ids"),
    )
    weeks = F.array(*[F.lit(w).cast("timestamp") for w in WEEKS])
    snapshots = tables.documents(spark, sf_dir).select("doc_id", F.posexplode(weeks).alias("_w", "snapshot_ts"))
    group = F.concat(F.lit("src"), ((F.col("doc_id") + F.col("_w")) % 20).cast("string"))
    snapshots = snapshots.select("doc_id", "snapshot_ts", F.array(group).alias("acl_groups"))
    wrong = access.audit_mismatches(audit, snapshots)
    return wrong.select("event_id", "user_id", "doc_id", tables.plain_ts(F.col("snapshot_ts")).alias("snapshot_ts"))
