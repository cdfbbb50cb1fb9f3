"""Building blocks of the checking SQL (DuckDB dialect). Each returns CTE text."""

from __future__ import annotations


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


TOKENS = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda x: x <> '')"
TERMS = "list_transform(regexp_extract_all({0}, '[A-Za-z0-9]+'), lambda x: lower(x))"


def tokens(column: str = "text") -> str:
    return TOKENS.format(column)


def terms(column: str = "text") -> str:
    return TERMS.format(column)


def windows(n: str, size: int, overlap: int) -> str:
    step = size - overlap
    return f"CASE WHEN {n} = 0 THEN 0 WHEN {n} <= {size} THEN 1 ELSE CAST(ceil(({n} - {size}) / {step}.0) AS BIGINT) + 1 END"


def chunks(size: int = 32, overlap: int = 8, name: str = "chunks") -> str:
    step = size - overlap
    return f"""
{name}_tok AS (SELECT doc_id, source AS topic, {tokens()} AS t FROM documents),
{name}_win AS (SELECT doc_id, topic, t, unnest(range(0, {windows('len(t)', size, overlap)})) AS i FROM {name}_tok),
{name} AS (
  SELECT doc_id, topic, i AS chunk_index, array_to_string(t[i * {step} + 1 : i * {step} + {size}], ' ') AS text,
         CAST(len(t[i * {step} + 1 : i * {step} + {size}]) AS BIGINT) AS n_tokens_ws,
         sha256(array_to_string(t[i * {step} + 1 : i * {step} + {size}], ' '))[1:16] AS chunk_id
  FROM {name}_win)"""


def hashed(source: str, keys: str, text: str, name: str, dim: int = 64) -> str:
    """Sparse unit vectors (keys, b, w) of a text column."""
    return f"""
{name}_t AS (SELECT {keys}, unnest({terms(text)}) AS term FROM {source}),
{name}_b AS (SELECT {keys}, CAST('0x' || sha256(term)[1:8] AS BIGINT) % {dim} AS b, count(*) AS c
             FROM {name}_t GROUP BY ALL),
{name} AS (SELECT {keys}, b, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY {keys})) AS FLOAT) AS DOUBLE) AS w
           FROM {name}_b)"""


def _on(keys: str, prefix: str) -> str:
    return ", ".join(f"{prefix}.{k.strip()}" for k in keys.split(","))


def vector_rank(corpus: str, keys: str, k: int | None, name: str, queries: str = "qv", where: str = "") -> str:
    """Ranking (query_id, keys, score, rank) by hashed cosine."""
    cut = f"WHERE rank <= {k}" if k else ""
    return f"""
{name}_s AS (SELECT q.query_id, {_on(keys, 'c')}, sum(q.w * c.w) AS score
             FROM {queries} q JOIN {corpus} c USING (b) {where} GROUP BY ALL),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, {keys}) AS rank
           FROM {name}_s) {cut})"""


def bm25_rank(corpus: str, keys: str, k: int | None, name: str, queries: str = "queries", text: str = "text") -> str:
    """Ranking by BM25; ``queries`` has (query_id, query)."""
    cut = f"WHERE rank <= {k}" if k else ""
    return f"""
{name}_l AS (SELECT {keys}, {terms(text)} AS terms FROM {corpus}),
{name}_n AS (SELECT count(*) AS n, avg(len(terms)) AS avgdl FROM {name}_l),
{name}_tf AS (SELECT {keys}, dl, term, count(*) AS tf
              FROM (SELECT {keys}, len(terms) AS dl, unnest(terms) AS term FROM {name}_l) GROUP BY ALL),
{name}_df AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS idf
              FROM (SELECT term, count(*) AS df FROM {name}_tf GROUP BY term), {name}_n),
{name}_idf AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM {name}_df) ELSE idf END AS idf
               FROM {name}_df),
{name}_q AS (SELECT query_id, term, count(*) AS qtf
             FROM (SELECT query_id, unnest({terms('query')}) AS term FROM {queries}) GROUP BY ALL),
{name}_s AS (SELECT q.query_id, {_on(keys, 't')},
                    sum(q.qtf * i.idf * t.tf * 2.5 / (t.tf + 1.5 * (0.25 + 0.75 * t.dl / n.avgdl))) AS score
             FROM {name}_q q JOIN {name}_idf i USING (term) JOIN {name}_tf t USING (term), {name}_n n GROUP BY ALL),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, {keys}) AS rank
           FROM {name}_s) {cut})"""


def fuse(first: str, second: str, keys: str, k: int, name: str) -> str:
    """Reciprocal rank fusion of two rankings."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC,
                                 r1 ASC NULLS LAST, r2 ASC NULLS LAST, {keys}) AS rank
    FROM (SELECT query_id, {keys}, a.rank AS r1, b.rank AS r2,
                 coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0) AS score
          FROM {first} a FULL JOIN {second} b USING (query_id, {keys}))) WHERE rank <= {k})"""


def collapse(ranking: str, max_docs: int | None, name: str) -> str:
    cut = f"WHERE rank <= {max_docs}" if max_docs else ""
    return f"""
{name} AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY first) AS rank
           FROM (SELECT query_id, doc_id, min(rank) AS first FROM {ranking} GROUP BY ALL)) {cut})"""


QUERIES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
QUERY_VECTORS = hashed("queries", "query_id", "query", "qv")
LABELS = """
relevant AS (SELECT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""


def scores(docs: str, name: str) -> str:
    """recall, hit and reciprocal rank per query for a document ranking; needs ``queries`` and ``relevant``."""
    return f"""
{name}_n AS (SELECT query_id, count(*) AS n FROM relevant GROUP BY query_id),
{name}_f AS (SELECT r.query_id, count(*) FILTER (d.rank <= 1) AS f1, count(*) FILTER (d.rank <= 3) AS f3,
                    count(*) FILTER (d.rank <= 10) AS f10, min(d.rank) AS first
             FROM relevant r LEFT JOIN {docs} d USING (query_id, doc_id) GROUP BY r.query_id),
{name} AS (
  SELECT q.query_id, coalesce(n, 0) AS n_relevant,
    f1 / n AS recall_at_1, f3 / n AS recall_at_3, f10 / n AS recall_at_10,
    CAST(f1 > 0 AS BIGINT) AS hit_at_1, CAST(f3 > 0 AS BIGINT) AS hit_at_3, CAST(f10 > 0 AS BIGINT) AS hit_at_10,
    CASE WHEN n IS NULL THEN NULL WHEN first <= 10 THEN 1.0::DOUBLE / first ELSE 0.0::DOUBLE END AS rr
  FROM queries q LEFT JOIN {name}_n USING (query_id) LEFT JOIN {name}_f USING (query_id))"""


def means(source: str, per: str = "") -> str:
    head = f"{per}, " if per else ""
    tail = f" GROUP BY {per}" if per else ""
    return f"""SELECT {head}count(*) AS n_queries, count(rr) AS n_scored,
  round(avg(recall_at_1), 6) AS recall_at_1, round(avg(recall_at_3), 6) AS recall_at_3,
  round(avg(recall_at_10), 6) AS recall_at_10, round(avg(hit_at_1), 6) AS hit_rate_at_1,
  round(avg(hit_at_3), 6) AS hit_rate_at_3, round(avg(hit_at_10), 6) AS hit_rate_at_10, round(avg(rr), 6) AS mrr
FROM {source}{tail}"""
