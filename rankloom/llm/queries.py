"""One registered query for each operator, over its whole table with the operators' own parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import (
    collocations, kneser_ney, language, near_duplicates, packing, passages, pieces, pii, pivot_index, signatures, toxicity, training_order, vantage,
)
from rankloom.llm.common import table

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return pivot_index.search(rows, rows.where(F.col("vec_id") % 100 == 0), 10)


def op3_quality_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kneser_ney.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "language", "perplexity", "threshold", "keep")


def op4_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vantage.search(rows, rows.where(F.col("vec_id") % 50 == 0), 5)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.digest(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signatures.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_pseudonyms, op2_exact_topk, op3_quality_kneser_ney, op4_vantage_trees, op5_packing,
        op6_training_order, op7_language, op8_near_duplicates, op9_pieces, op10_toxicity, op11_repeated_passages, op12_collocations, op13_ranked_search,
    )
}

SQL: dict[str, str] = {
    "op2_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
    "op12_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, s, unnest(list_transform(range(1, len(ws) - s + 2), lambda i: array_to_string(ws[i:i + s - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS s) WHERE len(ws) >= s),
f AS (SELECT lang, s, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, s, phrase HAVING count(*) >= 30),
cut AS (SELECT lang, phrase, ws, s, f AS a, unnest(range(1, s)) AS k FROM f WHERE s > 1),
lr AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST((CAST(c.a AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score
       FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
       JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
best AS (SELECT * FROM lr QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, f, unnest(flatten(list_transform(range(2, s), lambda m: list_transform(range(1, s - m + 2),
                  lambda i: array_to_string(ws[i:i + m - 1], ' '))))) AS phrase FROM f WHERE s > 2),
held AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.f IS NULL OR 100 * h.f < 80 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000""",
    "op13_ranked_search": r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
s AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT q.item_id, q.term, CAST(floor(1000 * ln((2 * s.N + 2) / (2 * df.df + 1))) AS BIGINT) AS w FROM q JOIN df USING (term), s),
sc AS (SELECT w.item_id, tf.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (100 - 50 + (50 * n.n * s.N) // s.L)))) AS BIGINT) AS score
       FROM w JOIN tf USING (term) JOIN n ON n.doc_id = tf.doc_id, s GROUP BY w.item_id, tf.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= 50""",
}
