"""Turning text into vectors, in Arrow batches, with any encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from rankloom.functions import text as T
from rankloom.functions import vectors as V
from rankloom.operators.chunking import distinct_content
from rankloom.scale import skew_join


#: Bytes of text that an encoder gets at once.
ENCODE_BYTES = 2_000_000


class Encoder(Protocol):
    """What ``embed`` needs: a name, a version, a dimension and a batch method."""

    model_id: str
    model_version: str
    dim: int

    def encode(self, texts: pa.Array) -> np.ndarray:
        """(len(texts), dim) float32."""
        ...


class HashedEncoder:
    """Bucketed term counts scaled to unit length. Lexical, not semantic; the default offline."""

    def __init__(self, dim: int = 64):
        self.dim = dim
        self.model_id = f"hashed-{dim}"
        self.model_version = "1"
        self._known: dict[str, int] = {}

    def _bucket(self, term: str) -> int:
        known = self._known.get(term)
        if known is None:
            if len(self._known) > 500_000:
                self._known.clear()
            known = int(hashlib.sha256(term.encode("ascii")).hexdigest()[:8], 16) % self.dim
            self._known[term] = known
        return known

    def encode(self, texts: pa.Array) -> np.ndarray:
        # non-ASCII letters split terms; case is folded after the split
        split = pc.split_pattern_regex(texts, r"[^A-Za-z0-9]+")
        flat = split.flatten()
        parent = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
        keep = pc.not_equal(pc.binary_length(flat), 0)
        parent = parent[keep.to_numpy(zero_copy_only=False)].astype(np.int64)
        terms = pc.ascii_lower(flat.filter(keep)).dictionary_encode()
        bucket = np.fromiter((self._bucket(t) for t in terms.dictionary.to_pylist()), np.int64, len(terms.dictionary))
        slot = parent * self.dim + bucket[terms.indices.to_numpy(zero_copy_only=False)]
        counts = np.bincount(slot, minlength=len(texts) * self.dim).reshape(len(texts), self.dim).astype(np.float64)
        length = np.sqrt((counts * counts).sum(axis=1))
        length[length == 0] = 1.0
        return (counts / length[:, None]).astype(np.float32)


def _parts(rows: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``most`` rows and, unless one text is longer, ENCODE_BYTES of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(rows.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < rows.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = int(np.searchsorted(ends, before + ENCODE_BYTES, side="right"))
        stop = min(max(stop, start + 1), start + most, rows.num_rows)
        yield rows.slice(start, stop - start)
        start = stop


def embed(
    rows: DataFrame, make_encoder: Callable[[], Encoder] = HashedEncoder, text: str = "text", batch: int = 4096
) -> DataFrame:
    """Adds ``embedding``. The encoder is built once per task and fed up to ``batch`` texts and ENCODE_BYTES at a time."""
    schema = S.StructType([*rows.schema.fields, S.StructField("embedding", S.ArrayType(S.FloatType(), False))])

    def run(batches):
        encoder = make_encoder()
        for whole in batches:
            for part in _parts(whole, text, batch):
                vectors = encoder.encode(part.column(text))
                flat = pa.array(vectors.reshape(-1), pa.float32())
                offsets = pa.array(np.arange(len(vectors) + 1) * vectors.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(offsets, flat)], [*part.schema.names, "embedding"]
                )

    return rows.mapInArrow(run, schema)


def hashed_embedding(rows: DataFrame, dim: int = 64, text: str = "text") -> DataFrame:
    """The hashed encoder in built-in expressions only; same vectors as ``HashedEncoder``."""
    return rows.withColumn("embedding", V.hashed_vector(T.word_terms(F.col(text)), dim))


def embed_distinct(chunks: DataFrame, make_encoder: Callable[[], Encoder] = HashedEncoder) -> DataFrame:
    """Encode each chunk_id once and put the vector on all its copies.

    Worth its shuffle when the encoder is dear; copies of one text may be a large
    share of all rows, so the join back splits hot chunk_ids.
    """
    vectors = embed(distinct_content(chunks).select("chunk_id", "text"), make_encoder).drop("text")
    return skew_join(chunks, vectors, ["chunk_id"])


def not_yet_embedded(chunks: DataFrame, store: DataFrame) -> DataFrame:
    """Distinct chunk_ids the store lacks: the only rows a run has to encode."""
    return distinct_content(chunks).join(store.select("chunk_id"), "chunk_id", "left_anti")


def embedding_records(rows: DataFrame, model_id: str, model_version: str, embedded_at=None) -> DataFrame:
    """Records stamped with model, version, dimension and time."""
    return rows.select(
        T.content_key(F.col("text")).alias("id"),
        "text",
        "label",
        F.lit(model_id).alias("model_id"),
        F.lit(model_version).alias("model_version"),
        F.size("embedding").alias("dim"),
        (F.current_timestamp() if embedded_at is None else embedded_at).alias("embedded_at"),
    )


def tfidf_model(rows: DataFrame, dim: int = 1024):
    """Hashed term counts weighted by inverse document frequency, scaled to unit length."""
    return Pipeline(
        stages=[
            HashingTF(inputCol="terms", outputCol="_tf", numFeatures=dim),
            IDF(inputCol="_tf", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_vector"),
        ]
    ).fit(rows)


def embed_with_model(rows: DataFrame, model) -> DataFrame:
    """Adds ``embedding`` from a fitted Spark ML model that ends in ``_vector``."""
    vectors = model.transform(rows).withColumn("embedding", V.as_float32(vector_to_array("_vector")))
    return vectors.select(*rows.columns, "embedding")


def changed_vectors(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Two encoding runs compared: rows, largest component difference, rows that differ."""
    pairs = first.select(key, F.col("embedding").alias("_a")).join(
        second.select(key, F.col("embedding").alias("_b")), key
    )
    gap = F.array_max(F.zip_with("_a", "_b", lambda x, y: F.abs(x.cast("double") - y.cast("double"))))
    return pairs.select(gap.alias("_gap")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("_gap").alias("max_abs_diff"),
        F.count(F.when(F.col("_gap") > 0, 1)).alias("n_changed"),
    )
