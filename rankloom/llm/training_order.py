"""Training-order materialisation: sequences in a keyed random order, in fixed-stride files.

Every task cuts its documents' ids into sequences. A keyed Feistel network over a
power of four, walked until it lands inside the number of sequences, is a
permutation: it gives each sequence its global slot with no sort and no table.
Sequences are then dealt by shard (a range of slots), sorted, and written by
Spark's own writer, one file for each shard. Record i of shard s starts at byte
i * stride, so a reader goes on from any slot by one seek; the last byte of a
record is a line end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import mixed, prepare, stored, texts_of
from rankloom.llm.packing import END, bases, encoder_of
from rankloom.scale import scratch_path

LENGTH = 1024
SHARD_ROWS = 2048
ROUNDS = 6
PAD = 0


def _network(x: np.ndarray, half: int, key: int, rounds: range) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    left, right = x >> shift, x & mask
    forward = rounds.step > 0
    for r in rounds:
        if forward:
            left, right = right, left ^ (mixed(right, key * 64 + r) & mask)
        else:
            left, right = right ^ (mixed(left, key * 64 + r) & mask), left
    return (left << shift) | right


def _walk(x: np.ndarray, size: int, key: int, rounds: range) -> np.ndarray:
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    x = _network(np.asarray(x, np.uint64), half, key, rounds)
    outside = np.flatnonzero(x >= size)
    while len(outside):
        x[outside] = _network(x[outside], half, key, rounds)
        outside = outside[x[outside] >= size]
    return x.astype(np.int64)


def slots(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """The slot of each sequence number: a permutation of 0 .. size-1."""
    return _walk(numbers, size, key, range(ROUNDS))


def numbers(at: np.ndarray, size: int, key: int) -> np.ndarray:
    """The sequence number in each slot: the way back."""
    return _walk(at, size, key, range(ROUNDS - 1, -1, -1))


def sequences(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, pad: int = PAD) -> DataFrame:
    """(part, idx, one, doc_id, doc_start, n_tokens, ids): each task's ids cut at ``length``.

    ids are unsigned 16-bit, padded to ``length`` (only a task's last sequence is). doc_id and doc_start tell what its
    first token is. The vocabulary must have at most 65,536 ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, idx = encoder_of(tokenizer, "<u2"), TaskContext.get().partitionId(), 0
        last, size, padding = np.array([end], "<u2").tobytes(), 2 * length, np.array([pad], "<u2").tobytes()
        held, first = b"", (None, 0)  # ids not yet in a sequence, and where their first token stands

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            names = ["part", "idx", "one", "doc_id", "doc_start", "n_tokens", "ids"]
            columns = list(zip(*found)) if found else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            found = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts_of(batch.column(1)))):
                ids += last
                if not held:
                    first = (doc, 0)
                at = size - len(held)  # where the next sequence begins in this document
                if len(ids) < at:
                    held += ids
                    continue
                found.append((part, idx, 1, *first, length, held + ids[:at]))
                idx += 1
                while at + size <= len(ids):
                    found.append((part, idx, 1, doc, at // 2, length, ids[at : at + size]))
                    idx, at = idx + 1, at + size
                held, first = ids[at:], (doc, at // 2)
            yield rows(found)
        if held:
            yield rows([(part, idx, 1, *first, len(held) // 2, held + padding * (length - len(held) // 2))])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        cut, "part int, idx long, one long, doc_id long, doc_start long, n_tokens int, ids binary"
    )


def materialise(
    docs: DataFrame, tokenizer: str, key: int = 20250, length: int = LENGTH, shard_rows: int = SHARD_ROWS, path: str | None = None
) -> tuple[str, DataFrame, int]:
    """Write the shards; returns their folder, (sequence, slot, doc_id, doc_start, n_tokens) and the number of sequences.

    The folder holds ``shard=<n>`` folders with one file each, in slot order. Null texts and
    empty documents are their end id alone. Repeated rows are written as often as they come.
    An empty table writes no shard. The same rows, partitions and key give the same files.
    """
    spark = prepare(docs.sparkSession)
    held = stored(sequences(docs, tokenizer, length), "sequences")
    total = held.count()
    path = path or scratch_path(spark, "training-order")

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the slots; ids go on compressed one by one (in the stored table whole pages are, which is tighter)."""
        packed = zstandard.ZstdCompressor(level=6).compress
        for batch in batches:
            if "ids" in batch.schema.names:
                ids = pa.array(map(packed, batch.column("ids").to_pylist()), pa.binary())
                batch = batch.set_column(batch.schema.get_field_index("ids"), "ids", ids)
            at = slots(batch.column("sequence").to_numpy(), total, key) if batch.num_rows else np.zeros(0, np.int64)
            yield batch.append_column("slot", pa.array(at, pa.int64()))

    placed = held.join(F.broadcast(bases(held, "one")), "part").withColumn("sequence", F.col("base") + F.col("idx"))
    described = placed.select("sequence", "doc_id", "doc_start", "n_tokens").mapInArrow(
        order, "sequence long, doc_id long, doc_start long, n_tokens int, slot long"
    )
    shards = max(1, -(-total // shard_rows))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each shard's records as one value; rows come in the order of shards and slots."""
        unpacked, shard, records = zstandard.ZstdDecompressor().decompress, None, []
        for batch in batches:
            for of, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if of != shard:
                    if records:
                        yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([b"\n".join(records)])], ["shard", "value"])
                    shard, records = of, []
                records.append(unpacked(ids))
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([b"\n".join(records)])], ["shard", "value"])

    dealt = (
        placed.select("sequence", "ids")
        .mapInArrow(order, "sequence long, ids binary, slot long")
        .select((F.col("slot") / shard_rows).cast("long").alias("shard"), "slot", "ids")
        .repartition(min(shards, 20_000), "shard")
        .sortWithinPartitions("shard", "slot")
        .select("shard", "ids")
        .mapInArrow(joined, "shard long, value binary")
        .select("shard", F.col("value").cast("string").alias("value"))
    )
    dealt.write.partitionBy("shard").text(path)
    return path, described, total


def digest(docs: DataFrame, tokenizer: str, key: int = 20250, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write the shards, then read the files back: one row for each record found at its byte offset."""
    spark = docs.sparkSession
    path, described, total = materialise(docs, tokenizer, key, length, shard_rows)
    stride = 2 * length + 1

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                view = memoryview(content.as_buffer())
                n = len(view) // stride
                found = [zlib.crc32(view[i * stride : (i + 1) * stride - 1]) for i in range(n)]
                at = np.arange(n)
                columns = [shard * shard_rows + at, np.full(n, shard), at * stride, np.array(found, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slot", "shard", "byte_offset", "ids_crc32"])

    if not total:
        return described.select("slot", F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("byte_offset"),
                                F.lit(0).cast("long").alias("ids_crc32"), "sequence", "doc_id", "doc_start", "n_tokens")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    shard = F.regexp_extract("path", r"shard=(\d+)", 1).cast("long").alias("shard")
    read = files.select(shard, "content").mapInArrow(records, "slot long, shard long, byte_offset long, ids_crc32 long")
    return read.join(described, "slot").select(
        "slot", "shard", "byte_offset", "ids_crc32", "sequence", "doc_id", "doc_start", "n_tokens"
    )
