"""Passages that an earlier document holds already, found with suffix arrays built in shards.

A window is a string of ``length`` bytes. Every window belongs to the smallest hash among its
24-byte grams (its minimizer), so equal windows belong to the same one wherever they stand, and
neighbouring windows mostly share theirs: a run of them is one stretch of text. Four steps:

1. Documents are stored in blocks of about a megabyte.
2. Blocks send their minimizers, once each, to buckets of hash values, which answer with two
   bits each: held by more than one document, and held by very many.
3. Blocks send the different stretches of such minimizers to shards, which are chosen by the
   minimizer, or by the window for very frequent ones, so that no common passage fills a shard.
   A shard sorts its stretches with an induced suffix array, takes windows to be equal where
   neighbours share ``length`` bytes (permuted common prefixes), and answers with one bit a window:
   a document with a smaller id than any of that block's holds it. A stretch whose minimizer
   stands in no other stretch meets nobody and is left out of the array.
4. Blocks mark the windows and cut them out.

A window whose minimizer has one document stands nowhere else: leaving it out loses nothing.
Python sees one block, bucket or shard at a time, each of bounded size; what is
exchanged are packed arrays.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import mixed, prepare, stored
from rankloom.llm.suffix_array import permuted_common_prefixes, suffix_array

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 1 << 20
#: Minimizers of a bucket and bytes of a shard that are aimed at.
BUCKET_KEYS, SHARD_BYTES = 2_000_000, 2_000_000
#: A minimizer that more documents hold has its windows dealt one by one.
HOT_DOCUMENTS = 50_000
#: Windows of a stretch; longer runs of one minimizer are repetitions and cut at multiples.
MOST_WINDOWS = 512
#: Positions that are worked on at once, so that arrays stay in the processor's cache.
SLICE = 1 << 16
_NO_ID = np.iinfo(np.int64).max

ROWS = "block long, bucket int, kind int, a binary, b binary, c binary"


# ------------------------------------------------------------------------ blocks
def _blocks(block_bytes: int):
    """One row for some documents: a their ids, b their ends in the text, c the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        pack = zstandard.ZstdCompressor(level=3)
        ids, ends, texts, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            held = [
                pa.array([first + made], pa.int64()), pa.array([0], pa.int32()), pa.array([0], pa.int32()),
                pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([np.array(ends, "<i8").tobytes()], pa.binary()),
                pa.array([pack.compress(b"".join(texts))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(held, ["block", "bucket", "kind", "a", "b", "c"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text = text or b""
                ids.append(_NO_ID if doc is None else doc)
                size += len(text)
                ends.append(size)
                texts.append(text)
                if size >= block_bytes or len(ids) >= block_bytes // 64:
                    yield row()
                    made += 1
                    ids, ends, texts, size = [], [], [], 0
        if ids:
            yield row()

    return run


class Block:
    """The documents of a block and the runs of windows that share a minimizer."""

    def __init__(self, a: bytes, b: bytes, c: bytes, length: int):
        self.ids, self.ends, self.length = np.frombuffer(a, "<i8"), np.frombuffer(b, "<i8"), length
        self.text = zstandard.ZstdDecompressor().decompress(c)
        self.data = np.frombuffer(self.text, np.uint8)
        self.begins = np.concatenate(([0], self.ends[:-1]))
        self.starts, self.counts, minima = self._runs()
        self.keys = mixed(minima)
        self.doc = np.searchsorted(self.ends, self.starts, side="right")
        self.distinct, self.key_of, self.documents = self._distinct()

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, length = len(self.data), self.length
        if n < length:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        valid = np.ones(n, bool)
        for begin, end, doc in zip(self.begins.tolist(), self.ends.tolist(), self.ids.tolist()):
            valid[begin if doc == _NO_ID else max(begin, end - length + 1) : end] = False
        found = []
        for at in range(0, n - length + 1, SLICE):
            part = self.data[at : at + SLICE + length - 1]
            minima = minimizers(part, length)
            good = valid[at : at + len(minima)]
            new = good.copy()
            new[1:] &= (minima[1:] != minima[:-1]) | ~good[:-1]
            starts = np.flatnonzero(new)
            edges = np.append(np.flatnonzero(new | ~good), len(minima))
            counts = edges[np.searchsorted(edges, starts, side="right")] - starts
            keys = minima[starts]
            if len(counts) and counts.max() > MOST_WINDOWS:
                pieces = -(-counts // MOST_WINDOWS)
                nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                starts = np.repeat(starts, pieces) + nth * MOST_WINDOWS
                counts = np.minimum(np.repeat(counts, pieces) - nth * MOST_WINDOWS, MOST_WINDOWS)
                keys = np.repeat(keys, pieces)
            found.append((starts + at, counts, keys))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the block's keys in order, each run's place among them, documents of each)."""
        order = np.argsort(self.keys, kind="stable")
        keys, ids = self.keys[order], self.doc[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        place = np.cumsum(new) - 1
        back = np.empty(len(keys), np.int64)
        back[order] = place
        another = new.copy()
        another[1:] |= self.ids[ids[1:]] != self.ids[ids[:-1]]
        return keys[new], back, np.bincount(place[another], minlength=int(new.sum()))

    def stretches(self, flags: np.ndarray, shards: int) -> Iterator[tuple[int, "Stretches"]]:
        """For each shard its different stretches, by the buckets' answers on this block's keys."""
        flag = flags[self.key_of]
        cold, hot = np.flatnonzero(flag == 1), np.flatnonzero(flag > 1)
        to = (mixed(self.keys[cold], 1) % np.uint64(shards)).astype(np.int64)
        # a hot run goes window by window
        start = np.repeat(self.starts[hot], self.counts[hot]) + _counting(self.counts[hot])
        windows = (self.text[i : i + self.length] for i in start.tolist())
        to = np.concatenate((to, np.fromiter((zlib.crc32(w) % shards for w in windows), np.int64, len(start))))
        count = np.concatenate((self.counts[cold], np.ones(len(start), np.int64)))
        doc = self.ids[np.concatenate((self.doc[cold], np.repeat(self.doc[hot], self.counts[hot])))]
        start = np.concatenate((self.starts[cold], start))
        order = np.argsort(to, kind="stable")
        to, start, count, doc = to[order], start[order], count[order], doc[order]
        edges = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
        text = self.text
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            ends = start[a:b] + (count[a:b] + (self.length - 1))
            place: dict[bytes, int] = {}
            at = [place.setdefault(text[i:j], len(place)) for i, j in zip(start[a:b].tolist(), ends.tolist())]
            least = np.full(len(place), _NO_ID, np.int64)
            np.minimum.at(least, at, doc[a:b])
            yield int(to[a]), Stretches(list(place), least, np.array(at), start[a:b], count[a:b], doc[a:b])


@dataclass
class Stretches:
    """Different strings with the smallest id that holds each; for each run its string, its windows and its document."""

    strings: list[bytes]
    least: np.ndarray
    at: np.ndarray
    start: np.ndarray
    count: np.ndarray
    doc: np.ndarray


def minimizers(data: np.ndarray, length: int, gram: int = GRAM) -> np.ndarray:
    """For each window of ``length`` bytes the smallest hash of its grams."""
    n = len(data)
    gram = min(gram, length)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.ndarray((n,), "<u8", padded, strides=(1,))
    count = n - gram + 1
    whole, rest = divmod(gram, 8)
    with np.errstate(over="ignore"):
        hashes = np.zeros(count, np.uint64)
        for i in range(whole):
            hashes = (hashes + words[8 * i : 8 * i + count]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
            hashes ^= hashes >> np.uint64(31)
        if rest:
            hashes = (hashes + (words[8 * whole : 8 * whole + count] & np.uint64((1 << 8 * rest) - 1))) * np.uint64(0xD1342543DE82EF95)
            hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
    wide, wanted = 1, length - gram + 1
    while wide < wanted:
        step = min(wide, wanted - wide)
        hashes = np.minimum(hashes[:-step], hashes[step:])
        wide += step
    return hashes


# ----------------------------------------------------------------------- buckets
def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x.astype(bool)).tobytes()


def _unbits(x: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x, np.uint8), count=n)


def _five(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(x, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the keys' upper 24 bits, so sorted keys lie in bucket order."""
    of = ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    return np.searchsorted(of, np.arange(buckets + 1))


def _keys_out(buckets: int, length: int):
    """kind 1, for each bucket of a block: a the keys' lower 40 bits, b how many documents hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["a"], row["b"], row["c"], length)
                edges = _bucket_edges(block.distinct, buckets)
                full = np.flatnonzero(np.diff(edges))
                held = np.minimum(block.documents, 65535).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(full), pa.int64()), pa.array(full, pa.int32()), pa.array([1] * len(full), pa.int32()),
                        pa.array([_five(block.distinct[edges[i] : edges[i + 1]]) for i in full], pa.binary()),
                        pa.array([held[edges[i] : edges[i + 1]].tobytes() for i in full], pa.binary()), pa.nulls(len(full), pa.binary()),
                    ],
                    ["block", "bucket", "kind", "a", "b", "c"],
                )

    return run


def _judge_keys(hot: int):
    """kind 2, the answer to each block: a bits of repeated keys, b bits of hot ones, c in digits how many repeated ones the bucket has."""

    def run(rows: pa.Table) -> pa.Table:
        sent = rows.column("a").to_pylist()
        keys, sizes = _from_five(b"".join(sent)), np.array([len(x) // 5 for x in sent])
        held = np.frombuffer(b"".join(rows.column("b").to_pylist()), "<u2").astype(np.int64)
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = np.diff(keys[order]) != 0
        total = np.add.reduceat(held[order], np.flatnonzero(new)) if len(keys) else held
        documents = np.empty(len(keys), np.int64)
        documents[order] = total[np.cumsum(new) - 1]
        ends = np.cumsum(sizes)
        parts = [documents[e - n : e] for e, n in zip(ends, sizes)]
        repeated = str(int((total > 1).sum())).encode()
        return pa.table(
            [
                rows.column("block"), rows.column("bucket"), pa.array([2] * len(parts), pa.int32()),
                pa.array([_bits(x > 1) for x in parts], pa.binary()), pa.array([_bits(x > hot) for x in parts], pa.binary()),
                pa.array([repeated] + [None] * (len(parts) - 1), pa.binary()),
            ],
            ["block", "bucket", "kind", "a", "b", "c"],
        )

    return run


def _opened(rows: pa.Table, buckets: int, length: int) -> tuple[Block, list[dict], np.ndarray] | None:
    """(block, its other rows in bucket order, flag of each of its keys)."""
    rows = sorted(rows.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
    if not rows or rows[0]["kind"] != 0:
        return None
    block = Block(rows[0]["a"], rows[0]["b"], rows[0]["c"], length)
    edges = _bucket_edges(block.distinct, buckets)
    flags = np.zeros(len(block.distinct), np.int8)
    for row in rows:
        if row["kind"] == 2:
            i, j = edges[row["bucket"]], edges[row["bucket"] + 1]
            flags[i:j] = _unbits(row["a"], j - i) + _unbits(row["b"], j - i)
    return block, rows, flags


# ------------------------------------------------------------------------ shards
def _stretches_out(buckets: int, shards: int, length: int):
    """kind 3, for each shard of a block: a lengths, b the strings, c the smallest id that holds each."""

    def run(rows: pa.Table) -> pa.Table:
        opened, out = _opened(rows, buckets, length), []
        pack = zstandard.ZstdCompressor(level=1)
        if opened:
            block, held, flags = opened
            for shard, some in block.stretches(flags, shards):
                lengths = np.array([len(s) for s in some.strings], "<u2").tobytes()
                out.append((held[0]["block"], shard, 3, lengths, pack.compress(b"".join(some.strings)), some.least.astype("<i8").tobytes()))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        columns = zip(*out) if out else [[]] * 6
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "bucket", "kind", "a", "b", "c"])

    return run


def least_of_windows(strings: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, ends): for each window of each string the smallest of ``least`` among the strings that hold it.

    ``ends`` are the windows' ends by string; the strings are all different.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    windows = sizes - length + 1
    out = np.repeat(least, windows)
    data = np.frombuffer(b"".join(strings), np.uint8)
    begins = np.cumsum(sizes) - sizes
    minima = minimizers(data, length)[begins]  # a string's windows share their minimizer
    order = np.argsort(minima, kind="stable")
    same = np.zeros(len(strings), bool)
    equal = minima[order[1:]] == minima[order[:-1]]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    meeting = np.flatnonzero(same)
    if not len(meeting):
        return out, np.cumsum(windows)
    text = np.frombuffer(b"".join(strings[i] + b"\xff" for i in meeting), np.uint8)
    text = np.append(np.where(text == 255, 1, text + 2), 0).astype(np.uint8)  # UTF-8 has no byte above 244
    array = suffix_array(text)
    shared = permuted_common_prefixes(text, array, length)
    places = np.cumsum(sizes[meeting] + 1) - sizes[meeting] - 1
    inside = np.zeros(len(text), np.int64)
    owner = np.full(len(text), -1, np.int64)
    starts = np.repeat(places, windows[meeting]) + _counting(windows[meeting])
    owner[starts] = np.repeat(meeting, windows[meeting])
    inside[starts] = _counting(windows[meeting])
    sorted_ = array[owner[array] >= 0]
    group = np.flatnonzero(shared[sorted_] < length)
    if not len(group) or group[0] != 0:
        group = np.insert(group, 0, 0)
    value = np.minimum.reduceat(least[owner[sorted_]], group)
    first = np.cumsum(windows) - windows
    out[first[owner[sorted_]] + inside[sorted_]] = np.repeat(value, np.diff(np.append(group, len(sorted_))))
    return out, np.cumsum(windows)


def _counting(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(counts.sum())) - np.repeat(ends - counts, counts)


def _judge_stretches(length: int):
    """kind 4, the answer to each block: a bits of the windows that a document before this block's holds."""

    def run(rows: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        asked, sent_least = [], []
        for row in rows.select(["a", "b", "c"]).to_pylist():
            body, sizes = zstandard.ZstdDecompressor().decompress(row["b"]), np.frombuffer(row["a"], "<u2").astype(np.int64)
            ends = np.cumsum(sizes).tolist()
            begins = [0, *ends[:-1]]
            asked.append(np.array([place.setdefault(body[i:j], len(place)) for i, j in zip(begins, ends)], np.int64))
            sent_least.append(np.frombuffer(row["c"], "<i8"))
        least = np.full(len(place), _NO_ID, np.int64)
        np.minimum.at(least, np.concatenate(asked), np.concatenate(sent_least))
        strings = list(place)
        found, ends = least_of_windows(strings, least, length)
        windows = np.diff(ends, prepend=0)
        bits = []
        for which, mine in zip(asked, sent_least):
            at = np.repeat(ends[which] - windows[which], windows[which]) + _counting(windows[which])
            bits.append(_bits(found[at] < np.repeat(mine, windows[which])))
        return pa.table(
            [
                rows.column("block"), rows.column("bucket"), pa.array([4] * len(bits), pa.int32()),
                pa.array(bits, pa.binary()), pa.nulls(len(bits), pa.binary()), pa.nulls(len(bits), pa.binary()),
            ],
            ["block", "bucket", "kind", "a", "b", "c"],
        )

    return run


# ------------------------------------------------------------------------ result
RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
     ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())]
)


def _cut_out(buckets: int, shards: int, length: int, with_text: bool):
    def run(rows: pa.Table) -> pa.Table:
        opened = _opened(rows, buckets, length)
        if opened is None:
            return RESULT.empty_table()
        block, rows, flags = opened
        covered = np.zeros(len(block.data) + 1, np.int32)
        answers = {r["bucket"]: r["a"] for r in rows if r["kind"] == 4}
        for shard, some in block.stretches(flags, shards):
            sizes = np.array([len(s) for s in some.strings], np.int64) - length + 1
            bits = _unbits(answers[shard], int(sizes.sum())).astype(bool)
            first, count = np.cumsum(sizes) - sizes, some.count
            step = _counting(count)
            gone = bits[np.repeat(first[some.at], count) + step] | np.repeat(some.least[some.at] < some.doc, count)
            where = (np.repeat(some.start, count) + step)[gone]
            covered[where] += 1  # a window has one run, so no place comes twice
        marks = np.flatnonzero(covered)
        covered[marks + length] -= 1
        inside = np.cumsum(covered)[:-1] > 0
        out: dict[str, list] = {name: [] for name in RESULT.names}
        for doc, begin, end in zip(block.ids.tolist(), block.begins.tolist(), block.ends.tolist()):
            mask = inside[begin:end]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            text = block.text[begin:end]
            if len(edges):
                text = block.data[begin:end][~mask].tobytes()
            out["doc_id"].append(None if doc == _NO_ID else doc)
            out["n_bytes"].append(end - begin)
            out["n_removed"].append(end - begin - len(text))
            out["n_spans"].append(len(edges) // 2)
            out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
            out["spans"].append(edges.reshape(-1, 2).tolist())
            out["kept"].append(text if with_text else None)
        return pa.table([pa.array(out[f.name], f.type) for f in RESULT], schema=RESULT)

    return run


def repeated_passages(
    docs: DataFrame, length: int = LENGTH, with_text: bool = False, hot: int = HOT_DOCUMENTS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """For each row of ``docs`` the bytes that lie in a ``length``-byte string which also starts in a document with a smaller id.

    Columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (begin and end of each removed
    run), and kept, the remaining bytes, with ``with_text``. They may end inside a character.

    Null text counts as empty. Rows with a null doc_id lose nothing and cost others nothing. Rows that
    share a doc_id are one document's for the comparison, so they don't cost each other anything, and give a
    row each. Texts shorter than ``length`` stay whole. An empty table gives no rows. Other columns are left out.
    """
    if not 8 <= length <= 65_000 - MOST_WINDOWS:
        raise ValueError("length must be from 8 to 64,488")
    prepare(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stored(named.mapInArrow(_blocks(block_bytes), ROWS), "passage-blocks")
    size = blocks.agg(F.sum(F.expr("length(c)")).alias("packed"), F.count(F.lit(1)).alias("n")).first()
    packed = size["packed"] or 0
    buckets = max(8, packed // (4 * BUCKET_KEYS))  # a stored byte stands for two and a half; one in 13 begins a run
    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, packed // (16 << 20))
    sent = blocks.mapInArrow(_keys_out(buckets, length), ROWS)
    answers = stored(sent.groupBy("bucket").applyInArrow(_judge_keys(hot), ROWS), "passage-keys")
    repeated = answers.agg(F.sum(F.col("c").cast("string").cast("long"))).first()[0] or 0
    shards = max(8, repeated * (length + 30) // SHARD_BYTES)
    known = blocks.unionByName(answers)
    strings = known.repartition(tasks, "block").groupBy("block").applyInArrow(_stretches_out(buckets, shards, length), ROWS)
    judged = stored(strings.groupBy("bucket").applyInArrow(_judge_stretches(length), ROWS), "passage-windows")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>, kept binary"
    whole = known.unionByName(judged).repartition(tasks, "block").groupBy("block")
    return whole.applyInArrow(_cut_out(buckets, shards, length, with_text), result)
