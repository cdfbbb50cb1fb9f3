"""Phrases whose words stand together more often than apart: SON partitioning.

With S shards, a phrase that occurs ``support`` times in all occurs at least support/S times in
one of them. So each shard is mined completely at that support or a lower one, level by level (a phrase
can only be frequent if its two shorter ends are). Where t is the local support, a shard that doesn't name a phrase has it
t - 1 times at most; so the counts of the shards that do bound the total from above, and the union keeps only phrases
whose bound reaches ``support``. It becomes one bit map of bounded size, and a second pass counts every phrase in the map
exactly. Words are counted before, and a phrase with a globally rare word is never looked at.

Shards hold as much text as a task's memory allows, since fewer shards mean a higher local support. With
more shards than ``support`` the local support is one: every phrase of frequent words is then a candidate, and
the second pass counts them all, which is still exact.

Phrases are 64-bit hashes inside tasks; two texts with one hash are noticed and raised where they meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import hashed_runs, mixed, prepare, stored
from rankloom.scale import is_small, skew_join

SUPPORT = 30
LONGEST = 4
TOP = 2000
#: Bytes of text in a shard that are aimed at.
SHARD_BYTES = 48 << 20
#: Bits of a map of hashes, and bits of one of its segments.
MAP_BITS, SEGMENT_BITS = 27, 20
#: Bytes whose words are cut at once.
SLICE = 1 << 21

_KIND = np.zeros(256, np.int8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# ------------------------------------------------------------------------- words
class Words:
    """The words of one language in a shard: where they are, their hashes, and which are followed in their piece."""

    def __init__(self, language: str, texts: list[bytes]):
        self.language = language
        joined = b"\n".join(texts) + b"\n"
        texts.clear()  # a shard is large: what is read is let go
        self.data = _LOWER[np.frombuffer(joined, np.uint8)]
        del joined
        salt = int.from_bytes(language.encode("utf-8")[:64].ljust(8, b"\0"), "little") % (1 << 61)
        found: tuple[list, ...] = ([], [], [], [])
        at = 0
        while at < len(self.data):
            end = min(at + SLICE, len(self.data))
            if end < len(self.data):  # up to the end of a piece, so that nothing is cut in two
                seen, marks = at, np.zeros(0, np.int64)
                while not len(marks):
                    marks = np.flatnonzero(_KIND[self.data[seen:end]] == 2) + seen
                    seen, end = end, min(end + SLICE, len(self.data))
                end = int(marks[-1]) + 1
            for held, part in zip(found, self._cut(at, end, salt)):
                held.append(part)
            at = end
        self.starts, self.lengths, self.hashes, self.followed = (_together(x) for x in found)
        self.followed[-1:] = False

    def _cut(self, at: int, end: int, salt: int) -> tuple[np.ndarray, ...]:
        kind = _KIND[self.data[at:end]]
        starts, lengths, hashes = hashed_runs(self.data[at:end], kind == 0)
        marks = np.cumsum(kind == 2, dtype=np.int32)[starts]
        followed = np.zeros(len(starts), bool)
        followed[:-1] = marks[1:] == marks[:-1]
        return (starts + at).astype(np.int64 if len(self.data) >> 31 else np.int32), lengths, mixed(hashes, salt), followed

    def longer(self, keys: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words at ``at``, from those of one word less."""
        with np.errstate(over="ignore"):
            x = (keys * np.uint64(0xD1342543DE82EF95)) ^ self.hashes[at + size - 1]
            x *= np.uint64(0xBF58476D1CE4E5B9)
            return x ^ (x >> np.uint64(32))

    def phrases(self, at: np.ndarray, size: int) -> list[bytes]:
        """The words of the phrases at some places, with one space between them."""
        view, last = memoryview(self.data), at + size - 1
        ends = self.starts[last] + self.lengths[last]
        return [b" ".join(bytes(view[i:j]).split()) for i, j in zip(self.starts[at].tolist(), ends.tolist())]


def _together(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one array; they are let go."""
    out = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    parts.clear()
    return out


class Bits:
    """A set of hashes by their upper bits: it may hold others too, and never misses one."""

    def __init__(self, segments: list[tuple[int, bytes]], size: int):
        self.size = size
        self.bits = np.zeros(1 << (max(size, SEGMENT_BITS) - 3), np.uint8)
        for segment, bits in segments:
            at = segment << (SEGMENT_BITS - 3)
            self.bits[at : at + len(bits)] = np.frombuffer(bits, np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.size)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(different keys, counts, a place of each, count at each place)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    each = np.empty(len(keys), np.int32)
    each[order] = np.repeat(counts, counts)
    return ordered[first], counts, order[first], each


def _levels(words: Words, known: Bits, wanted: Bits | None, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, keys, counts, a place of each) of phrases of 1 to LONGEST words: those in ``wanted``, or those that occur ``least`` times.

    A phrase is looked at where both phrases of one word less, at its start and at its end, passed.
    """
    keys = words.hashes
    at = np.flatnonzero(known.holds(keys))
    keys = keys[at]
    for size in range(1, LONGEST + 1):
        if size > 1:
            good = np.zeros(len(words.hashes) + 1, bool)
            good[at] = True
            both = good[at + 1]
            if size == 2:
                both &= words.followed[at]
            at = at[both]
            keys = words.longer(keys[both], at, size)
            if wanted is not None:
                both = wanted.holds(keys)
                at, keys = at[both], keys[both]
        different, counts, places, each = _counted(keys)
        if wanted is None:
            kept = counts >= least
            different, counts, places = different[kept], counts[kept], places[kept]
        yield size, different, counts, at[places]
        if wanted is None and least > 1:
            at, keys = at[each >= least], keys[each >= least]


# ---------------------------------------------------------------------- in tasks
def _languages(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """The words of a shard, one language after the other."""
    held: dict[str, list[bytes]] = {}
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            held.setdefault(language, []).append(text)
    for language in list(held):
        yield Words(language, held.pop(language))


def _parts(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys; a bucket is a range of their upper 24 bits."""
    of = ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    edges = np.searchsorted(of, np.arange(buckets + 1))
    return [(i, edges[i], edges[i + 1]) for i in np.flatnonzero(np.diff(edges)).tolist()]


COUNTS = "lang string, bucket int, size int, keys binary, counts binary, has binary, texts binary"
_COUNTS = pa.schema(
    [("lang", pa.string()), ("bucket", pa.int32()), ("size", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("has", pa.binary()), ("texts", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _word_counts(buckets: int):
    """Each shard's count of every word; bucket -1 has its number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _languages(batches):
            keys, counts, _, _ = _counted(words.hashes)
            rows = [(words.language, i, 1, keys[a:b].tobytes(), counts[a:b].astype("<i8").tobytes(), None, None) for i, a, b in _parts(keys, buckets)]
            rows.append((words.language, -1, 0, None, None, None, str(len(words.hashes)).encode()))
            yield _batch(rows, _COUNTS)

    return run


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, sums, group of each entry) of a bucket."""
    keys = np.frombuffer(b"".join(rows.column("keys").to_pylist()), "<u8")
    counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<i8")
    different, group = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(different), np.int64)
    np.add.at(sums, group, counts)
    return different, sums, group


BITS = "segment int, places binary"
_BITS = pa.schema([("segment", pa.int32()), ("places", pa.binary())])


def _as_places(keys: np.ndarray, size: int) -> list[tuple[int, bytes]]:
    """(segment, places in it) of the keys' bits."""
    at = np.unique(keys >> np.uint64(64 - size)).astype(np.int64)
    edges = np.searchsorted(at >> SEGMENT_BITS, np.arange(_segments(size) + 1))
    low = (at & ((1 << SEGMENT_BITS) - 1)).astype("<u4")
    return [(i, low[edges[i] : edges[i + 1]].tobytes()) for i in np.flatnonzero(np.diff(edges)).tolist()]


def _at_least(least: int, size: int, allowance: int = 0):
    """The bits of the keys whose counts, each less ``allowance``, come to ``least`` together."""

    def run(rows: pa.Table) -> pa.Table:
        keys, sums, group = _summed(rows)
        sums -= allowance * np.bincount(group, minlength=len(keys))
        return pa.Table.from_batches([_batch(_as_places(keys[sums >= least], size), _BITS)])

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of a partition: all bits that any row sets."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if segment not in held:
                held[segment] = np.zeros(1 << SEGMENT_BITS, bool)
            held[segment][np.frombuffer(places, "<u4")] = True
    rows = [(s, np.packbits(x, bitorder="little").tobytes()) for s, x in held.items()]
    yield _batch(rows, _BITS)


def _nominations(known, least: int, buckets: int):
    """Each shard's count of every phrase that occurs ``least`` times in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _languages(batches):
            for size, keys, counts, _ in _levels(words, known.value, None, least):
                parts = _parts(keys, buckets) if size > 1 else []
                yield _batch([(words.language, i, size, keys[a:b].tobytes(), counts[a:b].astype("<i8").tobytes(), None, None) for i, a, b in parts], _COUNTS)

    return run


def _phrase_counts(known, wanted, least: int, buckets: int):
    """Each shard's count of every candidate, with the text of those that occur ``least`` times in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _languages(batches):
            for size, keys, counts, places in _levels(words, known.value, wanted.value if wanted else None, 1):
                rows, has = [], counts >= least
                for i, a, b in _parts(keys, buckets):
                    texts = words.phrases(places[a:b][has[a:b]], size)
                    rows.append((words.language, i, size, keys[a:b].tobytes(), counts[a:b].astype("<i8").tobytes(), np.packbits(has[a:b]).tobytes(), b"\n".join(texts)))
                yield _batch(rows, _COUNTS)

    return run


PHRASES = "lang string, phrase string, size int, f long"
_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])


def _frequent_phrases(support: int):
    def run(rows: pa.Table) -> pa.Table:
        _, sums, group = _summed(rows)
        text: dict[int, tuple[bytes, int]] = {}
        at = 0
        for size, keys, has, texts in zip(*(rows.column(c).to_pylist() for c in ("size", "keys", "has", "texts"))):
            n = len(keys) // 8
            mine = group[at : at + n][np.unpackbits(np.frombuffer(has, np.uint8), count=n).astype(bool)]
            at += n
            if not len(mine):
                continue
            frequent = np.flatnonzero(sums[mine] >= support).tolist()
            if not frequent:
                continue
            split = texts.split(b"\n")
            for i in frequent:
                if text.setdefault(int(mine[i]), (split[i], size)) != (split[i], size):
                    raise ValueError(f"two phrases share a hash: {split[i]!r} and {text[int(mine[i])][0]!r}")
        language = rows.column("lang")[0].as_py()
        return pa.Table.from_batches([_batch([(language, t.decode(), size, int(sums[g])) for g, (t, size) in text.items()], _PHRASES)])

    return run


# ----------------------------------------------------------------------- on Spark
def _segments(size: int) -> int:
    return 1 << max(0, size - SEGMENT_BITS)


def _map_of(places: DataFrame, size: int):
    """A broadcast map: 2^size bits, however many rows there are."""
    segments = places.repartition(_segments(size), "segment").mapInArrow(_united, BITS).collect()
    return places.sparkSession.sparkContext.broadcast(Bits([tuple(r) for r in segments], size))


def phrase_counts(
    docs: DataFrame, support: int = SUPPORT, shard_bytes: int = SHARD_BYTES, map_bits: int = MAP_BITS
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of up to LONGEST words that occur ``support`` times, (lang, n))."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    shards = max(size // shard_bytes + 1, min(cores, support // 2))
    found = texts.rdd.getNumPartitions()
    texts = texts.coalesce(shards) if found >= shards else texts.repartition(shards)
    # complete up to support/shards; half of that is taken, since it makes the bounds much closer
    least = max(1 + support // (2 * shards), 2) if shards < support else 1
    buckets = max(8, size // (16 << 20))
    counted = stored(texts.mapInArrow(_word_counts(buckets), COUNTS), "word-counts")
    by_bucket = counted.where("bucket >= 0").groupBy("lang", "bucket")
    known = _map_of(by_bucket.applyInArrow(_at_least(support, map_bits), BITS), map_bits)
    wanted = None
    if least > 1:
        named = texts.mapInArrow(_nominations(known, least, buckets), COUNTS).groupBy("lang", "bucket")
        bounded = named.applyInArrow(_at_least(support - shards * (least - 1), map_bits, least - 1), BITS)
        wanted = _map_of(bounded, map_bits)
    counts = texts.mapInArrow(_phrase_counts(known, wanted, least, buckets), COUNTS)
    frequent = stored(counts.groupBy("lang", "bucket").applyInArrow(_frequent_phrases(support), PHRASES), "phrases")
    n = F.sum(F.col("texts").cast("string").cast("long")).alias("n")
    return frequent, counted.where("bucket = -1").groupBy("lang").agg(n)


def collocations(
    docs: DataFrame, support: int = SUPPORT, top: int = TOP, share: int = 80, shard_bytes: int = SHARD_BYTES, map_bits: int = MAP_BITS
) -> DataFrame:
    """The ``top`` phrases of each language by how much their least bound cut holds together.

    Columns: lang, rank (from 1), phrase, a, l, r, n, score. A-Z are lower-cased; words end at spaces and tabs, and
    phrases don't cross ``.,;:!?`` or line ends. A candidate is dropped if a longer one that holds its words has
    ``share`` percent of its occurrences. Equal scores go by occurrences, then by the phrase's bytes.

    Null text counts as empty and null lang as ``und``. Rows are counted as they are, repeated ones too; doc_id
    is not used. A language without a frequent phrase has no row, nor has an empty table. Other columns are left out.
    """
    freq, totals = phrase_counts(docs, support, shard_bytes, map_bits)
    words = F.split("phrase", " ", -1)
    candidates = freq.where("size > 1").withColumn("w", words)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    small = is_small(freq)

    def with_count(left: DataFrame, part: str, name: str) -> DataFrame:
        right = freq.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        return left.join(F.broadcast(right), ["lang", part]) if small else skew_join(left, right, ["lang", part])

    cuts = with_count(with_count(cuts, "first", "l"), "rest", "r")
    score = F.expr("(cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    longer = candidates.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = longer.withColumn("i", F.explode(F.expr("sequence(1, size - m + 1)")))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), "f")
    held = inner.groupBy("lang", "phrase").agg(F.max("f").alias("held"))
    kept = least.join(held, ["lang", "phrase"], "left").where(
        f"held is null or cast(held as decimal(20,0)) * 100 < cast(cut.a as decimal(20,0)) * {share}"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order))
    ranked = ranked.where(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
