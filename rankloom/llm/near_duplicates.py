"""Near duplicates by DartMinHash signatures, banded joining and an exact check.

A document is a weighted set: its five-word shingles, weighted by how often each
occurs. Every element is a column of unit-weight cells. Darts fall on the cells of
all columns by a Poisson process in (weight, rank) that depends on nothing but a
hash of the cell, so equal cells get equal darts in every document; a dart in a cell
that the weight covers in part counts if it falls into the covered part. Each dart
belongs to one of K coordinates, and a coordinate's minimum is its earliest dart.
Darts are thrown up to a rank that gives about K ln K + 2K of them, whatever the
size of the set, so a signature costs O(size + K log K). Two documents agree in a
coordinate with a probability equal to their weighted Jaccard similarity.

Bands of R coordinates are buckets. Buckets with the same members are one. What shares a bucket is compared until
every two members are linked, directly or through others, or were compared themselves: first one member with all,
then whoever is outside the largest class with all who are not in its own. So copies of one text cost a comparison
each, and no link is lost. The cells of a bucket's members come together in one task; a bucket of more than BLOCK
members is dealt into blocks, and each two blocks are a task. Comparison is exact, on the cells. Documents linked in
this way, directly or through others, form a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import Words, fresh, mixed, prepare, slices, stored, texts_of, without
from rankloom.scale import broadcast_if_small

SHINGLE = 5
SIMILAR = 0.8
#: A pair at similarity 0.8 shares none of 20 bands of 5 with probability 0.0004.
BANDS, ROWS = 20, 5
_K = BANDS * ROWS
_ID_BITS = 52
#: Members of a bucket that one task compares with each other; of two blocks in a larger bucket.
BLOCK = 1000


# -------------------------------------------------------------------- signatures
def shingles(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle): hashes of all runs of five words; a shorter text is one shingle."""
    h = words.hashes()
    starts = np.cumsum(words.count) - words.count
    step = np.uint64(0x9E3779B97F4A7C15)
    length = np.minimum(words.count, SHINGLE)
    windows = np.where(words.count > 0, words.count - length + 1, 0)
    doc = np.repeat(np.arange(texts), windows)
    first = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + starts[doc]
    out = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(SHINGLE):
            there = j < length[doc]
            at = np.minimum(first + j, max(len(h) - 1, 0))
            out = np.where(there, (out + h[at]) * step, out) if len(h) else out
    return doc, mixed(out, 5)


def weighted(doc: np.ndarray, elements: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, element, weight): distinct elements (52-bit) of each text with their counts. At most 4096 texts."""
    key = np.sort(doc.astype(np.uint64) << np.uint64(_ID_BITS) | elements >> np.uint64(64 - _ID_BITS))
    first = np.flatnonzero(np.diff(key, prepend=np.uint64(0) if not len(key) else key[0] ^ np.uint64(1)))
    weight = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(_ID_BITS)).astype(np.int64), key & np.uint64((1 << _ID_BITS) - 1), weight.astype(np.float64)


def cells(doc: np.ndarray, element: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, cell, covered): unit-weight cells of each element; the last may be covered in part."""
    count = np.ceil(weight).astype(np.int64)
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    with np.errstate(over="ignore"):
        cell = mixed(np.repeat(element, count) + number.astype(np.uint64) * np.uint64(0xD1342543DE82EF95), 1)
    return np.repeat(doc, count), cell, np.minimum(np.repeat(weight, count) - number, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(doc: np.ndarray, cell: np.ndarray, covered: np.ndarray, texts: int) -> np.ndarray:
    """(texts, K) earliest darts: rank in the upper 32 bits, the dart's own hash below. All ones where there is no cell."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(texts * _K, none, np.uint64)
    size = np.bincount(doc, covered, texts)
    limit = (_K * np.log(_K) + 2 * _K) / np.maximum(size, 1e-9)
    waiting = size > 0
    while waiting.any():
        alive = np.flatnonzero(waiting[doc])
        rank, throw = np.zeros(len(alive)), 0
        while len(alive):
            dart = mixed(cell[alive], 100 + throw)
            rank = rank - np.log(_unit(dart))
            inside = rank < limit[doc[alive]]
            alive, rank, dart = alive[inside], rank[inside], dart[inside]
            place = mixed(dart, 2)
            hit = _unit(place) < covered[alive]
            own = mixed(dart, 3)
            slot = doc[alive] * _K + (own % np.uint64(_K)).astype(np.int64)
            packed = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | own >> np.uint64(32)
            np.minimum.at(out, slot[hit], packed[hit])
            throw += 1
        waiting &= (out.reshape(texts, _K) == none).any(axis=1)  # a coordinate without a dart: throw further
        limit[waiting] *= 2
    return out.reshape(texts, _K)


def _prepared(texts: list[str]) -> tuple[Words, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    words = Words(texts)
    return words, cells(*weighted(*shingles(words, len(texts))))


def prints(words: Words, texts: int) -> np.ndarray:
    """Two 64-bit fingerprints of each text's sequence of words, and whether it has any."""
    h, place = words.hashes(), np.arange(len(words.doc)) - (np.cumsum(words.count) - words.count)[words.doc]
    of = np.zeros((3, texts), np.uint64)
    with np.errstate(over="ignore"):
        for salt in range(2):
            np.add.at(of[salt], words.doc, mixed(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 20 + salt))
    of[2] = words.count > 0
    return of


def signed(rows: DataFrame) -> DataFrame:
    """(id, f1, f2, darts): a fingerprint of the words' sequence and the K coordinates; null where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, darts = [np.zeros((3, 0), np.int64)], [np.zeros(0, np.int32)]
            for _, texts in slices(texts_of(batch.column(1))):
                words, cut = _prepared(texts)
                found.append(prints(words, len(texts)).view(np.int64))
                darts.append(mixed(signatures(*cut, len(texts)), 7).astype(np.uint32).view(np.int32).ravel())
            f1, f2, some = np.concatenate(found, axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(f1) + 1) * _K, pa.int32()), pa.array(np.concatenate(darts)))
            columns = [pa.array(f, mask=some == 0) for f in (f1, f2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, lists], ["id", "f1", "f2", "darts"])

    return rows.select("id", "text").mapInArrow(run, "id long, f1 long, f2 long, darts array<int>")


def with_cells(rows: DataFrame) -> DataFrame:
    """(id, cells): the sorted cells of each text as 32-bit hashes in bytes, by the texts' keys; copies once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            keys = [np.zeros(0, np.int64)]
            for _, texts in slices(texts_of(batch.column(0))):
                words, (doc, cell, _) = _prepared(texts)
                key = np.sort(doc.astype(np.uint64) << np.uint64(32) | cell >> np.uint64(32))
                ends = np.searchsorted(key >> np.uint64(32), np.arange(1, len(texts)))
                found += [part.astype("<u4").tobytes() for part in np.split(key, ends)]
                keys.append(prints(words, len(texts))[0].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(found, pa.binary())], ["id", "cells"])

    return rows.select("text").mapInArrow(run, "id long, cells binary").groupBy("id").agg(F.min("cells").alias("cells"))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays of cells."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared) if len(both) else 0.0


def linked(cells: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (positions) that connect all texts which similar pairs connect, without comparing what is connected already.

    In the end only the largest class has members that were not compared with all outside their class, and those
    outside have been: so every two texts of different classes were compared.
    """
    n = len(cells)
    if n == 2:
        return [(0, 1)] if similarity(*cells) >= SIMILAR else []
    sizes, of, done, found = np.array([len(c) for c in cells]), np.arange(n), np.zeros(n, bool), []
    while True:
        left = np.flatnonzero((of != np.bincount(of).argmax()) & ~done)
        if not len(left):
            return found
        i = left[0]
        done[i] = True
        others = np.flatnonzero((of != of[i]) & ~done & (np.minimum(sizes, sizes[i]) >= SIMILAR * np.maximum(sizes, sizes[i])))
        others = others[(sizes[others] > 0) & (sizes[i] > 0)]
        if not len(others):
            continue
        whose = np.repeat(np.arange(len(others)), sizes[others])
        theirs = np.concatenate([cells[j] for j in others])
        at = np.minimum(np.searchsorted(cells[i], theirs), sizes[i] - 1)
        shared = np.bincount(whose[cells[i][at] == theirs], minlength=len(others))
        for j in others[shared / (sizes[others] + sizes[i] - shared) >= SIMILAR]:
            if of[j] != of[i]:
                found.append((int(i), int(j)))
                of[of == of[j]] = of[i]


def links_within(members: DataFrame) -> DataFrame:
    """(a, b): links of the rows (bucket, i, j, id, cells) that lie together, sorted by the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple[int, int]]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

        def pairs() -> list[tuple[int, int]]:
            if len(ids) < 2:
                return []
            return [(min(ids[x], ids[y]), max(ids[x], ids[y])) for x, y in linked(cells)]

        place, ids, cells = None, [], []
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = [c.to_pylist() for c in batch.columns]
            for at, name, held in zip(zip(*columns[:3]), *columns[3:]):
                if at != place:
                    found += pairs()
                    place, ids, cells = at, [], []
                ids.append(name)
                cells.append(np.frombuffer(held, "<u4"))
            yield rows(found)
        yield rows(pairs())

    return members.select("bucket", "i", "j", "id", "cells").mapInArrow(run, "a long, b long")


# ------------------------------------------------------------------------ classes
def components(edges: DataFrame) -> DataFrame:
    """(id, class): the smallest id that each id is linked with, by rounds of smallest neighbours and shortcuts."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    known = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("class")), "classes")
    while True:
        offered = both.join(known.select(F.col("id").alias("b"), "class"), "b").groupBy(F.col("a").alias("id")).agg(F.min("class").alias("offer"))
        better = known.join(offered, "id").select("id", F.col("class").alias("before"), F.least("class", "offer").alias("class"))
        jump = known.select(F.col("id").alias("class"), F.col("class").alias("beyond"))
        better = stored(better.join(jump, "class").select("id", "before", F.least("class", "beyond").alias("class")), "classes")
        known = better.select("id", "class")
        if better.where(F.col("before") != F.col("class")).isEmpty():
            return known


def links(signed: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): similar pairs that connect each class. ``signed``: (id, first, darts), one row for each different text, with
    a document that holds it; ``texts``: (id, text) of the documents."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.xxhash64(j, F.slice("darts", j * ROWS + 1, ROWS)))
    every = signed.select("id", F.explode(bands).alias("bucket"))
    # buckets with the same members need to be looked at once
    marks = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    shared = every.groupBy("bucket").agg(F.count("*").alias("n"), *marks).where(F.col("n") > 1)
    shared = shared.groupBy("n", "mark0", "mark1").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = stored(every.join(shared, "bucket"), "bucket-members")
    named = broadcast_if_small(members.select("id").distinct().join(signed, "id").select(F.col("first").alias("named")).distinct())
    candidates = stored(with_cells(texts.join(named, F.col("id") == F.col("named"), "left_semi")), "candidate-cells")
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("id", F.lit(2)), blocks)
    with_others = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda other: other != F.col("own")),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")),
    )
    alone = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))
    placed = members.withColumn("own", own).select("id", "bucket", F.inline(F.when(blocks == 1, alone).otherwise(with_others)))
    together = placed.join(candidates, "id").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "id")
    return stored(links_within(together), "similar-pairs")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id), one for each row of ``docs`` (doc_id, text): class_id is the smallest id of its class.

    Texts with the same words in the same order, whatever their case and punctuation, are
    copies. Rows of one id are one document, so their texts' classes are joined. Null ids,
    null texts and texts without a word are alone in their classes. A text of fewer than
    five words is one shingle. Extra columns play no part.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    marked = stored(signed(rows), "signatures")
    real = marked.where(F.col("f1").isNotNull() & F.col("id").isNotNull())
    # one row for each different text: a copy adds nothing to the search, however many there are
    distinct = stored(real.groupBy(F.col("f1").alias("node")).agg(F.min("id").alias("first"), F.min_by("darts", "id").alias("darts")), "texts")
    of_text = real.select("id", F.col("f1").alias("node")).distinct()
    # an id with several texts joins their classes
    one = of_text.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("a")).where(F.col("a") != F.col("b")).select("id", "b")
    several = stored(of_text.join(one, "id").where(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b"), "joined-texts")
    edges = links(distinct.select(F.col("node").alias("id"), "first", "darts"), rows.where(F.col("id").isNotNull()))
    joined = stored(components(edges.unionByName(several)).withColumnRenamed("id", "node"), "classes")
    smallest = joined.join(distinct, "node").groupBy("class").agg(F.min("first").alias("class_id"))
    named = joined.join(broadcast_if_small(smallest), "class").select("node", "class_id")
    alone = distinct.join(named.select("node"), "node", "left_anti").select("node", F.col("first").alias("class_id"))
    known = of_text.join(named.unionByName(alone), "node").groupBy("id").agg(F.min("class_id").alias("class_id"))
    return marked.select("id").join(known, "id", "left").select(F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their class: the document with the smallest id, all columns kept.

    Rows with a null id, and documents without words, all stay. Of several rows with the id
    that stays, the one with the smallest text does.
    """
    others = classes(docs).where(F.col("doc_id") != F.col("class_id")).select("doc_id")
    left = without(docs, docs["doc_id"].cast("long"), others)
    key = left["doc_id"].cast("long")
    again = left.groupBy(key.alias("id")).count().where((F.col("count") > 1) & F.col("id").isNotNull()).select("id")
    name = fresh(docs, "again")
    again = broadcast_if_small(again.toDF(name))
    repeated = left.join(again, key == F.col(name), "left_semi")
    place = fresh(docs, "place")
    order = Window.partitionBy(F.col("doc_id").cast("long")).orderBy(F.col("text").cast("string"))
    chosen = repeated.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return left.join(again, key == F.col(name), "left_anti").unionByName(chosen)
