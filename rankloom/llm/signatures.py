"""Ranked search by bit-sliced Bloom signatures: bounds first, exact scores for what they don't exclude.

Documents lie in blocks. A block has a matrix of bits with a column for each document; a term sets
a few rows in its document's column, and again other rows for each level of occurrences
it reaches (1, 2, 3, 5 ...). The rows are stored as slices, one bit a document, so "which documents may hold this term so often"
is the intersection of a few slices. False bits only add. Summing, over an item's terms, the weight
times the most that a document of this length can score at that level bounds every document's score from above.
A task goes through its blocks with the best scores so far: documents whose bound is below an item's k-th best
are provably not among the best; all others are scored exactly from their text.

Items are taken in blocks of bounded size, so what is broadcast is bounded too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import hashed_runs, mixed, prepare, stored

TOP = 50
#: Occurrences from which a term has a level of its own.
LEVELS = (1, 2, 3, 5, 9)
#: Rows that a term sets at each level, and the share of set bits that is aimed at.
ROWS_SET, DENSITY = 3, 0.18
#: Documents and bytes of text of a block, and bytes that a task orders by length before it cuts blocks.
BLOCK_DOCS, BLOCK_BYTES, ORDERED_BYTES = 2048, 2 << 20, 16 << 20
#: Items and terms of a block of items.
ITEMS, ITEM_TERMS = 2000, 100_000
#: Documents whose occurrences are laid out at once.
SCORED_AT_ONCE = 512

_WORD = np.zeros(256, bool)
_WORD[128:] = True
for _range in ("09", "AZ", "az"):
    _WORD[ord(_range[0]) : ord(_range[1]) + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, number of terms of each text); terms are runs of letters, digits and other characters above ASCII."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    starts, _, hashes = hashed_runs(data, _WORD[data])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


# ------------------------------------------------------------------------- index
INDEX = "block long, ids binary, counts binary, rows long, slices binary, keys binary, df binary, ends binary, text binary"
_INDEX = pa.schema(
    [("block", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()), ("rows", pa.int64()), ("slices", pa.binary()),
     ("keys", pa.binary()), ("df", pa.binary()), ("ends", pa.binary()), ("text", pa.binary())]
)
_NO_ID = np.iinfo(np.int64).max


def rows_of(hashes: np.ndarray, level: int, rows: int) -> np.ndarray:
    """The rows that terms set at a level: (terms, ROWS_SET)."""
    salt = level * ROWS_SET
    return np.stack([(mixed(hashes, salt + j) % np.uint64(rows)).astype(np.int64) for j in range(ROWS_SET)], axis=1)


def _block_row(number: int, ids: list[int], texts: list[bytes]) -> tuple:
    hashes, counts = terms_of(texts)
    ends = np.cumsum(counts)
    found = [np.unique(hashes[e - n : e], return_counts=True) for e, n in zip(ends.tolist(), counts.tolist())]
    doc = np.repeat(np.arange(len(ids)), [len(x) for x, _ in found])
    keys, often = (np.concatenate(x) for x in zip(*found))
    per_level = [np.flatnonzero(often >= least) for least in LEVELS]
    entries = sum(map(len, per_level)) / len(ids)
    rows = max(64, int(entries * ROWS_SET / DENSITY))
    bits = np.zeros((rows, len(ids)), bool)
    for level, at in enumerate(per_level):
        places = rows_of(keys[at], level, rows)
        for j in range(ROWS_SET):
            bits[places[:, j], doc[at]] = True
    known, df = np.unique(keys, return_counts=True)
    pack = zstandard.ZstdCompressor(level=3)
    lengths = np.cumsum([len(t) for t in texts])
    return (
        number, np.array(ids, "<i8").tobytes(), counts.astype("<i8").tobytes(), rows, np.packbits(bits, axis=1).tobytes(),
        known.tobytes(), df.astype("<u4").tobytes(), lengths.astype("<i8").tobytes(), pack.compress(b"".join(texts)),
    )


def _indexed(block_docs: int, ordered_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, bytes]] = []
        size = 0

        def blocks() -> Iterator[pa.RecordBatch]:
            nonlocal number
            held.sort(key=lambda x: len(x[1]))  # alike in length: alike in the rows they need
            at = 0
            while at < len(held):
                end, of = at, 0
                while end < len(held) and end - at < block_docs and (end == at or of + len(held[end][1]) <= BLOCK_BYTES):
                    of += len(held[end][1])
                    end += 1
                row = _block_row(number, [d for d, _ in held[at:end]], [t for _, t in held[at:end]])
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _INDEX)], schema=_INDEX)
                number, at = number + 1, end

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                held.append((_NO_ID if doc is None else doc, text))
                size += len(text)
                if size >= ordered_bytes or len(held) >= 64 * block_docs:
                    yield from blocks()
                    held, size = [], 0
        if held:
            yield from blocks()

    return run


def index(docs: DataFrame, block_docs: int = BLOCK_DOCS, ordered_bytes: int = ORDERED_BYTES) -> DataFrame:
    """Blocks of signatures with what exact scores need; stored once and read for every block of items."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(texts.where("text is not null").mapInArrow(_indexed(block_docs, ordered_bytes), INDEX), "signatures")


# ------------------------------------------------------------------------- items
@dataclass
class Items:
    """A block of items: the terms of each, as places among ``terms``."""

    ids: list[int]
    terms: np.ndarray
    of: list[np.ndarray]
    weights: np.ndarray
    documents: int = 0
    length: int = 0


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items in order of their ids, a block at a time; rows with one id are one item, null ids and texts are none."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    held: dict[int, set[int]] = {}
    size = 0

    def block() -> Items:
        terms = np.array(sorted(set().union(*held.values())), np.uint64)
        of = [np.searchsorted(terms, np.array(sorted(t), np.uint64)) for t in held.values()]
        return Items(list(held), terms, of, np.zeros(len(terms), np.int64))

    for row in texts.orderBy("item_id").toLocalIterator():
        found = set(terms_of([row["text"].encode("utf-8", "replace")])[0].tolist())
        if held and row["item_id"] not in held and (len(held) >= ITEMS or size + len(found) > ITEM_TERMS):
            yield block()
            held, size = {}, 0
        held.setdefault(row["item_id"], set()).update(found)
        size += len(found)
    if held:
        yield block()


def _frequencies(asked):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = asked.value
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for keys, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, df = np.frombuffer(keys, "<u8"), np.frombuffer(df, "<u4")
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, terms), len(keys) - 1)
                    total += np.where(keys[at] == terms, df[at], 0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["term", "df"])

    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([int((counts > 0).sum())], pa.int64()), pa.array([int(counts.sum())], pa.int64())], ["documents", "length"])


# ------------------------------------------------------------------------ search
def share(often: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What ``often`` occurrences are worth in documents whose length gives ``norm``, before the term's weight."""
    return (1_000_000_000 * often) // (1000 * often + 20 * norm)


class _Best:
    """The k best (score, doc_id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * items
        self.docs = [np.zeros(0, np.int64)] * items

    def least(self, item: int) -> int:
        return int(self.scores[item][-1]) if len(self.scores[item]) >= self.k else 1

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        good = (scores > 0) & (docs != _NO_ID)
        scores, docs = np.concatenate((self.scores[item], scores[good])), np.concatenate((self.docs[item], docs[good]))
        order = np.lexsort((docs, -scores))[: self.k]
        self.scores[item], self.docs[item] = scores[order], docs[order]


class Block:
    """One block, opened for a block of items."""

    def __init__(self, row: dict, items: Items):
        self.items, self.ids = items, np.frombuffer(row["ids"], "<i8")
        counts = np.frombuffer(row["counts"], "<i8")
        self.norm = 50 + (50 * counts * items.documents) // items.length
        self.rows = row["rows"]
        self.slices = np.frombuffer(row["slices"], np.uint8).reshape(self.rows, -1)
        self.packed, self.ends = row["text"], np.frombuffer(row["ends"], "<i8")
        self.text: bytes | None = None
        # the most that a document can score at each level, as steps from the level before
        most = [share(np.full(len(counts), up - 1), self.norm) for up in LEVELS[1:]] + [share(np.maximum(counts, 1), self.norm)]
        self.steps = [np.maximum(b - a, 0).astype(np.float64) for a, b in zip([np.zeros(len(counts), np.int64), *most[:-1]], most)]

    def bounds(self) -> Iterator[np.ndarray]:
        """For each item the upper bounds of all documents' scores (sums stay far below 2^53, so they are exact)."""
        n = len(self.ids)
        worth = np.zeros((len(self.items.terms), n))
        for level, step in enumerate(self.steps):
            places = rows_of(self.items.terms, level, self.rows)
            held = self.slices[places[:, 0]]
            for j in range(1, ROWS_SET):
                held = held & self.slices[places[:, j]]
            some = np.flatnonzero(held.any(axis=1))
            worth[some] += np.unpackbits(held[some], axis=1, count=n) * step
        for terms in self.items.of:
            yield self.items.weights[terms].astype(np.float64) @ worth[terms]

    def scores(self, wanted: list[np.ndarray]) -> list[np.ndarray]:
        """Exact scores of the wanted documents of each item, from the documents' texts."""
        out = [np.zeros(len(w), np.int64) for w in wanted]
        asked = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
        if not len(asked):
            return out
        if self.text is None:
            self.text = zstandard.ZstdDecompressor().decompress(self.packed)
        terms, begins = self.items.terms, np.concatenate(([0], self.ends[:-1]))
        for at in range(0, len(asked), SCORED_AT_ONCE):
            some = asked[at : at + SCORED_AT_ONCE]
            hashes, counts = terms_of([self.text[begins[d] : self.ends[d]] for d in some])
            place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            held = terms[place] == hashes
            doc = np.repeat(np.arange(len(some)), counts)[held]
            often = np.bincount(doc * len(terms) + place[held], minlength=len(some) * len(terms)).reshape(len(some), -1)
            for item, docs in enumerate(wanted):
                mine = np.flatnonzero((docs >= some[0]) & (docs <= some[-1]))
                if len(mine):
                    own = self.items.of[item]
                    tf = often[np.searchsorted(some, docs[mine])][:, own]
                    out[item][mine] = share(tf, self.norm[docs[mine], None]) @ self.items.weights[own]
        return out


FOUND = "item long, doc_id long, score long"


def _searched(asked, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = asked.value
        best = _Best(len(items.ids), k)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, items)
                bounds = list(block.bounds())
                # first the most promising ones, which raise the k-th best; then whatever it does not exclude
                seen = [np.zeros(len(block.ids), bool) for _ in bounds]
                for first in (True, False):
                    wanted = []
                    for item, bound in enumerate(bounds):
                        open_ = np.flatnonzero((bound >= best.least(item)) & ~seen[item])
                        if first and len(open_) > k:
                            open_ = np.sort(open_[np.argpartition(-bound[open_], k - 1)[:k]])
                        seen[item][open_] = True
                        wanted.append(open_)
                    for item, scores in enumerate(block.scores(wanted)):
                        best.add(item, scores, block.ids[wanted[item]])
        sizes = [len(s) for s in best.scores]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(items.ids, np.int64), sizes), pa.int64()),
                pa.array(np.concatenate(best.docs), pa.int64()), pa.array(np.concatenate(best.scores), pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_docs: int = BLOCK_DOCS, ordered_bytes: int = ORDERED_BYTES) -> DataFrame:
    """Each item's ``k`` best documents: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of all characters above ASCII, with A-Z lower-cased. Only scores
    above 0 count, equal ones go by the smaller doc_id. Null texts have no terms. Rows that share a doc_id are documents of
    their own. A document without an id counts in the statistics and is never returned. Rows that share an item_id are one
    item with all their terms; items without an id or a term have no rows, nor has anything if a table is empty. Other
    columns are left out.
    """
    spark = prepare(docs.sparkSession)
    blocks = index(docs, block_docs, ordered_bytes)
    sizes = blocks.select("counts").mapInArrow(_sizes, "documents long, length long").agg(F.sum("documents"), F.sum("length")).first()
    found = spark.createDataFrame([], FOUND)
    context = spark.sparkContext
    for block in item_blocks(items) if sizes[0] else ():
        if not len(block.terms):
            continue
        asked = context.broadcast(block.terms)
        counted = blocks.select("keys", "df").mapInArrow(_frequencies(asked), "term long, df long").groupBy("term").agg(F.sum("df"))
        df = np.zeros(len(block.terms), np.int64)
        for term, n in counted.collect():  # one row for each term of this block of items
            df[term] = n
        block.documents, block.length = sizes
        block.weights = np.array([math.floor(1000 * math.log((2 * sizes[0] + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        read = blocks.select("ids", "counts", "rows", "slices", "ends", "text")
        found = found.unionByName(read.mapInArrow(_searched(context.broadcast(block), k), FOUND))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
