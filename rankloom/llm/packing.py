"""Concatenate and cut: documents as token ids, packed into fixed windows.

Two passes. The first encodes every document in its task, stores the ids and each
document's place in its partition. Prefix sums over the partitions' totals (one
row each) then give every document its global offset, and the second pass cuts
the ids at multiples of the window. Only the last window is ever short.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import prepare, slices, stored, texts_of

WINDOW = 2048
END = 1
#: Pieces that a worker remembers; a full memory is emptied and filled again.
REMEMBERED = 1_200_000
#: A full stop or comma that is part of a longer run of marks; it begins with what is rare, so that the search can skip.
_RUN_OF_MARKS = re.compile(r"[.,] (?<=(?:[^\w\s]|_)[.,] )")
#: What a tokenizer may do to a text before its model, if a word of lower-case letters in Latin-1 is to be left whole: the model
#: then gets its bytes, each as one character.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE = [
    {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_KEPT = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The character that stands for each byte.
_OF_BYTE = {b: b if b in _KEPT else 256 + i for i, b in enumerate([*(x for x in range(256) if x not in _KEPT), *_KEPT])}


def pieces_of(text: str) -> list[str]:
    """A text cut at spaces and line ends, where no token ever crosses.

    Texts in Latin-1 are folded to lower case, as the tokenizer does, and full stops and
    commas after a word are pieces of their own, as they are tokens of their own: there are
    then far fewer different pieces.
    """
    text = text.replace("\n", " ")
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.split(" ")
    if "<|" not in text:  # folding must not make a special token
        text = text.lower()
        if not _RUN_OF_MARKS.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


class Encoder:
    """Token ids of texts by a tokenizer file that never merges across white space.

    The ids of each distinct piece are remembered, so the tokenizer sees a frequent word
    once. White space that is no space or line end stays inside a piece. ``tests/llm``
    holds the result against the tokenizer's own.
    """

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), np.dtype(kind)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}
        front = json.loads(self.tokenizer.to_str())
        self.plain = [(front[part] or {}).get(inner) for part, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))] == [_NORMAL, _PRE]
        self.model = self.tokenizer.model
        self.of_id: dict[int, bytes] = {i: np.array([i], self.kind).tobytes() for i in self.tokenizer.get_vocab().values()} if self.plain else {}

    def _learn_plain(self, pieces: list[str]) -> list[str]:
        """Words that reach the model as they are go to it at once; returns the other pieces."""
        others, known, of_id, tokenize = [], self.known, self.of_id, self.model.tokenize
        for piece in pieces:
            if not (piece.isalpha() and piece.islower()):
                others.append(piece)
                continue
            word = piece
            if not piece.isascii():
                if max(piece) > "\xff" or piece != piece.lower():
                    others.append(piece)
                    continue
                word = piece.encode().decode("latin-1").translate(_OF_BYTE)
            known[piece] = b"".join([of_id[token.id] for token in tokenize(word)])
        return others

    def learn(self, pieces: list[str]) -> None:
        """Plain words are joined and encoded a thousand at a time, each being one stretch for the tokenizer."""
        if self.plain:
            pieces = self._learn_plain(pieces)
        words = [p for p in pieces if p.isalpha()]
        single = [p for p in pieces if not p.isalpha()]
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, of = np.array(found.ids, self.kind).tobytes(), np.array(found.word_ids)
            if of[-1] != len(some) - 1:  # a letter that folding turns into two
                single += some
                continue
            size = self.kind.itemsize
            ends = ((np.flatnonzero(np.diff(of, append=-1)) + 1) * size).tolist()
            start = 0
            for word, end in zip(some, ends):
                self.known[word] = ids[start:end]
                start = end
        for piece, tokens in zip(single, self.tokenizer.encode_batch_fast(single, add_special_tokens=False)):
            self.known[piece] = np.array(tokens.ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for _, run in slices(texts):
            cut = [pieces_of(text) for text in run]
            asked = set().union(*cut)
            new = list(asked - self.known.keys())
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(asked)
            self.learn(new)
            out += [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder_of(path: str, kind: str = "<u4") -> Encoder:
    """The worker's own encoder: what it has learned in one task helps in the next."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    return _ENCODERS[path, kind]


def encoded(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """(part, at, doc_id, n, ids): each document's ids with the end id, and its place in its partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = encoder_of(tokenizer), TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            ids = [x + last for x in encoder.encode(texts_of(batch.column(1)))]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            columns = [pa.array([part] * len(n), pa.int32()), pa.array(starts), batch.column(0), pa.array(n), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "at", "doc_id", "n", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        encode, "part int, at long, doc_id long, n long, ids binary"
    )


def bases(rows: DataFrame, size: str) -> DataFrame:
    """(part, base): what all earlier partitions hold; one row for each partition of the first pass."""
    totals = rows.groupBy("part").agg(F.sum(size).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row for each piece of a document in a window, whatever the document's length.

    Null text counts as empty: such a document is its end id alone. Null and repeated
    doc_ids are packed row by row, like any other. An empty table gives no rows. Extra
    columns of ``docs`` are left out. The last window is as long as what is left.
    """
    prepare(docs.sparkSession)
    held = stored(encoded(docs, tokenizer, end), "packed-ids")
    placed = held.join(F.broadcast(bases(held, "n")), "part")  # one row per task of the first pass

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            out: list[tuple] = []
            for doc, place, n, ids in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                view, start = memoryview(ids.as_buffer()), 0
                while start < n:
                    sequence, offset = divmod(place + start, window)
                    length = min(n - start, window - offset)
                    out.append((doc, start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), n, sequence, offset))
                    start += length
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return placed.select("doc_id", (F.col("base") + F.col("at")).alias("place"), "n", "ids").mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
