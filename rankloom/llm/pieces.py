"""Piece encoding by a streaming Viterbi search, and decoding.

The search keeps, for each position, the best-scoring way to reach it. Only the
last ``longest piece`` positions can still be extended, so only paths to them are
kept. As soon as the window is two pieces long and the backpointers of all of these
run through one boundary, what lies before it can't change any more: its ids are
committed and forgotten. Memory
is bounded by the longest piece and the stretch since the last common boundary,
not by the text.

Pieces never cross from a letter to a following space mark, so every such place
is a common boundary; what lies between two of them is encoded once per worker
and remembered.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import prepare, texts_of

SPACE = "▁"
#: How much worse than the worst piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
#: Stretches between common boundaries that a worker remembers, and the longest one it remembers.
REMEMBERED = 800_000
REMEMBERED_CHARS = 64


class Pieces:
    """A vocabulary of scored pieces, read from a model file once per worker."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown = model.unk_id()
        ids = range(model.get_piece_size())
        self.names = [model.id_to_piece(i) for i in ids]
        self.bytes_at = {int(self.names[i][3:5], 16): i for i in ids if model.is_byte(i)}
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.raw = [name.replace(SPACE, " ").encode("utf-8") for name in self.names]
        for byte, i in self.bytes_at.items():
            self.raw[i] = bytes([byte])
        self.score = {self.names[i]: (model.get_score(i), i) for i in plain}
        self.heads = {name[:n] for name in self.score for n in range(1, len(name) + 1)}
        self.longest = max(map(len, self.score), default=1)
        self.worst = min((s for s, _ in self.score.values()), default=0.0) - UNKNOWN_PENALTY
        self.remembered: dict[str, bytes] = {}
        self.bounded = not any(SPACE in name.lstrip(SPACE) for name in self.score)

    def stream(self, chars: Iterator[str] | str) -> Iterator[list[int]]:
        """Committed ids, a run at a time, of characters that come one after the other.

        ``chars`` is text in the model's own form (spaces as marks). A tie between two ways
        to a position goes to the longer last piece.
        """
        names, heads, patience = self.score, self.heads, 2 * self.longest
        # paths[j] for position base + j: (score, start of the last piece, its id)
        base, paths, window, live = 0, [(0.0, -1, -1)], "", [0]
        for char in chars:
            window += char
            end = base + len(window)
            best, still = None, []
            for start in live:  # positions that a piece may still lead on from, the earliest first
                name = window[start - base :]
                if name in heads:
                    still.append(start)
                    found = names.get(name)
                    if found is not None and (best is None or paths[start - base][0] + found[0] > best[0]):
                        best = (paths[start - base][0] + found[0], start, found[1])
            unknown = paths[-1][0] + self.worst
            if best is None or (char not in names and unknown > best[0]):
                best = (unknown, end - 1, self.unknown)
            paths.append(best)
            still.append(end)
            live = still
            if len(window) >= patience:
                common = self._common(paths, base, live)
                if common > base:
                    yield self._ids(paths, window, base, common)
                    base, window, paths = common, window[common - base :], paths[common - base :]
        end = base + len(window)
        if end > base:
            yield self._ids(paths, window, base, end)

    @staticmethod
    def _common(paths: list, base: int, live: list[int]) -> int:
        """The last position that the ways to all live positions run through."""
        at = set(live)
        while len(at) > 1:
            last = max(at)
            at.remove(last)
            if last == base:
                return base
            at.add(paths[last - base][1])
        return at.pop()

    def _ids(self, paths: list, window: str, base: int, end: int) -> list[int]:
        out: list[int] = []
        while end > base:
            _, start, piece = paths[end - base]
            if piece == self.unknown and self.bytes_at:
                raw = window[start - base : end - base].encode("utf-8", "surrogatepass")
                out.extend(self.bytes_at[b] for b in reversed(raw))
            else:
                out.append(piece)
            end = start
        return out[::-1]

    def _stretch(self, stretch: str) -> bytes:
        known = self.remembered.get(stretch)
        if known is None:
            known = np.array([i for run in self.stream(stretch) for i in run], "<u4").tobytes()
            if len(stretch) <= REMEMBERED_CHARS:
                if len(self.remembered) >= REMEMBERED:
                    self.remembered.clear()
                self.remembered[stretch] = known
        return known

    def encode(self, text: str) -> bytes:
        """ids of a text as little-endian unsigned 32-bit numbers; an empty text has none."""
        if not text:
            return b""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.bounded:
            return self._stretch(marked)
        get, out = self.remembered.get, []
        for stretch in _STRETCH.findall(marked):
            out.append(get(stretch) or self._stretch(stretch))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes are put together, marks become spaces, the first one goes."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")
        return text[1:] if text.startswith(" ") else text


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The worker's own vocabulary: what it has encoded in one task helps in the next."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


#: Marks and what follows up to the next mark.
_STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_chars, ids): ids as little-endian unsigned 32-bit numbers.

    Null and empty texts have no ids. Null and repeated doc_ids are encoded row by row.
    Texts that hold the space mark itself are encoded as if it were a space. Extra
    columns are left out; an empty table gives no rows.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            texts = texts_of(batch.column(1))
            columns = [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(pieces.encode, texts), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, ids binary"
    )


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of encoded rows; null ids give null text."""
    prepare(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(np.frombuffer(ids, "<u4")) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_chars, n_ids, ids_crc32, round_trip): every text encoded, decoded and compared."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, names = pieces_of(model), ["doc_id", "n_chars", "n_ids", "ids_crc32", "round_trip"]
        for batch in batches:
            texts = texts_of(batch.column(1))
            ids = [pieces.encode(t) for t in texts]
            same = [pieces.decode(np.frombuffer(i, "<u4")) == t.replace(SPACE, " ") for i, t in zip(ids, texts)]
            counts = [[len(t) for t in texts], [len(i) // 4 for i in ids], [zlib.crc32(i) for i in ids]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(same, pa.bool_())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, n_ids long, ids_crc32 long, round_trip boolean"
    )
