"""Language by a bidirectional gated recurrent network over bytes.

Two small recurrent networks read each window of a text's bytes, one forwards and
one backwards; together they label every byte position with the languages'
probabilities, and a document's probabilities are the means over all positions of
its whole text. The network is trained in numpy by backpropagation through time on
windows of a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.llm.common import mixed, prepare, texts_of

HIDDEN = 8
#: Bytes that the network reads at once; it starts anew at each window.
WINDOW = 64
#: Documents of each language that training looks at, at most (smallest id hashes), and windows of each.
TRAIN_DOCUMENTS, TRAIN_WINDOWS = 200, 12
STEPS, BATCH, RATE = 240, 192, 0.02
#: Windows that a worker reads at once.
SLICE = 8192
UNKNOWN = "und"
HOLD_OUT, HELD_OUT = 4, 2


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HOLD_OUT))


# --------------------------------------------------------------------- network
class Direction:
    """One gated recurrent network; arrays are (units, windows).

    ``table`` holds the three gates' inputs for each byte, ``inner`` the weights on the
    state. Gates are tanh of half the sum, moved to 0..1.
    """

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.table = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        self.inner = rng.normal(0, 0.5 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32)

    def steps(self, data: np.ndarray, keep: bool = False):
        """States (T, hidden, windows) for bytes (T, windows); with ``keep`` also what training needs."""
        h, (length, n) = self.hidden, data.shape
        states, kept = np.empty((length, h, n), np.float32), []
        state = np.zeros((h, n), np.float32)
        for t in range(length):
            given = self.table[:, data[t]]
            inner = self.inner @ state
            gates = np.tanh((given[: 2 * h] + inner[: 2 * h]) * np.float32(0.5))
            gates *= np.float32(0.5)
            gates += np.float32(0.5)
            new = np.tanh(given[2 * h :] + gates[h:] * inner[2 * h :])
            if keep:
                kept.append((state, gates, new, inner[2 * h :]))
            state = new + gates[:h] * (state - new)
            states[t] = state
        return (states, kept) if keep else states

    def gradients(self, data: np.ndarray, kept: list, outer: np.ndarray) -> list[np.ndarray]:
        """Gradients of ``table`` and ``inner``, given those of the states."""
        h, (length, n) = self.hidden, data.shape
        table, inner = np.zeros_like(self.table), np.zeros_like(self.inner)
        back = np.zeros((h, n), np.float32)
        for t in range(length - 1, -1, -1):
            before, gates, new, pulled = kept[t]
            update, reset = gates[:h], gates[h:]
            g = outer[t] + back
            g_new = g * (1 - update) * (1 - new * new)
            g_update = g * (before - new) * update * (1 - update)
            g_reset = g_new * pulled * reset * (1 - reset)
            g_given = np.concatenate([g_update, g_reset, g_new])
            g_inner = np.concatenate([g_update, g_reset, g_new * reset])
            inner += g_inner @ before.T
            order = np.argsort(data[t], kind="stable")
            values, first = np.unique(data[t][order], return_index=True)
            table[:, values] += np.add.reduceat(g_given[:, order], first, axis=1)
            back = g * update + self.inner.T @ g_inner
        return [table, inner]


class Network:
    """Forward and backward directions and the labels on top."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ways = [Direction(rng, hidden), Direction(rng, hidden)]
        self.top = rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), np.float32)

    def _chances(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        h = forward.shape[1]
        x = self.top[:, :h] @ forward
        x += self.top[:, h:] @ backward
        x += self.bias
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        x /= x.sum(axis=1, keepdims=True)
        return x

    def label(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (positions, languages, windows) of windows of bytes (positions, windows)."""
        return self._chances(self.ways[0].steps(data), self.ways[1].steps(data[::-1])[::-1])

    def learn(self, data: np.ndarray, target: np.ndarray, real: np.ndarray) -> list[np.ndarray]:
        """Gradients of all weights for windows (T, n), their languages (n) and the real positions (T, n)."""
        h = self.ways[0].hidden
        (ahead, kept), (behind, kept_back) = self.ways[0].steps(data, True), self.ways[1].steps(data[::-1], True)
        behind = behind[::-1]
        error = self._chances(ahead, behind)
        error[:, target, np.arange(data.shape[1])] -= 1
        error *= (real / real.sum())[:, None, :].astype(np.float32)
        both = np.concatenate([ahead, behind], axis=1)
        top = np.einsum("tln,thn->lh", error, both, optimize=True)
        outer = np.einsum("lh,tln->thn", self.top, error, optimize=True)
        first = self.ways[0].gradients(data, kept, outer[:, :h])
        second = self.ways[1].gradients(data[::-1], kept_back, outer[::-1, h:])
        return [*first, *second, top, error.sum(axis=(0, 2))[:, None]]

    def weights(self) -> list[np.ndarray]:
        return [*(w for d in self.ways for w in (d.table, d.inner)), self.top, self.bias]


def windows(text: bytes) -> np.ndarray:
    """A text's bytes as rows of WINDOW, the last one filled with zeros."""
    rows = -(-len(text) // WINDOW)
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(rows, WINDOW)


def fit(data: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on random batches with as many windows of each language."""
    network, rng = Network(languages, seed=seed), np.random.default_rng(seed)
    of = [np.flatnonzero(target == i) for i in range(len(languages))]
    first = [np.zeros_like(w) for w in network.weights()]
    second = [np.zeros_like(w) for w in network.weights()]
    for step in range(1, STEPS + 1):
        chosen = np.array([rng.choice(of[i]) for i in rng.integers(0, len(of), BATCH)])
        batch = np.ascontiguousarray(data[chosen].T)
        grads = network.learn(batch, target[chosen], batch > 0)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 - 2 * step / STEPS + 0.02)
        for w, g, m, v in zip(network.weights(), grads, first, second):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def pooled(network: Network, texts: list[str]) -> np.ndarray:
    """(texts, languages): mean probabilities over all byte positions; 0 for empty texts."""
    sums = np.zeros((len(texts), len(network.languages)))
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]

    def add(held: list[np.ndarray], owners: list[int]) -> None:
        rows = np.concatenate(held)
        for at in range(0, len(rows), SLICE):
            data = np.ascontiguousarray(rows[at : at + SLICE].T)
            chances = network.label(data)
            chances *= (data > 0)[:, None, :]
            np.add.at(sums, owner[at : at + SLICE], chances.sum(axis=0).T)

    held, owners, count = [], [], 0
    for i, text in enumerate(raw):
        if text:
            held.append(windows(text))
            owners.append(i)
            count += len(held[-1])
        if held and (count >= SLICE or i == len(raw) - 1):
            owner = np.repeat(owners, [len(w) for w in held])
            add(held, owners)
            held, owners, count = [], [], 0
    if held:
        owner = np.repeat(owners, [len(w) for w in held])
        add(held, owners)
    return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-9)


# ------------------------------------------------------------------------ spark
def train(docs: DataFrame) -> Network | None:
    """Fit on a bounded sample of the rows that may be learned from; None if there are none.

    ``docs``: doc_id, text, lang. At most TRAIN_DOCUMENTS documents of each language, the
    least by the hash of their ids, and of each at most TRAIN_WINDOWS windows, wherever in
    the text they are; these windows go to the driver.
    """
    spark: SparkSession = docs.sparkSession
    allowed = docs.where((remainder(F.col("doc_id")) != HELD_OUT) & F.col("lang").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = allowed.select("doc_id", "lang").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= TRAIN_DOCUMENTS)
    chosen = spark.createDataFrame(sample.select("doc_id").distinct().toArrow()) if not sample.isEmpty() else None
    if chosen is None:
        return None
    rows = allowed.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for doc, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
                rows = windows(text.encode("utf-8", "surrogatepass"))
                picks = np.argsort(mixed(np.arange(len(rows)), doc % (1 << 31)), kind="stable")[:TRAIN_WINDOWS]
                found += [rows[i].tobytes() for i in sorted(picks)]
                langs += [lang] * len(picks)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "window"])

    got = rows.mapInArrow(run, "lang string, window binary").toArrow().sort_by([("lang", "ascending"), ("window", "ascending")])
    if not len(got):
        return None
    langs = got.column("lang").to_pylist()
    languages = sorted(set(langs))
    data = np.frombuffer(b"".join(got.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return fit(data, np.array([languages.index(x) for x in langs]), languages)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one for each row of ``docs`` (doc_id, text, lang).

    Documents whose crc32(doc_id as text) mod 4 is 2 are held out; null ids are not, but
    nothing is learned from them. Null texts and texts without a letter are ``und`` with
    score 0, and so is everything if there is nothing to learn from. Ties go to the
    language that comes first in the alphabet. Extra columns play no part.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    held_out = F.coalesce(remainder(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    network = train(rows)
    if network is None:
        return rows.select("doc_id", held_out, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(network)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            letters = np.array(batch.column(3).to_pylist(), bool)
            texts = [t if ok else "" for t, ok in zip(texts_of(batch.column(2)), letters)]
            chances = pooled(network, texts)
            best = chances.argmax(axis=1)
            names = [network.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
            score = np.where(letters, np.clip(chances.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter")
    return rows.select("doc_id", held_out, "text", letter).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )
