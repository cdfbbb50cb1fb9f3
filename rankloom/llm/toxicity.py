"""Toxicity by a classifier chain of linear models on words and word beginnings.

Categories are predicted one after the other; a later model also gets the earlier
categories' probabilities. In training these come from models that didn't see the
document (out-of-fold), so a later link doesn't learn to trust an overfitted one.

Each link chooses its features (hashed words and their first bytes) by the likelihood
ratio of their document frequencies and fits a logistic regression on them, so words that
tell nothing carry no weight. A text longer than the training texts is judged in
parts of that length, and the highest probability of a part is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import Words, one_per_document, prepare, slices, texts_of

#: Labelled documents that training uses at most (those whose ids' hashes are smallest), and their longest text.
TRAIN_TOXIC, TRAIN_OTHER, TRAIN_CHARS = 2000, 6000, 20_000
FOLDS = 5
FEATURE_BITS = 20
PREFIXES = (4, 5)
LEAST_GAIN, LEAST_DOCUMENTS, MOST_FEATURES = 2.0, 3, 2048
THRESHOLD = 0.5
#: In this order. ``severe``: toxic, with more different telling words than the median toxic document.
CATEGORIES = ("low_quality", "toxic", "severe")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning; features may repeat."""
    words = Words(texts)
    kinds = [words.hashes(), *[words.prefixes(p) for p in PREFIXES]]
    ids = np.concatenate(kinds) >> np.uint64(64 - FEATURE_BITS)
    return np.tile(words.doc, len(kinds)), ids.astype(np.int64)


def parts(text: str) -> list[str]:
    """The text in parts of at most TRAIN_CHARS, cut before a space where there is one in the second half."""
    out, at = [], 0
    while len(text) - at > TRAIN_CHARS:
        cut = text.rfind(" ", at + TRAIN_CHARS // 2, at + TRAIN_CHARS)
        cut = cut if cut > 0 else at + TRAIN_CHARS
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _distinct(doc: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(doc.astype(np.int64) << FEATURE_BITS | ids)
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Link:
    """One category's linear model: weights by feature, weights of earlier probabilities, intercept."""

    def __init__(self, doc: np.ndarray, ids: np.ndarray, y: np.ndarray, earlier: np.ndarray, use: np.ndarray):
        """``doc``/``ids``: distinct pairs; ``use``: the documents to fit on."""
        inside = use[doc]
        doc, ids = doc[inside], ids[inside]
        yes = np.bincount(ids[y[doc] > 0], minlength=1 << FEATURE_BITS)
        no = np.bincount(ids[y[doc] == 0], minlength=1 << FEATURE_BITS)
        n1, n0 = max((y[use] > 0).sum(), 1), max((y[use] == 0).sum(), 1)
        rate = n1 / (n1 + n0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 2 * (np.where(yes, yes * np.log(yes / ((yes + no) * rate)), 0) + np.where(no, no * np.log(no / ((yes + no) * (1 - rate))), 0))
        gain[(yes < LEAST_DOCUMENTS) | (yes <= (yes + no) * rate)] = 0
        # the more features are tried, the more must one of them tell
        chosen = np.flatnonzero(gain >= 2 * np.log(max((yes >= LEAST_DOCUMENTS).sum(), 1)) + LEAST_GAIN)
        chosen = chosen[np.argsort(-gain[chosen], kind="stable")][:MOST_FEATURES]
        self.weights = np.zeros(1 << FEATURE_BITS, np.float32)
        self.earlier, self.intercept = np.zeros(earlier.shape[1]), float(np.log(n1 / n0))
        if not (y[use] > 0).any():  # never seen: never predicted
            self.intercept = -30.0
        if not len(chosen) or not (y[use] > 0).any() or not (y[use] == 0).any():
            return
        place = np.full(1 << FEATURE_BITS, -1)
        place[chosen] = np.arange(len(chosen))
        known = place[ids] >= 0
        rows = np.cumsum(use) - 1
        row, column = rows[doc[known]], place[ids[known]]
        target, extra, n = y[use], earlier[use], int(use.sum())
        w, v, b = np.zeros(len(chosen)), np.zeros(extra.shape[1]), self.intercept
        sums = [np.full(len(chosen), 1e-8), np.full(len(v), 1e-8), 1e-8]
        for _ in range(500):  # full-batch steps, scaled by the gradients so far
            p = _sigmoid(np.bincount(row, w[column], n) + extra @ v + b)
            error = (p - target) / n
            steps = [np.bincount(column, error[row], len(w)) + 1e-5 * w, error @ extra + 1e-5 * v, error.sum()]
            sums = [s + g * g for s, g in zip(sums, steps)]
            w, v, b = (x - 1.0 * g / np.sqrt(s) for x, g, s in zip((w, v, b), steps, sums))
        self.weights[chosen], self.earlier, self.intercept = w, v, float(b)

    def predict(self, doc: np.ndarray, ids: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(np.bincount(doc, self.weights[ids], n) + earlier @ self.earlier + self.intercept)


class Chain:
    """Links in the order of the categories."""

    def __init__(self, links: list[Link]):
        self.links = links
        self.telling = np.any([link.weights != 0 for link in links], axis=0)

    def predict(self, texts: list[str]) -> np.ndarray:
        """(texts, categories) probabilities; all 0 for a text without a word."""
        whole, pieces = [], []
        for i, text in enumerate(texts):
            found = parts(text)
            pieces += found
            whole += [i] * len(found)
        out = np.zeros((len(texts), len(self.links)))
        np.maximum.at(out, whole, self._predict(pieces))
        return out

    def _predict(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.links)))
        for first, run in slices(texts):
            doc, ids = features(run)
            some = np.bincount(doc, minlength=len(run)) > 0
            known = self.telling[ids]
            doc, ids = _distinct(doc[known], ids[known])
            found = np.zeros((len(run), 0))
            for link in self.links:
                found = np.column_stack([found, link.predict(doc, ids, len(run), found)])
            out[first : first + len(run)] = np.where(some[:, None], found, 0.0)
        return out


def fit_chain(doc: np.ndarray, ids: np.ndarray, targets: np.ndarray, fold: np.ndarray) -> Chain:
    """``targets``: a column for each category, NaN where the label is missing."""
    n, links = len(targets), []
    earlier = np.zeros((n, 0))
    for y in targets.T:
        labelled = ~np.isnan(y)
        held_out = np.zeros(n)
        for f in range(FOLDS):
            other = Link(doc, ids, y, earlier, labelled & (fold != f))
            mine = fold == f
            held_out[mine] = other.predict(doc, ids, n, earlier)[mine]
        links.append(Link(doc, ids, y, earlier, labelled))
        earlier = np.column_stack([earlier, held_out])
    return Chain(links)


def train(docs: DataFrame, labels: DataFrame) -> Chain:
    """Fit the chain on a bounded sample of labelled documents; their features go to the driver."""
    known = one_per_document(labels, "toxic", "quality").where(F.col("toxic").isNotNull())
    order = F.xxhash64("doc_id")
    some = known.where(F.col("toxic") == 1).orderBy(order, "doc_id").limit(TRAIN_TOXIC)
    other = known.where(F.col("toxic") != 1).orderBy(order, "doc_id").limit(TRAIN_OTHER)
    sample = F.broadcast(some.unionByName(other).withColumnRenamed("doc_id", "id"))  # bounded by the two limits
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.length("text") <= TRAIN_CHARS).join(sample, F.col("doc_id") == F.col("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = []
            for _, texts in slices(texts_of(batch.column(3))):
                doc, ids = _distinct(*features(texts))
                found += np.split(ids.astype(np.int32), np.searchsorted(doc, np.arange(1, len(texts))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.int32()))], ["doc_id", "toxic", "quality", "f"])

    got = rows.select("doc_id", "toxic", "quality", "text").mapInArrow(run, "doc_id long, toxic int, quality int, f array<int>").toArrow()
    got = got.sort_by("doc_id")
    lists = got.column("f").combine_chunks()
    counts = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64) if len(got) else np.zeros(0, np.int64)
    doc, ids = np.repeat(np.arange(len(got)), counts), np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64)
    toxic, quality = (got.column(c).to_numpy().astype(float) for c in ("toxic", "quality"))
    toxic = (toxic == 1).astype(float)
    markers = Link(doc, ids, toxic, np.zeros((len(toxic), 0)), np.ones(len(toxic), bool)).weights > 0
    telling = np.bincount(doc[markers[ids]], minlength=len(toxic))
    usual = np.median(telling[toxic == 1]) if toxic.any() else 0
    severe = toxic * (telling > usual)
    fold = np.asarray(got.column("doc_id").to_numpy() % FOLDS) if len(got) else np.zeros(0)
    return fit_chain(doc, ids, np.column_stack([1 - quality, toxic, severe]), fold)


def chances(docs: DataFrame, labels: DataFrame, text: Column) -> Column:
    """A column of the categories' probabilities for a text column, by a chain trained on ``docs`` and ``labels``."""
    spark = prepare(docs.sparkSession)
    chain = spark.sparkContext.broadcast(train(docs, labels))  # three weight vectors of fixed length

    @F.arrow_udf("array<double>")
    def predict(texts: pa.Array) -> pa.Array:
        return pa.array(chain.value.predict(texts_of(texts)).tolist(), pa.list_(pa.float64()))

    return predict(text.cast("string"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, p_severe, toxic), one for each row of ``docs``.

    ``labels``: doc_id, quality, toxic. Null texts and texts without a word get 0 and are
    not toxic; rows with equal texts get equal results; null and repeated doc_ids are judged
    row by row. Without labelled documents nothing is toxic. Extra columns play no part.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), chances(docs, labels, docs["text"]).alias("p"))
    columns = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(CATEGORIES)]
    return rows.select("doc_id", *columns, (F.col("p")[1] >= THRESHOLD).alias("toxic"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    return docs.where(chances(docs, labels, docs["text"])[1] < THRESHOLD)
