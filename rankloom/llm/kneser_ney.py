"""Quality classifier: an interpolated modified Kneser-Ney model of character 5-grams.

The model is trained on trusted text: documents labelled good and not toxic. Every
document's 5-grams are counted in the tasks, one row per distinct 5-gram and task,
and summed by a shuffle on the 5-gram; counts of lower orders, context totals and
discounts follow from that table by group-bys and joins on ever shorter grams, and
end in one table: 5-gram -> log-probability. It grows with the text.

Scoring deals that table into shards of bounded size. A shard is broadcast, every
document adds up the shard's part of its log-probability, and the parts are summed
by document. Perplexity per character is compared with quantiles of trusted
documents of the same language that were kept out of the counting.

Code points below 2048 are symbols of their own (digits are one symbol, white space
and control characters another); the rest share 2048 hashed symbols. So a 5-gram is
60 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import mixed, one_per_document, prepare, row_key, slices, stored, texts_of, without
from rankloom.scale import broadcast_if_small

ORDER = 5
BITS = 12
START = 1
#: Log-probabilities that one broadcast holds at most (12 bytes each, at a load of a half).
SHARD_GRAMS = 2_000_000
#: Distinct 5-grams that a task holds before it lets them out.
TASK_GRAMS = 4_000_000
#: Trusted documents are calibration if their id's hash has remainder 0; the others are counted.
CALIBRATION = 5
#: Share of a language's trusted documents that the threshold keeps.
KEPT = 0.998
#: Widening of the threshold, in bits per character, for what a quantile of few documents can't tell.
MARGIN = 0.02
#: Languages with fewer calibration documents use the threshold of all.
LEAST_DOCUMENTS = 100
_STEPS = 1000


# ----------------------------------------------------------------------- grams
def _symbols() -> np.ndarray:
    out = np.arange(2048, dtype=np.int64)
    out[[c for c in range(2048) if chr(c).isspace() or c < 32 or 127 <= c < 160]] = ord(" ")
    out[[c for c in range(2048) if chr(c).isdigit()]] = ord("0")
    return out


_TABLE = _symbols()


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(5-gram of every character, text it belongs to): a text begins after four start marks."""
    raw = ("\x00" * (ORDER - 1)).join(["", *texts]).encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(raw, np.uint32)
    symbol = _TABLE[np.minimum(code, 2047)]
    high = np.flatnonzero(code >= 2048)
    symbol[high] = 2048 + ((code[high].astype(np.int64) * 2654435761 >> 15) & 2047)
    lengths = np.array([len(t) for t in texts], np.int64)
    place = np.cumsum(lengths + ORDER - 1) - lengths  # of each text's first character
    starts = (place[:, None] - np.arange(1, ORDER)).ravel()
    symbol[starts] = START
    key = symbol.copy()
    for back in range(1, ORDER):
        key[back:] |= symbol[:-back] << (BITS * back)
    real = np.ones(len(key), bool)
    real[starts] = False
    return key[real], np.repeat(np.arange(len(texts)), lengths)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(count, first) if len(first) else count


def gram_counts(docs: DataFrame) -> DataFrame:
    """(g, c): every 5-gram of ``docs`` (text, counted) and how often counted documents hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def rows() -> pa.RecordBatch:
            key, number = _merge(keys, counts) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(number)], ["g", "c"])

        for batch in batches:
            texts, counted = texts_of(batch.column(0)), np.array(batch.column(1).to_pylist(), bool)
            for first, run in slices(texts):
                key, doc = grams(run)
                weighed = np.sort(key << 1 | counted[first + doc])  # whether it counts is the lowest bit
                at = np.flatnonzero(np.diff(weighed, prepend=-1))
                found = np.diff(np.append(at, len(weighed))) * (weighed[at] & 1)
                keys.append(weighed[at] >> 1)
                counts.append(found.astype(np.int64))
                held += len(at)
            if held > TASK_GRAMS:
                key, number = _merge(keys, counts)
                keys, counts, held = [key], [number], len(key)
                if held > TASK_GRAMS // 2:
                    yield rows()
                    keys, counts, held = [], [], 0
        yield rows()

    return docs.select("text", "counted").mapInArrow(count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


# ----------------------------------------------------------------------- model
def _discounts(counted: DataFrame) -> list[float]:
    """The three discounts of one order, from its counts of counts."""
    of = [F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)]
    n = counted.agg(*of).first()
    if not all(n):
        return [0.5, 0.75, 0.9]
    y = n.n1 / (n.n1 + 2 * n.n2)
    return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.0), float(i)) for i in (1, 2, 3)]


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(g, lp): natural log-probability of each 5-gram's last symbol after its first four.

    A lower order counts in how many different longer grams a gram ends. Contexts that
    trusted text never has pass their probability on from the next lower order.
    """
    orders = {ORDER: stored(counts, "grams-5")}
    for n in range(ORDER - 1, 0, -1):
        shorter = F.col("g").bitwiseAND((1 << (BITS * n)) - 1).alias("g")
        ends = F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("c")
        orders[n] = stored(orders[n + 1].groupBy(shorter).agg(ends), f"grams-{n}")
    symbols = max(orders[1].count(), 1)
    known = None
    for n in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(orders[n])
        discount = F.when(F.col("c") > 2, d3).when(F.col("c") > 1, d2).otherwise(d1)
        context = Window.partitionBy("context")  # at most one row for each symbol
        left = F.sum(F.when(F.col("c") > 0, discount).otherwise(0.0)).over(context)
        rows = (
            orders[n]
            .withColumn("context", F.shiftright("g", BITS))
            .withColumn("total", F.sum("c").over(context).cast("double"))
            .withColumn("left", left)
        )
        if known is None:
            rows = rows.withColumn("lower", F.lit(1.0 / symbols))
        else:
            lower = known.select(F.col("g").alias("end"), F.col("p").alias("lower"))
            rows = rows.withColumn("end", F.col("g").bitwiseAND((1 << (BITS * (n - 1))) - 1)).join(lower, "end")
        own = F.greatest(F.col("c") - discount, F.lit(0.0))
        p = F.when(F.col("total") > 0, (own + F.col("left") * F.col("lower")) / F.col("total")).otherwise(F.col("lower"))
        known = rows.select("g", p.alias("p"))
    return known.select("g", F.log("p").alias("lp"))


class Lookup:
    """Log-probabilities of some 5-grams in an open hash table of numpy arrays."""

    def __init__(self, g: np.ndarray, lp: np.ndarray):
        self.bits = max(4, int(2 * len(g)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float32)
        slot, left = self._slot(g), np.arange(len(g))
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = g[free]  # of several in one place, the last stays
            won = free[self.keys[slot[free]] == g[free]]
            self.values[slot[won]] = lp[won]
            left = left[self.keys[slot[left]] != g[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, g: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, g: np.ndarray) -> np.ndarray:
        """Their log-probabilities; 0 for grams that are not in this table."""
        out, left, slot = np.zeros(len(g), np.float32), None, self._slot(g)
        found = self.keys[slot]
        hit = found == g
        out[hit] = self.values[slot[hit]]
        left = np.flatnonzero(~hit & (found != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[left]]
            hit = found == g[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found != -1)]
        return out


def _shards(model: DataFrame) -> tuple[DataFrame, int]:
    """The model with its shard numbers; no shard has more than SHARD_GRAMS rows."""
    n = max(1, math.ceil(1.1 * model.count() / SHARD_GRAMS))
    while True:
        dealt = model.withColumn("shard", F.pmod(F.xxhash64("g"), F.lit(n)))
        if (dealt.groupBy("shard").count().agg(F.max("count")).first()[0] or 0) <= SHARD_GRAMS:
            return dealt, n
        n *= 2


def document_scores(docs: DataFrame, model: DataFrame, *keep: str) -> DataFrame:
    """Log-probability (``lp``) and number of characters (``n``) of each distinct row of ``docs`` by the columns ``keep``, which tell texts apart."""
    spark = docs.sparkSession
    dealt, n = _shards(model)
    chosen = docs.select("text", *keep)
    schema = chosen.select(*keep).schema.add("lp", "double").add("n", "long")
    parts = None
    for shard in range(n):
        rows = dealt.where(F.col("shard") == shard).select("g", "lp").toArrow()
        table = spark.sparkContext.broadcast((rows.column(0).to_numpy(), rows.column(1).to_numpy().astype(np.float32)))

        def score(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            lookup = Lookup(*table.value)
            for batch in batches:
                texts = texts_of(batch.column(0))
                total = np.zeros(len(texts))
                for first, run in slices(texts):
                    key, doc = grams(run)
                    total[first : first + len(run)] = np.bincount(doc, lookup.get(key), len(run))
                lengths = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(total), lengths], [*keep, "lp", "n"])

        part = chosen.mapInArrow(score, schema)
        parts = part if parts is None else parts.unionByName(part)
    # a row that comes several times has a part from each shard as often
    copies = F.count(F.lit(1)) / n
    return parts.groupBy(*keep).agg((F.sum("lp") / copies).alias("lp"), F.max("n").alias("n"))


# ------------------------------------------------------------------- classifier
def _quantiles(scores: DataFrame) -> DataFrame:
    """(language, high, documents) of calibration documents; the row with null language is for all.

    Exact on bits per character in steps of a thousandth: a language's documents are
    counted by step first, so what is ordered is a few thousand steps, not documents.
    """
    step = F.floor(F.col("bits") * _STEPS).alias("step")
    held = scores.where(F.col("calibration") & F.col("bits").isNotNull()).select(F.col("language"), step)
    counts = held.groupBy("language", "step").count()
    counts = counts.unionByName(counts.groupBy("step").agg(F.sum("count").alias("count")).select(F.lit(None).cast("string").alias("language"), "step", "count"))
    along = Window.partitionBy("language").orderBy("step")
    so_far = counts.withColumn("upto", F.sum("count").over(along)).withColumn("total", F.sum("count").over(Window.partitionBy("language")))
    return so_far.groupBy("language").agg(
        F.min(F.when(F.col("upto") >= F.col("total") * KEPT, F.col("step") + 1)).alias("high"),
        F.max("total").alias("documents"),
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, doc_id, language, perplexity, threshold, keep), one row for each distinct row (doc_id, text, lang).

    ``labels``: doc_id, quality, toxic. Rows of one id and different texts are judged apart.
    Null and empty texts have no perplexity and are kept; null languages are one language
    ``und``. With no trusted document there is no threshold, and everything is kept. Extra
    columns play no part. Equal perplexities get equal decisions.
    """
    spark = prepare(docs.sparkSession)
    trusted = one_per_document(labels, "quality", "toxic").where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    trusted = trusted.select(F.col("doc_id").alias("id"), F.lit(True).alias("trusted"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("language"),
    )
    kept_out = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0
    known = F.coalesce("trusted", F.lit(False))
    rows = rows.join(broadcast_if_small(trusted), F.col("doc_id") == F.col("id"), "left").select(
        row_key(F.col("doc_id"), F.col("text"), F.col("language")).alias("key"), "doc_id", "language", "text",
        (known & kept_out).alias("calibration"), (known & ~kept_out).alias("counted"),
    )
    model = stored(log_probabilities(gram_counts(rows)), "log-probabilities")
    scores = document_scores(rows, model, "key", "doc_id", "language", "calibration")
    bits = F.when(F.col("n") > 0, -F.col("lp") / F.col("n") / math.log(2))
    scores = stored(scores.withColumn("bits", bits), "document-scores")
    limits = stored(_quantiles(scores), "thresholds")
    overall = limits.where(F.col("language").isNull()).first()
    own = limits.where(F.col("language").isNotNull() & (F.col("documents") >= LEAST_DOCUMENTS))
    joined = scores.join(broadcast_if_small(own), "language", "left")
    limit = F.coalesce(F.col("high"), F.lit(overall.high if overall else None).cast("long")) / _STEPS + MARGIN
    return joined.select(
        "key", "doc_id", "language", F.pow(F.lit(2.0), "bits").alias("perplexity"),
        F.pow(F.lit(2.0), limit).alias("threshold"), F.coalesce(F.col("bits") <= limit, F.lit(True)).alias("keep"),
    )


def key_of(docs: DataFrame) -> Column:
    """The key of ``judged`` for the rows of ``docs``."""
    language = F.coalesce(docs["lang"].cast("string"), F.lit("und"))
    return row_key(docs["doc_id"].cast("long"), docs["text"].cast("string"), language)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    return without(docs, key_of(docs), judged(docs, labels).where(~F.col("keep")).select("key"))
