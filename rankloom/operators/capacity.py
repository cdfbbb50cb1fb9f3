"""Sizes, costs and rates, from data rather than from assumed averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.scale import broadcast_if_small, carried_sum, through_table

# fixed values: public list prices in dollars per million tokens
EMBEDDING_MODELS = [("MiniLM-L6-v2", 384, 0.0), ("text-embedding-3-small", 1536, 0.02), ("text-embedding-3-large", 3072, 0.13)]
ANSWER_MODELS = [("Claude Sonnet 4", 3.0, 15.0), ("GPT-4o", 2.5, 10.0)]


def _rows(names: Sequence[str], values: Sequence[tuple]):
    """A fixed handful of parameter rows as an array of structs."""
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in values])


def embedding_capacity(docs: DataFrame, size: int = 256, models=EMBEDDING_MODELS) -> DataFrame:
    """Vectors, bytes (index twice the vectors) and one-time encoding cost per model."""
    tokens = docs.select(F.size(T.ws_tokens(F.col("text"))).cast("bigint").alias("n"))
    totals = tokens.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n").alias("n_tokens"),
        F.sum(F.ceil(F.col("n") / size)).alias("n_vectors"),
    )
    per_model = totals.select("*", F.inline(_rows(("model", "dim", "price"), models)))
    return per_model.select(
        "model",
        "n_docs",
        "n_tokens",
        "n_vectors",
        (F.col("n_vectors") * F.col("dim") * 4).alias("vector_bytes"),
        (F.col("n_vectors") * F.col("dim") * 8).alias("index_bytes"),
        (F.col("n_tokens") * F.col("price") / 1e6).alias("encode_cost"),
    )


def answer_cost(log: DataFrame, month: str, tokens_in: str, tokens_out: str, models=ANSWER_MODELS) -> DataFrame:
    """Mean cost per query and total per month and model."""
    totals = log.groupBy(month).agg(
        F.count(F.lit(1)).alias("n_queries"), F.sum(tokens_in).alias("_in"), F.sum(tokens_out).alias("_out")
    )
    priced = totals.select("*", F.inline(_rows(("model", "price_in", "price_out"), models)))
    cost = F.col("_in") * F.col("price_in") / 1e6 + F.col("_out") * F.col("price_out") / 1e6
    return priced.select(month, "model", "n_queries", (cost / F.col("n_queries")).alias("cost_per_query"), cost.alias("monthly_cost"))


def rates(log: DataFrame, ts: str) -> DataFrame:
    """Average and peak rows per second over the whole span; seconds without rows count."""
    seconds = log.groupBy(F.date_trunc("second", F.col(ts)).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    span = (F.unix_timestamp(F.max("_s")) - F.unix_timestamp(F.min("_s")) + 1).alias("seconds")
    out = seconds.agg(F.sum("_n").alias("n_rows"), span, F.max("_n").alias("peak_per_second"))
    average = F.col("n_rows") / F.col("seconds")
    return out.withColumn("avg_per_second", average).withColumn("peak_to_average", F.col("peak_per_second") / average)


def minute_rollup(log: DataFrame, ts: str, keys: Sequence[str], value: str, raw_from) -> DataFrame:
    """One-minute aggregates of the rows older than ``raw_from``."""
    old = log.where(F.col(ts) < raw_from)
    return old.groupBy(F.date_trunc("minute", F.col(ts)).alias("minute"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("peak")
    )


def raw_part(log: DataFrame, ts: str, raw_from) -> DataFrame:
    return log.where(F.col(ts) >= raw_from)


def rate_per_week(log: DataFrame, ts: str, topic: str, flag) -> DataFrame:
    """Share of flagged rows per week and topic."""
    return log.groupBy(F.date_trunc("week", F.col(ts)).alias("week"), topic).agg(
        F.count(F.lit(1)).alias("n"), F.avg(flag.cast("double")).alias("rate")
    )


#: Size of the quantile sketches, and the rank error that 99 of 100 of them stay within.
SKETCH_K, SKETCH_ERROR = 800, 0.005


def sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(*keys, sketch): a mergeable quantile sketch of the values, combined before the shuffle. Null values don't count."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_K)).alias("sketch"))


def merged_sketches(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of finer keys (a key's days, say) put together."""
    return stored.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_percentile(merged: DataFrame, key: str, p: float) -> DataFrame:
    return merged.select(key, F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("percentile"))


def rank_errors(df: DataFrame, estimates: DataFrame, key: str, value: str, p: float) -> DataFrame:
    """(key, n, rank_error): how far the share of values up to the estimate is from ``p``, counted exactly.

    Among equal values every rank that they span is right.
    """
    both = df.where(F.col(value).isNotNull()).join(broadcast_if_small(estimates), key)
    at, below = F.count(F.when(F.col(value) <= F.col("percentile"), 1)), F.count(F.when(F.col(value) < F.col("percentile"), 1))
    counted = both.groupBy(key).agg(F.count(F.lit(1)).alias("n"), at.alias("_at"), below.alias("_below"))
    off = F.greatest(F.col("_below") / F.col("n") - p, p - F.col("_at") / F.col("n"), F.lit(0.0))
    return counted.select(key, "n", off.alias("rank_error"))


def exact_percentile(df: DataFrame, key: str, value: str, p: float) -> DataFrame:
    """Interpolated percentile per key, exact, without gathering a key's values.

    A sketch names a narrow range around the percentile. One pass counts each key's values below the range and,
    by value, those inside it; the two wanted positions are picked there. A key whose positions lie outside
    after all (sketches err, seldom) is counted over all its values.
    """
    usable = df.where(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias("_v"))
    made = through_table(sketches(usable, [key], "_v"), "sketches")
    near = [F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, p + e)))) for e in (-2 * SKETCH_ERROR, 2 * SKETCH_ERROR)]
    ranges = made.select(key, near[0].alias("_lo"), near[1].alias("_hi"))

    def picked(ranges: DataFrame) -> DataFrame:
        """(key, percentile), null where the range misses a position."""
        placed = usable.join(broadcast_if_small(ranges), key)
        level = F.when(F.col("_v") < F.col("_lo"), F.lit(None)).otherwise(F.col("_v"))
        counts = placed.where(F.col("_v") <= F.col("_hi")).groupBy(key, level.alias("_at")).agg(F.count(F.lit(1)).alias("_c"))
        counts = counts.join(made.select(key, F.kll_sketch_get_n_double("sketch").alias("_n")), key)
        slice_ = F.coalesce(F.width_bucket("_at", "_lo", F.col("_hi") + 1e-300, F.lit(64)), F.lit(-1))
        cut = counts.join(broadcast_if_small(ranges), key).withColumn("_slice", F.when(F.col("_at").isNull(), -1).otherwise(F.coalesce(slice_, F.lit(0))))
        summed = carried_sum(cut.drop("_lo", "_hi"), key, "_slice", [F.col("_at")], F.col("_c").cast("double"))
        last = F.col("_before") + F.col("_local") - 1
        wanted = (F.col("_n") - 1) * F.lit(p)

        def found(position: Column) -> Column:
            here = F.col("_at").isNotNull() & (last - F.col("_c") + 1 <= position) & (last >= position)
            return F.max(F.when(here, F.col("_at")))

        ends = summed.groupBy(key).agg(
            found(F.floor(wanted)).alias("_a"), found(F.ceil(wanted)).alias("_b"), F.max(wanted - F.floor(wanted)).alias("_part")
        )
        return ends.select(key, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("percentile"))

    first = through_table(picked(ranges), "percentiles")
    missed = ranges.join(first.where(F.col("percentile").isNull()).select(key), key, "left_semi")
    right = first.where(F.col("percentile").isNotNull())
    if missed.isEmpty():
        return right
    whole = missed.select(key, F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"))
    return right.unionByName(picked(whole))


def approximate_percentile(df: DataFrame, key: str, value: str, p: float, accuracy: int = 10_000) -> DataFrame:
    """Sketch-based percentile per key: one pass, combined before the shuffle."""
    return df.groupBy(key).agg(F.percentile_approx(value, p, accuracy).alias("percentile"))
