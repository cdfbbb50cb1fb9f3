"""Capacity, rates and windowed patterns over ``events``, ``orders``, ``part`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators import capacity, patterns
from rankloom.plans import duck as D
from rankloom.plans import tables
from rankloom.plans.registry import query
from rankloom.scale import through_table

K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def _k():
    return F.from_json("props", "k bigint")["k"]


@query(
    "embedding_capacity",
    f"""WITH t AS (SELECT len({D.tokens()}) AS n FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens, CAST(sum(ceil(n / 256)) AS BIGINT) AS n_vectors FROM t),
m(model, dim, price) AS (VALUES ('MiniLM-L6-v2', 384, 0.0::DOUBLE), ('text-embedding-3-small', 1536, 0.02::DOUBLE),
  ('text-embedding-3-large', 3072, 0.13::DOUBLE))
SELECT model, n_docs, n_tokens, n_vectors, n_vectors * dim * 4 AS vector_bytes, n_vectors * dim * 8 AS index_bytes,
  round(n_tokens * price / 1e6, 6) AS encode_cost FROM s, m""",
)
def embedding_capacity(spark, sf_dir):
    """Vectors, bytes and cost to encode all documents with each model."""
    out = capacity.embedding_capacity(tables.documents(spark, sf_dir))
    return out.withColumn("encode_cost", F.round("encode_cost", 6))


@query(
    "answer_cost",
    f"""WITH s AS (SELECT date_trunc('month', ts) AS month, count(*) AS n_queries, CAST(sum(500 * ({K} + 1)) AS BIGINT) AS i,
  count(*) * 500 AS o FROM events GROUP BY 1),
m(model, p, q) AS (VALUES ('Claude Sonnet 4', 3.0::DOUBLE, 15.0::DOUBLE), ('GPT-4o', 2.5::DOUBLE, 10.0::DOUBLE))
SELECT month, model, n_queries, round((i * p / 1e6 + o * q / 1e6) / n_queries, 6) AS cost_per_query,
  round(i * p / 1e6 + o * q / 1e6, 6) AS monthly_cost FROM s, m""",
)
def answer_cost(spark, sf_dir):
    """Model cost of the query log, per query and month."""
    log = tables.events(spark, sf_dir).select(
        F.date_trunc("month", "ts").alias("month"), (500 * (_k() + 1)).alias("tokens_in"), F.lit(500).alias("tokens_out")
    )
    out = capacity.answer_cost(log, "month", "tokens_in", "tokens_out")
    rounded = {c: F.round(c, 6) for c in ("cost_per_query", "monthly_cost")}
    return out.withColumns({"month": tables.plain_ts(F.col("month")), **rounded})


@query(
    "request_rates",
    """WITH s AS (SELECT date_trunc('second', ts) AS s, count(*) AS n FROM events GROUP BY 1),
t AS (SELECT CAST(sum(n) AS BIGINT) AS n_rows, date_diff('second', min(s), max(s)) + 1 AS seconds, max(n) AS peak_per_second FROM s)
SELECT n_rows, seconds, peak_per_second, round(n_rows / seconds, 6) AS avg_per_second,
  round(peak_per_second / (n_rows / seconds), 6) AS peak_to_average FROM t""",
)
def request_rates(spark, sf_dir):
    out = capacity.rates(tables.events(spark, sf_dir), "ts")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_per_second", "peak_to_average")})


RAW_FROM = "(SELECT date_trunc('day', max(ts)) - INTERVAL 7 DAYS FROM events)"


def _raw_from(log):
    return log.agg((F.date_trunc("day", F.max("ts")) - F.expr("INTERVAL 7 DAYS")).alias("t")).scalar()


@query(
    "minute_rollup",
    f"""SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS n, round(sum(value), 2) AS total, max(value) AS peak
FROM events WHERE ts < {RAW_FROM} GROUP BY 1, 2""",
)
def minute_rollup(spark, sf_dir):
    """Old events as one-minute aggregates."""
    log = tables.events(spark, sf_dir)
    out = capacity.minute_rollup(log, "ts", ["event_type"], "value", _raw_from(log))
    return out.withColumns({"minute": tables.plain_ts(F.col("minute")), "total": F.round("total", 2)})


@query("raw_retention", f"SELECT event_id, ts, event_type, value FROM events WHERE ts >= {RAW_FROM}")
def raw_retention(spark, sf_dir):
    """The last days of events, kept as they came."""
    log = tables.events(spark, sf_dir)
    kept = capacity.raw_part(log, "ts", _raw_from(log))
    return kept.select("event_id", tables.plain_ts(F.col("ts")).alias("ts"), "event_type", "value")


@query(
    "feedback_rate",
    f"""SELECT date_trunc('week', ts) AS week, {K} % 5 AS topic, count(*) AS n,
  round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END), 6) AS rate FROM events GROUP BY 1, 2""",
)
def feedback_rate(spark, sf_dir):
    """Share of thumbs-down per week and topic."""
    log = tables.events(spark, sf_dir).withColumn("topic", _k() % 5)
    out = capacity.rate_per_week(log, "ts", "topic", F.col("event_type") == "error")
    return out.withColumns({"week": F.col("week").cast("timestamp_ntz"), "rate": F.round("rate", 6)})


@query(
    "stage_latency_p99",
    f"SELECT {K} % 5 AS stage, round(quantile_cont(value, 0.99), 6) AS percentile FROM events GROUP BY 1",
)
def stage_latency_p99(spark, sf_dir):
    """Exact P99 per stage."""
    log = tables.events(spark, sf_dir).withColumn("stage", _k() % 5)
    out = capacity.exact_percentile(log, "stage", "value", 0.99)
    return out.withColumn("percentile", F.round("percentile", 6))


def _daily_sketches(spark, sf_dir) -> DataFrame:
    """Sketches of each stage and day, as they would be stored, one partition a day."""
    log = tables.events(spark, sf_dir).withColumn("stage", _k() % 5).withColumn("day", F.to_date("ts"))
    return through_table(capacity.sketches(log, ["stage", "day"], "value"), "daily-sketches")


@query("stage_latency_p99_sketch")
def stage_latency_p99_sketch(spark, sf_dir):
    """P99 per stage from the merged sketches of its days: the form for very large logs."""
    return capacity.sketch_percentile(capacity.merged_sketches(_daily_sketches(spark, sf_dir), ["stage"]), "stage", 0.99)


@query(
    "stage_latency_sketch_error",
    f"SELECT {K} % 5 AS stage, count(value) AS n, true AS within_bound FROM events GROUP BY 1 HAVING count(value) > 0",
)
def stage_latency_sketch_error(spark, sf_dir):
    """The rank of each stage's sketched P99, counted exactly, stays within the sketch's bound."""
    log = tables.events(spark, sf_dir).withColumn("stage", _k() % 5)
    errors = capacity.rank_errors(log, stage_latency_p99_sketch(spark, sf_dir), "stage", "value", 0.99)
    return errors.select("stage", "n", (F.col("rank_error") <= capacity.SKETCH_ERROR).alias("within_bound"))


KINDS = ("click", "error", "purchase", "signup", "view")


@query(
    "event_pivot",
    "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in KINDS) + " FROM events GROUP BY user_id",
)
def event_pivot(spark, sf_dir):
    """Event counts per user with one column per kind found in the data."""
    return patterns.pivoted(tables.events(spark, sf_dir), "user_id", "event_type")


@query(
    "salted_totals",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type",
)
def salted_totals(spark, sf_dir):
    out = patterns.salted_totals(tables.events(spark, sf_dir), "event_type", "ts", "value")
    return out.withColumn("total", F.round("total", 2))


@query(
    "user_sessions",
    """WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTES OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM f)
SELECT user_id, session, min(ts) AS started, max(ts) AS ended, count(*) AS n_events FROM s GROUP BY 1, 2""",
)
def user_sessions(spark, sf_dir):
    """Sessions by a gap of more than 30 minutes."""
    out = patterns.sessions(tables.events(spark, sf_dir))
    return out.withColumns({c: tables.plain_ts(F.col(c)) for c in ("started", "ended")})


@query(
    "largest_sizes_with_ties",
    """SELECT p_partkey, p_brand, p_size, place FROM (SELECT *, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS place
FROM part) WHERE place <= 3""",
)
def largest_sizes_with_ties(spark, sf_dir):
    """Parts with one of the three largest sizes of their brand."""
    parts = tables.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return patterns.nth_highest(parts, "p_brand", "p_size", 3).select("p_partkey", "p_brand", "p_size", "place")


@query(
    "active_day_runs",
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
r AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM d)
SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days FROM r GROUP BY user_id, run""",
)
def active_day_runs(spark, sf_dir):
    """Runs of consecutive active days per user."""
    return patterns.islands(tables.events(spark, sf_dir).select("user_id", F.to_date("ts").alias("day")), "user_id", "day")


@query(
    "running_totals",
    """SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
  ROWS UNBOUNDED PRECEDING), 2) AS running_total FROM orders""",
)
def running_totals(spark, sf_dir):
    """Cumulative order value per customer."""
    orders = tables.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = patterns.running_total(
        orders,
        "o_custkey",
        F.struct("o_orderdate", F.floor(F.col("o_orderkey") / 1_000_000).alias("slice")),  # so a busy day is cut as well
        [F.col("o_orderkey")],
        "o_totalprice",
    )
    return out.select("o_custkey", "o_orderkey", F.round("running_total", 2).alias("running_total"))


@query(
    "rows_and_range_totals",
    """WITH o AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
SELECT o_custkey, o_orderkey, month,
  round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY month, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS rows_total,
  round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY month RANGE UNBOUNDED PRECEDING), 2) AS range_total FROM o""",
)
def rows_and_range_totals(spark, sf_dir):
    """ROWS and RANGE frames side by side where months tie."""
    orders = tables.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.trunc("o_orderdate", "month").alias("month"), "o_totalprice"
    )
    out = patterns.rows_and_range_totals(orders, "o_custkey", "month", "o_orderkey", "o_totalprice")
    return out.select(
        "o_custkey",
        "o_orderkey",
        "month",
        F.round("rows_total", 2).alias("rows_total"),
        F.round("range_total", 2).alias("range_total"),
    )


@query(
    "rolling_active_users",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
SELECT d.day, count(DISTINCT user_id) AS active FROM d JOIN events e ON CAST(e.ts AS DATE) BETWEEN d.day - 6 AND d.day GROUP BY d.day""",
)
def rolling_active_users(spark, sf_dir):
    """Distinct users over the last seven days, per day."""
    return patterns.rolling_active(tables.events(spark, sf_dir), "user_id", "ts")


@query(
    "clicks_near_purchases",
    """SELECT DISTINCT a.user_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click'
  AND b.event_type = 'purchase' AND a.ts BETWEEN b.ts - INTERVAL 5 MINUTES AND b.ts + INTERVAL 5 MINUTES""",
)
def clicks_near_purchases(spark, sf_dir):
    """Users with a click and a purchase at most five minutes apart."""
    events = tables.events(spark, sf_dir)
    clicks = events.where(F.col("event_type") == "click")
    purchases = events.where(F.col("event_type") == "purchase")
    return patterns.within_interval(clicks, purchases, "user_id", "ts", 300)


@query(
    "source_freshness",
    f"""WITH l AS (SELECT event_type AS source, ts + to_minutes({K}) AS indexed_at, ts FROM events),
m AS (SELECT source, max(date_diff('second', ts, indexed_at)) AS max_lag_seconds, count(*) FILTER (date_diff('second', ts, indexed_at) > 30) AS n_over_30s
  FROM l GROUP BY source),
s(source, sla_minutes) AS (VALUES ('click', 5), ('view', 15), ('purchase', 60), ('signup', 60), ('error', 240))
SELECT source, max_lag_seconds, n_over_30s, CAST(sla_minutes AS BIGINT) AS sla_minutes, max_lag_seconds > sla_minutes * 60 AS breached
FROM m JOIN s USING (source)""",
)
def source_freshness(spark, sf_dir):
    """Index lag per source against its agreed limit."""
    from rankloom.streaming import freshness

    log = tables.events(spark, sf_dir).select(
        F.col("event_type").alias("source"), F.col("ts").alias("source_ts"),
        F.timestamp_add("MINUTE", _k().cast("int"), F.col("ts")).alias("indexed_at"),
    )
    limits = {"click": 5, "view": 15, "purchase": 60, "signup": 60, "error": 240}
    return freshness.against_limits(freshness.lag_per_source(log), limits)
