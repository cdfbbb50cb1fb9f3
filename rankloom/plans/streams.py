"""Structured Streaming queries: the tables are read as streams and drained.

Append mode emits a window once the watermark (newest event less two hours) has
passed its end. Windows open at the end of the table are closed by a later, empty
row, so results hold every window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators import chunking, encoding
from rankloom.plans import duck as D
from rankloom.plans import tables
from rankloom.plans.registry import query
from rankloom.plans.upkeep import CHANGED_DOCS, OVERLAP, SIZE, change_feed
from rankloom.scale import cut_lineage, scratch_path
from rankloom.session import apply_settings
from rankloom.sources import store, versioned
from rankloom.streaming import alarms, changes, freshness, late, run, windows


def _stream(spark, sf_dir, name: str) -> DataFrame:
    # a stream source takes a folder or a pattern; the braces make the path one, be it a file or a folder
    return run.read_stream(spark, f"{sf_dir}/{{{name}}}.parquet")


def _event_stream(spark, sf_dir) -> DataFrame:
    apply_settings(spark)
    events = _stream(spark, sf_dir, "events")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: tables.plain_ts(F.col(c)) for c in columns})


def _drained(spark, stream: DataFrame, label: str) -> DataFrame:
    path = run.drain_to_table(stream, label)
    return spark.read.schema(stream.schema).parquet(path)


def _closed(spark, sf_dir, label: str, build, stream: DataFrame) -> DataFrame:
    newest = tables.events(spark, sf_dir).agg(F.max("ts").alias("ts"))
    return run.drain_and_close(build, stream, newest, label)


@query(
    "stream_tumbling",
    """WITH w AS (SELECT date_trunc('minute', ts) AS started, user_id % 10 AS store FROM events WHERE event_type = 'purchase')
SELECT started, started + INTERVAL 1 MINUTE AS ended, store, count(*) AS n FROM w GROUP BY started, store""",
)
def stream_tumbling(spark, sf_dir):
    """Purchases per minute and store."""
    events = _event_stream(spark, sf_dir).withColumn("store", F.col("user_id") % 10)
    bought = events.where(F.col("event_type") == "purchase")
    out = _closed(
        spark, sf_dir, "tumbling", lambda rows: windows.tumbling(windows.timely(rows), ["store"], "1 minute"), bought
    )
    return _plain(out, "started", "ended")


@query(
    "stream_sliding",
    """WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTES, ts) - to_minutes(CAST(5 * i AS INTEGER)) AS started, event_type
  FROM events, range(2) t(i))
SELECT started, started + INTERVAL 10 MINUTES AS ended, event_type, count(*) AS n FROM w GROUP BY started, event_type""",
)
def stream_sliding(spark, sf_dir):
    """Ten-minute counts every five minutes."""

    def build(rows: DataFrame) -> DataFrame:
        return windows.sliding(windows.timely(rows), ["event_type"], "10 minutes", "5 minutes")

    return _plain(_closed(spark, sf_dir, "sliding", build, _event_stream(spark, sf_dir)), "started", "ended")


@query(
    "stream_sessions",
    """WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTES OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM f)
SELECT min(ts) AS started, max(ts) + INTERVAL 30 MINUTES AS ended, user_id, count(*) AS n FROM s GROUP BY user_id, session""",
)
def stream_sessions(spark, sf_dir):
    """Sessions with a 30-minute gap, emitted when closed."""

    def build(rows: DataFrame) -> DataFrame:
        return windows.session(windows.timely(rows), ["user_id"], "30 minutes")

    return _plain(_closed(spark, sf_dir, "sessions", build, _event_stream(spark, sf_dir)), "started", "ended")


STAGES = 6
#: Stages as SQL: spans of equal length of the events' time.
STAGE_SQL = f"""span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
staged AS (SELECT e.*, CAST((epoch_us(ts) - lo) * {STAGES} // (hi - lo + 1) AS INTEGER) AS on_time FROM events e, span)"""


def _staged(spark, sf_dir) -> tuple[DataFrame, int]:
    """(events with ``on_time``, the stage in which they arrive if nothing holds them up; seconds of a stage)."""
    events = tables.events(spark, sf_dir)
    lo, hi = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    lo, hi = (lo, hi) if lo is not None else (0, 0)
    stage = F.expr(f"cast((unix_micros(ts) - {lo}) * {STAGES} div {hi - lo + 1} as int)")
    return events.withColumn("on_time", stage), (hi - lo) // STAGES // 1_000_000 + 1


@query("stream_deduplicated", "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def stream_deduplicated(spark, sf_dir):
    """Every event arrives twice, the second time with its own batch or with a later one; idempotency keys keep one."""
    events, seconds = _staged(spark, sf_dir)
    later = F.least(F.col("on_time") + F.pmod("event_id", F.lit(2)).cast("int"), F.lit(STAGES - 1))
    copies = F.explode(F.array(F.col("on_time"), later))
    twice = events.withColumn("arrives", copies).select("event_id", "event_type", "ts", "arrives")

    def build(rows: DataFrame) -> DataFrame:  # keys are kept for longer than a copy can be late
        return windows.once(windows.timely(rows, late=f"{2 * seconds} seconds")).select("event_id", "event_type")

    kept = run.drain_in_stages(build, twice, F.col("arrives"), STAGES, "dedup", close=False)
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _sides(rows: DataFrame) -> list[DataFrame]:
    """Clicks and purchases with a watermark that both see; the closing row, which is neither, stays."""
    timely = windows.timely(rows)
    return [timely.where((F.col("event_type") == kind) | F.col("event_type").isNull()) for kind in ("click", "purchase")]


@query(
    "stream_close_pairs",
    """WITH c AS (SELECT user_id, ts FROM events WHERE event_type = 'click'),
p AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase')
SELECT DISTINCT c.user_id FROM c JOIN p ON c.user_id = p.user_id AND c.ts BETWEEN p.ts - INTERVAL 5 MINUTES AND p.ts + INTERVAL 5 MINUTES""",
)
def stream_close_pairs(spark, sf_dir):
    """Users with a click and a purchase within five minutes, from two streams in several batches."""
    events, _ = _staged(spark, sf_dir)

    def build(rows: DataFrame) -> DataFrame:
        return windows.with_company(*_sides(rows), "user_id", 300).select("user_id")

    rows = events.select("user_id", "event_type", "ts", "on_time")
    found = run.drain_in_stages(build, rows, F.col("on_time"), STAGES, "pairs", close=False)
    return found.where(F.col("user_id").isNotNull()).distinct()


@query(
    "stream_lone_clicks",
    """SELECT event_id, user_id, ts FROM events c WHERE event_type = 'click' AND user_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = c.user_id
  AND c.ts BETWEEN p.ts - INTERVAL 5 MINUTES AND p.ts + INTERVAL 5 MINUTES)""",
)
def stream_lone_clicks(spark, sf_dir):
    """Clicks that no purchase of the user comes near: an outer join of two streams, finished by the closing row."""
    events, _ = _staged(spark, sf_dir)

    def build(rows: DataFrame) -> DataFrame:
        return windows.without_company(*_sides(rows), "user_id", 300).select("event_id", "user_id", "ts")

    rows = events.select("event_id", "user_id", "event_type", "ts", "on_time")
    found = run.drain_in_stages(build, rows, F.col("on_time"), STAGES, "lone-clicks")
    return _plain(found.where(F.col("user_id").isNotNull()), "ts")


@query(
    "stream_silent_users",
    """WITH e AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following FROM events WHERE user_id IS NOT NULL)
SELECT user_id, ts AS last_seen, ts + INTERVAL 6 HOURS AS alarmed_at FROM e WHERE following IS NULL OR following - ts > INTERVAL 6 HOURS""",
)
def stream_silent_users(spark, sf_dir):
    """An alarm for each user who stays away for six hours: state with timers, over several batches."""
    events, _ = _staged(spark, sf_dir)
    name, store_class = alarms.STORE
    before = spark.conf.get(name)
    spark.conf.set(name, store_class)
    try:
        rows = events.select("user_id", "ts", "on_time")
        slices = max(alarms.SLICES, rows.count() // alarms.SLICE_EVENTS)

        def build(r: DataFrame) -> DataFrame:
            return alarms.silent_keys(r, "user_id", 6 * 3600, slices=slices)

        found = run.drain_in_stages(build, rows, F.col("on_time"), STAGES, "silent")
    finally:
        spark.conf.set(name, before)
    return _plain(found, "last_seen", "alarmed_at")


#: One event in forty arrives two stages late, if there are two more.
HELD_UP = "event_id % 40 = 7 AND on_time + 2 < {stages}"


def _arrivals(spark, sf_dir) -> tuple[str, DataFrame]:
    """Events stored as they arrive, late ones apart: (folder, rows)."""
    events, _ = _staged(spark, sf_dir)
    held_up = F.expr(HELD_UP.format(stages=STAGES))
    rows = events.withColumn("arrives", F.col("on_time") + F.when(held_up, 2).otherwise(0)).select("event_id", "event_type", "ts", "arrives")
    path = scratch_path(spark, "arrivals")
    run.feed_in_stages(rows, F.col("arrives"), STAGES, late.split_late(path), "arrivals")
    return path, late.stored_rows(spark, path)


ARRIVALS_SQL = f"""{STAGE_SQL},
arrived AS (SELECT event_id, event_type, ts, on_time + CASE WHEN {HELD_UP.format(stages=STAGES)} THEN 2 ELSE 0 END AS arrives FROM staged),
newest AS (SELECT arrives, max(max(ts)) OVER (ORDER BY arrives ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
           FROM arrived GROUP BY arrives),
late AS (SELECT a.* FROM arrived a JOIN newest USING (arrives) WHERE a.ts < before - INTERVAL 2 HOURS)"""


@query("stream_late_rows", f"WITH {ARRIVALS_SQL} SELECT event_id, arrives, ts FROM late")
def stream_late_rows(spark, sf_dir):
    """Rows that come behind the watermark, caught instead of dropped."""
    _, rows = _arrivals(spark, sf_dir)
    return _plain(rows.where("late").select("event_id", "arrives", "ts"), "ts")


@query(
    "stream_late_days",
    f"""WITH {ARRIVALS_SQL}
SELECT CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS started, event_type, count(*) AS n,
  CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM late) AS reprocessed FROM events GROUP BY ALL""",
)
def stream_late_days(spark, sf_dir):
    """Hourly counts of timely rows; days that late rows belong to are counted again: together all rows, each once."""
    _, rows = _arrivals(spark, sf_dir)
    table = scratch_path(spark, "hourly-timely")

    def hourly(some: DataFrame) -> DataFrame:
        return windows.tumbling(some, ["event_type"], "1 hour").withColumn("day", F.to_date("started"))

    windows.reprocess_days(hourly(rows.where("not late")), lambda counted: counted, table)
    days = cut_lineage(late.days_to_reprocess(rows))
    again = rows.withColumn("day", F.to_date("ts")).join(F.broadcast(days.select("day")), "day", "left_semi")  # one row a day
    windows.reprocess_days(again.drop("day"), hourly, table)
    counted = spark.read.parquet(table).join(days, "day", "left")
    return _plain(counted, "started").select("day", "started", "event_type", "n", F.col("n_late").isNotNull().alias("reprocessed"))


@query("stream_running_totals", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def stream_running_totals(spark, sf_dir):
    """Running totals per user: a plain aggregation in update mode, combined before the shuffle of each batch."""
    events = _event_stream(spark, sf_dir)
    emitted = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    path = scratch_path(spark, "totals")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run.drain_batches(emitted, keep, "totals", mode="update")
    # a user's row of the last batch that had one
    last = spark.read.parquet(path).groupBy("user_id").agg(F.max_by(F.struct("n", "total"), "batch_id").alias("t"))
    return last.select("user_id", "t.n", F.round("t.total", 2).alias("total"))


@query(
    "stream_late_and_reprocessed",
    """SELECT CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS started, event_type, count(*) AS n FROM events GROUP BY ALL""",
)
def stream_late_and_reprocessed(spark, sf_dir):
    """Raw rows appended by day; hourly counts of each day rebuilt by the nightly job, twice with one result."""
    raw = run.drain_to_table(
        _event_stream(spark, sf_dir).withColumn("day", F.to_date("ts")), "raw-events", partition_by=["day"]
    )
    table = scratch_path(spark, "hourly")

    def hourly(rows: DataFrame) -> DataFrame:
        return windows.tumbling(rows, ["event_type"], "1 hour").withColumn("day", F.to_date("started"))

    stored = spark.read.parquet(raw)
    windows.reprocess_days(stored, hourly, table)
    latest = stored.agg(F.max("day").alias("d")).scalar()
    windows.reprocess_days(stored.where(F.col("day") == latest), hourly, table)
    return _plain(spark.read.parquet(table), "started").select("day", "started", "event_type", "n")


@query(
    "stream_replay",
    """WITH w AS (SELECT date_trunc('hour', ts) AS started, event_type FROM events)
SELECT started, event_type, count(*) AS n_stream, count(*) AS n_replayed FROM w GROUP BY started, event_type""",
)
def stream_replay(spark, sf_dir):
    """The same function over the stream and over the stored events: equal for every window."""

    def build(rows: DataFrame) -> DataFrame:
        return windows.tumbling(windows.timely(rows), ["event_type"], "1 hour")

    first = _closed(spark, sf_dir, "replayed", build, _event_stream(spark, sf_dir)).withColumnRenamed("n", "n_stream")
    again = windows.tumbling(tables.events(spark, sf_dir), ["event_type"], "1 hour").withColumnRenamed("n", "n_replayed")
    both = first.join(again.drop("ended"), ["started", "event_type"], "left")
    return _plain(both, "started").select("started", "event_type", "n_stream", "n_replayed")


@query(
    "stream_audit_log",
    """SELECT CAST(ts AS DATE) AS day, event_id, user_id, 'src' || (user_id % 20) AS user_group,
  CAST(json_extract(props, '$.k') AS BIGINT) AS returned_doc_id FROM events""",
)
def stream_audit_log(spark, sf_dir):
    """Audit rows appended as they happen, partitioned by day."""
    rows = _event_stream(spark, sf_dir).select(
        F.to_date("ts").alias("day"),
        "event_id",
        "user_id",
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("user_group"),
        F.from_json("props", "k bigint")["k"].alias("returned_doc_id"),
    )
    path = run.drain_to_table(rows, "audit-stream", partition_by=["day"])
    return spark.read.parquet(path).select("day", "event_id", "user_id", "user_group", "returned_doc_id")


@query(
    "stream_freshness",
    """SELECT event_type AS source, max(60 * CAST(json_extract(props, '$.k') AS BIGINT)) AS max_lag_seconds,
  count(*) FILTER (60 * CAST(json_extract(props, '$.k') AS BIGINT) > 30) AS n_over_30s FROM events GROUP BY 1""",
)
def stream_freshness(spark, sf_dir):
    """Lag per source, kept up to date by the stream."""
    minutes = F.from_json("props", "k bigint")["k"].cast("int")
    rows = _event_stream(spark, sf_dir).select(
        F.col("event_type").alias("source"),
        F.col("ts").alias("source_ts"),
        F.timestamp_add("MINUTE", minutes, F.col("ts")).alias("indexed_at"),
    )
    path = scratch_path(spark, "freshness")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run.drain_batches(freshness.lag_per_source(rows), keep, "freshness", mode="update")
    lags = spark.read.parquet(path)
    return lags.groupBy("source").agg(
        F.max("max_lag_seconds").alias("max_lag_seconds"), F.max("n_over_30s").alias("n_over_30s")
    )


def _build(docs: DataFrame) -> DataFrame:
    return chunking.fixed_chunks(docs, SIZE, OVERLAP)


def _doc_stream(spark, sf_dir) -> DataFrame:
    apply_settings(spark)
    docs = _stream(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("source").alias("topic"), "lang", "text")


@query(
    "stream_ingest",
    D.with_(D.chunks())
    + "SELECT chunk_id, count(*) AS copies, CAST(64 AS BIGINT) AS dim FROM chunks GROUP BY chunk_id",
)
def stream_ingest(spark, sf_dir):
    """Documents as a stream: chunked, each new text encoded once, stored."""
    path = scratch_path(spark, "ingested")
    handle = changes.embed_new_chunks(_build, encoding.embed, path)
    run.drain_batches(_doc_stream(spark, sf_dir).select("doc_id", "topic", "text"), handle, "ingest")
    stored = changes.counted_chunks(store.read_table(spark, path))
    return stored.select("chunk_id", "copies", F.size("embedding").cast("bigint").alias("dim"))


@query(
    "stream_change_feed",
    D.with_(f"source_docs AS ({CHANGED_DOCS})", D.chunks().replace("FROM documents", "FROM source_docs"))
    + "SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk_id FROM chunks",
)
def stream_change_feed(spark, sf_dir):
    """Inserts, updates and deletes arriving as a stream, read as the current chunk table."""
    docs = _doc_stream(spark, sf_dir)
    empty = _build(spark.createDataFrame([], docs.schema).select("doc_id", "topic", "text"))
    table = versioned.create(empty, ["doc_id"], scratch_path(spark, "chunk-versions"))
    run.drain_batches(change_feed(docs), changes.apply_batches(table, _build), "change-feed")
    return table.rows().select("doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "chunk_id")


@query(
    "stream_change_log",
    D.with_(f"source_docs AS ({CHANGED_DOCS})", D.chunks().replace("FROM documents", "FROM source_docs"))
    + "SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk_id FROM chunks",
)
def stream_change_log(spark, sf_dir):
    """The same feed kept as an append-only log, merged when it is read."""
    path = scratch_path(spark, "chunk-log")
    feed = change_feed(_doc_stream(spark, sf_dir))
    run.drain_batches(feed, changes.append_changes(_build, path), "change-feed")
    current = changes.current_chunks(spark, path)
    return current.select("doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "chunk_id")
