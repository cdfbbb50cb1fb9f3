"""Streams in several batches against the same rows in one table."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.scale import scratch_path
from rankloom.streaming import alarms, late, run, windows

START = dt.datetime(2024, 1, 1)
EVENTS = "event_id bigint, user_id bigint, event_type string, ts timestamp, on_time int"
N = 10


@pytest.fixture(scope="module")
def events(spark):
    draw = random.Random(4)
    rows = []
    for i in range(400):
        hours = draw.uniform(0, 60)
        user = draw.choice([1, 1, 1, draw.randint(2, 12), None])
        rows.append((i, user, draw.choice(["click", "purchase", "view"]), START + dt.timedelta(hours=hours), int(hours * N / 60)))
    return spark.createDataFrame(rows, EVENTS).cache()


def sides(rows):
    timely = windows.timely(rows)
    return [timely.where((F.col("event_type") == kind) | F.col("event_type").isNull()) for kind in ("click", "purchase")]


def near(rows):
    clicks, bought = ([r for r in rows if r.event_type == kind and r.user_id is not None] for kind in ("click", "purchase"))
    close = dt.timedelta(minutes=5)
    return {c.event_id for c in clicks if any(p.user_id == c.user_id and abs(p.ts - c.ts) <= close for p in bought)}, {c.event_id for c in clicks}


@pytest.mark.parametrize("stages", [1, 4, 10])
def test_joins_of_streams_equal_the_batch_join(spark, events, stages):
    with_purchase, clicks = near(events.collect())
    stage = F.floor(F.col("on_time") * stages / N).cast("int")
    found = run.drain_in_stages(lambda r: windows.with_company(*sides(r), "user_id", 300), events, stage, stages, "pairs", close=False)
    assert {r.event_id for r in found.where("user_id is not null").collect()} == with_purchase
    lone = run.drain_in_stages(lambda r: windows.without_company(*sides(r), "user_id", 300), events, stage, stages, "lone")
    assert sorted(r.event_id for r in lone.where("user_id is not null").collect()) == sorted(clicks - with_purchase)


def test_late_rows_are_kept_apart_and_a_repeated_batch_changes_nothing(spark, events):
    held_up = (F.col("event_id") % 7 == 0) & (F.col("on_time") + 2 < N)
    rows = events.withColumn("arrives", F.col("on_time") + F.when(held_up, 2).otherwise(0))
    path = scratch_path(spark, "late-test")
    run.feed_in_stages(rows, F.col("arrives"), N, late.split_late(path), "late-test")
    seen, want = None, set()
    local = rows.collect()
    for i in range(N):
        batch = [r for r in local if r.arrives == i]
        if seen is not None:
            want |= {r.event_id for r in batch if r.ts < seen - dt.timedelta(hours=2)}
        seen = max([r.ts for r in batch] + ([seen] if seen else []))
    stored = late.stored_rows(spark, path)
    assert want and {r.event_id for r in stored.where("late").collect()} == want
    assert stored.count() == len(local)
    assert sum(r.n_late for r in late.days_to_reprocess(stored).collect()) == len(want)
    late.split_late(path)(rows.where("arrives = 3"), 3)
    again = late.stored_rows(spark, path)
    assert {r.event_id for r in again.where("late").collect()} == want and again.count() == len(local)


@pytest.mark.parametrize("stages", [1, 4])
def test_silence_is_noticed_whatever_the_batches(spark, events, stages):
    hours = 5
    want, times = set(), {}
    for r in events.collect():
        if r.user_id is not None:
            times.setdefault(r.user_id, []).append(r.ts)
    for user, ts in times.items():
        ts.sort()
        want |= {(user, a) for a, b in zip(ts, ts[1:] + [None]) if b is None or b - a > dt.timedelta(hours=hours)}
    name, store = alarms.STORE
    before = spark.conf.get(name)
    spark.conf.set(name, store)
    try:
        stage = F.floor(F.col("on_time") * stages / N).cast("int")
        rows = events.select("user_id", "ts", "on_time")
        found = run.drain_in_stages(lambda r: alarms.silent_keys(r, "user_id", hours * 3600), rows, stage, stages, "silent")
        got = {(r.user_id, r.last_seen) for r in found.collect()}
    finally:
        spark.conf.set(name, before)
    assert got == want


def batches_and_partitions(state):
    """(batches run, partitions of the state) of a stream, by its checkpoint."""
    return len([f for f in (state / "commits").iterdir() if f.name.isdigit()]), len([f for f in (state / "state" / "0").iterdir() if f.name.isdigit()])


def test_state_follows_the_rows_not_the_shuffles(spark, events, tmp_path, monkeypatch):
    monkeypatch.setattr(run, "scratch_path", lambda _, label: str(tmp_path / label))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        lone = run.drain_in_stages(lambda r: windows.without_company(*sides(r), "user_id", 300), events, F.floor(F.col("on_time") / 5), 2, "few")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "23"
        assert run.state_partitions(spark, 7 * run.STATE_ROWS) == 7 and run.state_partitions(spark, 70 * run.STATE_ROWS) == 23
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with_purchase, clicks = near(events.collect())
    assert sorted(r.event_id for r in lone.where("user_id is not null").collect()) == sorted(clicks - with_purchase)
    # two stages, the closing row, and one batch that finishes; as many partitions as cores
    assert batches_and_partitions(tmp_path / "few-state") == (4, spark.sparkContext.defaultParallelism)


def test_runs_are_merged_whatever_the_pieces():
    draw = random.Random(5)
    for _ in range(50):
        points = [(draw.choice("abc"), draw.randint(0, 100)) for _ in range(draw.randint(1, 40))]
        want = []
        for key, at in sorted(points):
            if want and want[-1][0] == key and at - want[-1][2] <= 5:
                want[-1][2] = at
            else:
                want.append([key, at, at])
        cut = draw.randint(0, len(points))
        held = (np.empty(0, object), np.empty(0, np.int64), np.empty(0, np.int64))
        for part in (points[:cut], points[cut:]):
            if part:
                keys, us = np.array([k for k, _ in part], object), np.array([t for _, t in part])
                held = alarms.merged(*(np.concatenate(p) for p in zip(held, (keys, us, us))), 5)
        assert sorted(map(list, zip(*held))) == want


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_silence_of_keys_that_share_a_state(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(run, "scratch_path", lambda _, label: str(tmp_path / label))
    big = 2**53 + 1  # keys that no floating number holds, beside rows without a key
    rows = [(None if i % 9 == 0 else big + i % 40, START + dt.timedelta(hours=(i * 7919) % 97), None) for i in range(300)]
    rows = [(user, ts, int(ts >= START + dt.timedelta(hours=50))) for user, ts, _ in rows]
    table = spark.createDataFrame(rows, "user_id bigint, ts timestamp, on_time int").withColumn("user_id", F.expr(f"cast(user_id as {kind})"))
    want, times = set(), {}
    for r in table.collect():
        if r.user_id is not None:
            times.setdefault(r.user_id, []).append(r.ts)
    for user, ts in times.items():
        ts.sort()
        want |= {(user, a) for a, b in zip(ts, ts[1:] + [None]) if b is None or b - a > dt.timedelta(hours=5)}
    name, store = alarms.STORE
    before = spark.conf.get(name)
    spark.conf.set(name, store)
    try:
        found = run.drain_in_stages(lambda r: alarms.silent_keys(r, "user_id", 5 * 3600, slices=3), table, F.col("on_time"), 2, "shared")
        got = [(r.user_id, r.last_seen) for r in found.collect()]
    finally:
        spark.conf.set(name, before)
    assert len(got) == len(set(got)) and set(got) == want
