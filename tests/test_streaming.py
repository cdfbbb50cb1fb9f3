import datetime as dt

from pyspark.sql import functions as F

from rankloom.operators import chunking, encoding
from rankloom.streaming import changes, run, state, windows

START = dt.datetime(2024, 1, 1)


def write_batches(spark, folder, batches, schema):
    """One file per batch, in order, so each trigger takes one."""
    import os
    import time

    for i, batch in enumerate(batches):
        part = f"{folder}/.tmp{i}"
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = f"{folder}/b{i:03d}.parquet"
        os.link(f"{part}/{name}", target)
        os.utime(target, (time.time() - 1000 + i, time.time() - 1000 + i))


def at(hours):
    return START + dt.timedelta(hours=hours)


EVENTS = "event_id bigint, user_id bigint, ts timestamp, value double"


def test_late_rows_are_dropped_and_reprocessed(spark, tmp_path):
    batches = [
        [(1, 1, at(0.5), 1.0), (2, 1, at(5.5), 1.0)],
        [(5, 1, at(5.6), 1.0)],  # rows are judged by the watermark of the batch before
        [(3, 1, at(0.6), 1.0), (4, 1, at(3.7), 1.0)],  # 3: window closed; 4: window open
        [(6, 1, at(72), 1.0)],
    ]
    write_batches(spark, str(tmp_path), batches, EVENTS)
    stream = run.read_stream(spark, f"{tmp_path}/b*.parquet", files_per_trigger=1)
    path = run.drain_to_table(windows.tumbling(windows.timely(stream), ["user_id"], "1 hour"), "late")
    counted = {r.started.hour: r.n for r in spark.read.parquet(path).where(F.col("started") < "2024-01-02").collect()}
    assert counted == {0: 1, 3: 1, 5: 2}

    def hourly(rows):
        return windows.tumbling(rows, ["user_id"], "1 hour").withColumn("day", F.to_date("started"))

    table = str(tmp_path / "table")
    raw = spark.read.parquet(f"{tmp_path}/b*.parquet")
    for _ in range(2):
        windows.reprocess_days(raw, hourly, table)
    fixed = {r.started.hour: r.n for r in spark.read.parquet(table).where(F.col("day") == "2024-01-01").collect()}
    assert fixed == {0: 2, 3: 1, 5: 2}


def test_windows_open_at_the_end_are_closed_whatever_the_batches(spark, tmp_path):
    batches = [[(10 * b + i, i % 2, at(b + i / 10), 1.0) for i in range(8)] for b in range(10)]
    write_batches(spark, str(tmp_path), batches, EVENTS)
    plain = spark.read.parquet(f"{tmp_path}/b*.parquet")
    newest = plain.agg(F.max("ts").alias("ts"))
    forms = {
        "tumbling": lambda rows: windows.tumbling(windows.timely(rows), ["user_id"], "1 hour"),
        "sessions": lambda rows: windows.session(windows.timely(rows), ["user_id"], "20 minutes"),
    }
    for label, build in forms.items():
        want = sorted(map(tuple, build(plain).collect()), key=str)
        for files in (None, 1):
            stream = run.read_stream(spark, f"{tmp_path}/b*.parquet", files_per_trigger=files)
            got = run.drain_and_close(build, stream, newest, label)
            assert sorted(map(tuple, got.collect()), key=str) == want


def test_closing_an_empty_stream_gives_no_rows(spark, tmp_path):
    write_batches(spark, str(tmp_path), [[]], EVENTS)
    stream = run.read_stream(spark, f"{tmp_path}/b*.parquet")
    newest = spark.read.parquet(f"{tmp_path}/b*.parquet").agg(F.max("ts").alias("ts"))
    got = run.drain_and_close(lambda rows: windows.tumbling(windows.timely(rows), ["user_id"], "1 hour"), stream, newest, "none")
    assert got.count() == 0


def test_repeated_event_ids_count_once(spark, tmp_path):
    batches = [[(1, 1, at(0), 1.0), (1, 1, at(0), 1.0)], [(1, 1, at(0.1), 1.0), (2, 1, at(0.2), 1.0)]]
    write_batches(spark, str(tmp_path), batches, EVENTS)
    stream = run.read_stream(spark, f"{tmp_path}/b*.parquet", files_per_trigger=1)
    path = run.drain_to_table(windows.once(windows.timely(stream)), "once")
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == [1, 2]


def test_running_totals_over_batches(spark, tmp_path):
    batches = [[(i, i % 2, at(0), 1.5) for i in range(20)], [(i, 1, at(1), 2.0) for i in range(20, 30)]]
    write_batches(spark, str(tmp_path), batches, EVENTS)
    stream = run.read_stream(spark, f"{tmp_path}/b*.parquet", files_per_trigger=1)
    out = str(tmp_path / "out")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    run.drain_batches(state.running_totals(stream, slices=3), keep, "totals", mode="update")
    got = {r.user_id: (r.n, r.total) for r in state.latest_totals(spark.read.parquet(out)).collect()}
    assert got == {0: (10, 15.0), 1: (20, 35.0)}


def build(docs):
    return chunking.fixed_chunks(docs, 2, 0)


CHANGES = "doc_id bigint, text string, op string, seq bigint"


def test_change_log_over_batches(spark, tmp_path, rows):
    batches = [
        [(1, "a b c d e", "insert", 1), (2, "x y", "insert", 1), (3, "z", "insert", 1)],
        [(1, "short", "update", 2), (2, "x", "delete", 2)],
        [(2, "back again now", "insert", 3)],
    ]
    write_batches(spark, str(tmp_path), batches, CHANGES)
    stream = run.read_stream(spark, f"{tmp_path}/b*.parquet", files_per_trigger=1)
    path = str(tmp_path / "log")
    run.drain_batches(stream, changes.append_changes(build, path), "log")
    want = [(1, 0, "short"), (2, 0, "back again"), (2, 1, "now"), (3, 0, "z")]
    assert rows(changes.current_chunks(spark, path), "doc_id", "chunk_index", "text") == want
    # a repeated batch changes nothing
    changes.append_changes(build, path)(spark.createDataFrame(batches[2], CHANGES), 2)
    assert rows(changes.current_chunks(spark, path), "doc_id", "chunk_index", "text") == want
    changes.compact(spark, path, str(tmp_path / "compact"))
    assert rows(changes.current_chunks(spark, str(tmp_path / "compact")), "doc_id", "chunk_index", "text") == want


def test_ingest_encodes_each_text_once(spark, tmp_path):
    batches = [[(1, "same", "insert", 1), (2, "same", "insert", 1)], [(3, "same", "insert", 1), (4, "other", "insert", 1)]]
    write_batches(spark, str(tmp_path), batches, CHANGES)
    stream = run.read_stream(spark, f"{tmp_path}/b*.parquet", files_per_trigger=1).select("doc_id", "text")
    path = str(tmp_path / "store")
    run.drain_batches(stream, changes.embed_new_chunks(build, encoding.embed, path), "ingest")
    stored = spark.read.parquet(path)
    assert sorted(r.text for r in stored.where("embedding is not null").collect()) == ["other", "same"]
    counted = changes.counted_chunks(stored)
    whole = str(tmp_path / "whole")
    all_at_once = run.read_stream(spark, f"{tmp_path}/b*.parquet").select("doc_id", "text")
    run.drain_batches(all_at_once, changes.embed_new_chunks(build, encoding.embed, whole), "ingest")
    once = changes.counted_chunks(spark.read.parquet(whole))
    assert sorted(counted.collect()) == sorted(once.collect()) and sorted(r.copies for r in counted.collect()) == [1, 3]


def test_close_pairs_from_two_streams(spark, tmp_path):
    clicks = [[(1, 7, at(0), 0.0), (2, 8, at(0), 0.0), (9, 0, at(48), 0.0)]]
    bought = [[(3, 7, at(5 / 60), 0.0), (4, 8, at(6 / 60), 0.0), (9, 1, at(48), 0.0)]]
    for name, batch in (("a", clicks), ("b", bought)):
        (tmp_path / name).mkdir()
        write_batches(spark, str(tmp_path / name), batch, EVENTS)
    a, b = (windows.timely(run.read_stream(spark, f"{tmp_path / n}/b*.parquet")) for n in ("a", "b"))
    path = run.drain_to_table(windows.close_pairs(a, b, "user_id", 300), "pairs")
    assert [r.user_id for r in spark.read.parquet(path).collect()] == [7]
