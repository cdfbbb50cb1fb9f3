import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rankloom import scale
from rankloom.operators import access, capacity, chunking, lifecycle, patterns, topk
from rankloom.plans import tables
from rankloom.sources import jsonl, store, versioned
from rankloom.streaming import changes


# ------------------------------------------------------------------------------ scale
def test_checkpoints_go_to_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = scale.shared_dir(spark)
    assert named is None or named.split(":")[-1] in folder
    frame = spark.range(5)
    assert scale.cut_lineage(frame).count() == 5
    assert scale.through_table(frame, "t").count() == 5


def test_derived_tables_follow_their_files(spark, tmp_path):
    def count():
        return tables._once(spark, ("t", str(tmp_path)), lambda: spark.read.parquet(f"{tmp_path}/documents.parquet")).count()

    spark.range(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert count() == 3
    built = dict(tables._BUILT)
    assert count() == 3 and tables._BUILT == built
    spark.range(2).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    assert count() == 5


def test_size_check(spark):
    frame = spark.range(100)
    assert scale.is_small(frame, 100)
    assert not scale.is_small(frame, 99)
    assert not scale.is_small(frame, 100, 10)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, rows, how):
    left = spark.range(300).select(F.col("id"), F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(250).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert rows(scale.skew_join(left, right, ["k"], how, hot_rows=50)) == rows(left.join(right, ["k"], how))


def test_dense_ids_follow_the_key(spark):
    frame = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(5)
    got = store.with_dense_id(frame, ["a", "b"]).orderBy("a", "b").collect()
    assert [r.vec_id for r in got] == list(range(1000))


# ---------------------------------------------------------------------------- sources
def test_corpus_scan(spark, tmp_path, rows):
    (tmp_path / "a.jsonl").write_text('{"doc_id":"d1","topic":"t","text":"x"}\n\n{"doc_id":"d2","text":"y"}\n')
    assert rows(jsonl.read_corpus(spark, str(tmp_path))) == [("d1", "t", "x"), ("d2", "unknown", "y")]
    (tmp_path / "b.jsonl").write_text("{not json\n")
    with pytest.raises(Exception):
        jsonl.read_corpus(spark, str(tmp_path)).collect()


def test_chunk_scan_refuses_an_empty_table(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("")
    with pytest.raises(ValueError, match="no chunks"):
        jsonl.read_chunks(spark, str(tmp_path))


def test_eval_query_scan_tolerates_a_missing_list(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"query_id":"q1","query":"a","relevant_doc_ids":["d"]}\n{"query_id":"q2","query":"b"}\n')
    got = {r.query_id: r.relevant_doc_ids for r in jsonl.read_eval_queries(spark, str(tmp_path)).collect()}
    assert got == {"q1": ["d"], "q2": []}


def test_labelled_texts(spark, rows):
    frame = jsonl.labelled_texts(spark, [{"text": "a", "label": "x"}, {"text": "b", "label": "y"}])
    assert rows(frame) == [("a", "x"), ("b", "y")]


def test_contract(spark):
    frame = spark.createDataFrame(
        [(1, "a", [1.0, 0.0]), (1, "b", [1.0]), (2, None, [0.0, 2.0])], "k bigint, c string, embedding array<float>"
    )
    report = store.contract_report(frame, ["k"], ["c"], "embedding", 2)
    assert {r.check: r.violations for r in report.collect()} == {
        "null c": 1, "wrong dimension": 1, "not unit length": 1, "duplicate key": 1,
    }
    with pytest.raises(ValueError, match="null c: 1"):
        store.enforce_contract(report)
    store.enforce_contract(store.contract_report(frame.limit(1), ["k"], ["c"], "embedding", 2))


def test_reprocessing_one_partition_leaves_the_others(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    store.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), path, ["day"])
    for _ in range(2):
        store.replace_partitions(spark.createDataFrame([(9, "b")], "v int, day string"), path, ["day"])
    assert rows(store.read_table(spark, path), "v", "day") == [(1, "a"), (9, "b")]


# -------------------------------------------------------------------------- lifecycle
def test_a_shrunken_document_leaves_one_row(spark, rows):
    def build(docs):
        return chunking.fixed_chunks(docs, 2, 0)

    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x"), (3, "gone")], "doc_id bigint, text string")
    changes = spark.createDataFrame(
        [(1, "update", 1, "p q r"), (1, "update", 2, "z"), (3, "delete", 1, None), (4, "insert", 1, "new doc")],
        "doc_id bigint, op string, seq bigint, text string",
    )
    merged = lifecycle.apply_changes(build(docs), changes, build)
    assert rows(merged, "doc_id", "chunk_index", "text") == [(1, 0, "z"), (2, 0, "x"), (4, 0, "new doc")]


def test_upsert(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(lifecycle.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


# ----------------------------------------------------------------------------- access
def test_no_row_without_a_shared_group(spark):
    rng = random.Random(5)
    groups = ["a", "b", "c", "public"]
    docs = [(i, [rng.random(), rng.random()], rng.sample(groups, rng.randint(1, 2))) for i in range(80)]
    users = {1: ["a"], 2: ["b", "public"], 3: []}
    corpus = spark.createDataFrame(docs, "doc_id bigint, embedding array<float>, acl_groups array<string>")
    asked = spark.createDataFrame([(q, q % 5, [1.0, 0.5]) for q in range(10)], "query_id bigint, user_id bigint, embedding array<float>")
    known = spark.createDataFrame(list(users.items()), "user_id bigint, groups array<string>")
    hits = access.search_as_user(asked, corpus, known, topk.VectorScorer(), 5, ["doc_id"]).collect()
    acl = {d: set(g) for d, _, g in docs}
    for hit in hits:
        assert acl[hit.doc_id] & set(users[hit.query_id % 5])
    # users 0 and 4 are unknown and user 3 has no groups: all fail closed
    assert {h.query_id % 5 for h in hits} == {1, 2}
    assert all(sum(h.query_id == q for h in hits) == 5 for q in (1, 2, 6, 7))


def test_audit_uses_the_snapshot_in_force(spark, rows):
    day = dt.datetime(2024, 1, 1)
    audit = spark.createDataFrame(
        [(1, 7, day + dt.timedelta(hours=h), ["a"], [5]) for h in range(20)]
        + [(2, 7, day - dt.timedelta(days=1), ["a"], [5])],
        "event_id bigint, user_id bigint, ts timestamp, user_acl_groups array<string>, returned_doc_ids array<bigint>",
    )
    snapshots = spark.createDataFrame(
        [(5, day, ["a"]), (5, day + dt.timedelta(hours=10), ["b"])],
        "doc_id bigint, snapshot_ts timestamp, acl_groups array<string>",
    )
    plain = access.audit_mismatches(audit, snapshots)
    split = access.audit_mismatches(audit, snapshots, hours=1)
    assert plain.count() == 10
    assert rows(plain, "event_id", "ts") == rows(split, "event_id", "ts")


# --------------------------------------------------------------------------- patterns
def event_frame(spark, rows):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, u, start + dt.timedelta(seconds=s), float(v)) for i, (u, s, v) in enumerate(rows)],
        "event_id bigint, user_id bigint, ts timestamp, value double",
    )


def test_session_gap_boundary(spark):
    frame = event_frame(spark, [(1, 0, 1), (1, 1800, 1), (1, 3601, 1), (2, 0, 1)])
    got = sorted((r.user_id, r.session, r.n_events) for r in patterns.sessions(frame).collect())
    assert got == [(1, 1, 2), (1, 2, 1), (2, 1, 1)]


def test_sessions_equal_a_plain_loop(spark):
    rng = random.Random(2)
    data = [(rng.randint(1, 3), rng.randint(0, 200_000), 1) for _ in range(400)]
    want = []
    for user in (1, 2, 3):
        times = sorted(s for u, s, _ in data if u == user)
        sizes = [1]
        for a, b in zip(times, times[1:]):
            if b - a > 1800:
                sizes.append(0)
            sizes[-1] += 1
        want += [(user, i + 1, n) for i, n in enumerate(sizes)]
    got = sorted((r.user_id, r.session, r.n_events) for r in patterns.sessions(event_frame(spark, data)).collect())
    assert got == want


def test_interval_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    a = [(rng.randint(1, 60), rng.randint(0, 50_000), 0) for _ in range(200)] + [(99, 300, 0), (98, 300, 0)]
    b = [(rng.randint(1, 60), rng.randint(0, 50_000), 0) for _ in range(200)] + [(99, 600, 0), (98, 601, 0)]
    want = sorted({u for u, s, _ in a for w, t, _ in b if u == w and abs(s - t) <= 300})
    got = patterns.within_interval(event_frame(spark, a), event_frame(spark, b), "user_id", "ts", 300)
    assert sorted(r.user_id for r in got.collect()) == want
    assert 99 in want and 98 not in want


def test_percentile_equals_numpy(spark):
    import numpy as np

    rng = random.Random(6)
    data = [(u, i, rng.choice([rng.gauss(50, 20), 7.0])) for u in (1, 2) for i in range(333)] + [(3, 0, 4.0)]
    got = capacity.exact_percentile(event_frame(spark, data), "user_id", "value", 0.99).collect()
    for row in got:
        assert row.percentile == pytest.approx(np.percentile([v for u, _, v in data if u == row.user_id], 99))
    assert len(got) == 3


def test_running_totals_across_pieces(spark, rows):
    frame = event_frame(spark, [(1, s * 50_000, s) for s in range(10)] + [(2, 5, 3)])
    out = patterns.running_total(frame, "user_id", F.to_date("ts"), [F.col("ts"), F.col("event_id")], "value")
    got = rows(out, "user_id", "event_id", "running_total")
    assert got == [(1, i, float(sum(range(i + 1)))) for i in range(10)] + [(2, 10, 3.0)]


def test_rows_and_range_differ_on_ties_only(spark, rows):
    frame = spark.createDataFrame([(1, "p", 1, 10.0), (1, "p", 2, 5.0), (1, "q", 3, 1.0)], "k int, peer string, id bigint, v double")
    out = patterns.rows_and_range_totals(frame, "k", "peer", "id", "v", slice_width=1)
    assert rows(out, "id", "rows_total", "range_total") == [(1, 10.0, 15.0), (2, 15.0, 15.0), (3, 16.0, 16.0)]


def test_rolling_active_and_islands(spark, rows):
    frame = event_frame(spark, [(1, 0, 0), (2, 86_400 * 6, 0), (1, 86_400 * 7, 0), (1, 86_400 * 8, 0)])
    active = [r.active for r in patterns.rolling_active(frame, "user_id", "ts").orderBy("day").collect()]
    assert active == [1, 2, 2, 2]
    runs = patterns.islands(frame.select("user_id", F.to_date("ts").alias("day")), "user_id", "day")
    assert rows(runs, "user_id", "n_days") == [(1, 1), (1, 2), (2, 1)]


def test_a_row_meets_one_snapshot_however_many_there_are(spark):
    """2,000 snapshots of one document and rows before, between, at and after them."""
    start = dt.datetime(2024, 1, 1)
    snaps = [(7, start + dt.timedelta(hours=3 * i), i) for i in range(2000)] + [(8, start, -1)]
    left = [(i, key, start + dt.timedelta(minutes=47 * i - 600)) for i in range(400) for key in (7, 8, 9)]
    rows_ = spark.createDataFrame(left, "row bigint, key bigint, ts timestamp")
    snapshots = spark.createDataFrame(snaps, "key bigint, at timestamp, value bigint")
    for hours in (1, 24, 10_000):
        joined = access.as_of(rows_, snapshots, "key", "ts", "at", hours)
        got = {(r.row, r.key): (r.at, r.value) for r in joined.collect()}
        want = {}
        for row, key, ts in left:
            before = [(at, value) for k, at, value in snaps if k == key and at <= ts]
            if before:
                want[row, key] = max(before)
        assert got == want and joined.count() == len(want)


def test_versions_are_kept_and_untouched_buckets_are_not_written_again(spark, tmp_path):
    rows_ = [(i, s, 0, f"text {i} {s}") for i in range(200) for s in ("a", "b")]
    frame = spark.createDataFrame(rows_, "doc_id bigint, strategy string, part int, text string")
    table = versioned.create(frame, ["doc_id"], str(tmp_path / "t"), buckets=16)
    first = table.rows()
    change = spark.createDataFrame([(3, "a", 0, "new"), (500, "a", 0, "more")], frame.schema)
    version = lifecycle.upsert_into(table, change, ["doc_id", "strategy", "part"])
    assert version == 1 and table.latest() == 1
    old, new = dict(table.manifest(0)), dict(table.manifest(1))
    touched = set(table.touched_by(change))
    assert len(touched) == 2 and {b for b in new if old.get(b) != new[b]} == touched
    want = {(d, s): t for d, s, _, t in rows_}
    assert {(r.doc_id, r.strategy): r.text for r in first.collect()} == want  # a reader keeps its version
    assert {(r.doc_id, r.strategy): r.text for r in table.rows(1).collect()} == {**want, (3, "a"): "new", (500, "a"): "more"}
    reopened = versioned.open_table(spark, str(tmp_path / "t"))
    assert reopened.buckets == 16 and reopened.rows().count() == 401 and reopened.rows(0).count() == 400
    assert table.append_new(spark.createDataFrame([(3, "a", 0, "no"), (900, "a", 0, "yes")], frame.schema), ["doc_id", "strategy", "part"]) == 1
    assert table.append_new(spark.createDataFrame([(900, "a", 0, "again")], frame.schema), ["doc_id", "strategy", "part"]) == 0
    assert table.latest() == 2 and table.rows().count() == 402


def test_change_batches_make_versions_once(spark, tmp_path):
    def build(docs):
        return chunking.fixed_chunks(docs, 2, 0)

    schema = "doc_id bigint, text string, op string, seq bigint"
    empty = build(spark.createDataFrame([], "doc_id bigint, text string"))
    table = versioned.create(empty, ["doc_id"], str(tmp_path / "t"), buckets=4)
    handle = changes.apply_batches(table, build)
    batches = [
        [(1, "a b c d e", "insert", 1), (2, "x y", "insert", 1), (3, "z", "insert", 1)],
        [(1, "short", "update", 2), (2, "x", "delete", 2)],
        [(2, "back again now", "insert", 3)],
    ]
    for i, batch in enumerate(batches):
        handle(spark.createDataFrame(batch, schema), i)
    handle(spark.createDataFrame(batches[1], schema), 1)  # a repeated batch changes nothing
    got = sorted((r.doc_id, r.chunk_index, r.text) for r in table.rows().collect())
    assert got == [(1, 0, "short"), (2, 0, "back again"), (2, 1, "now"), (3, 0, "z")] and table.latest() == 3


def test_sketched_percentiles_and_their_repair(spark, monkeypatch):
    rng = random.Random(1)
    data = [(i, 1, 0.0, rng.choice([rng.random(), 5.0, -3.0, 1e9])) for i in range(3000)] + [(9000 + i, 2, 0.0, float(i)) for i in range(3)]
    frame = spark.createDataFrame([(u, v) for _, u, _, v in data] + [(3, None)], "user_id bigint, value double")
    for p in (0.0, 0.25, 0.99, 1.0):
        want = {}
        for user in (1, 2):
            values = sorted(v for _, u, _, v in data if u == user)
            at = (len(values) - 1) * p
            low = values[int(at)]
            want[user] = low + (values[min(int(at) + 1, len(values) - 1)] - low) * (at - int(at))
        for error in (capacity.SKETCH_ERROR, 0.0):  # ranges too narrow: positions outside them are counted over all values
            monkeypatch.setattr(capacity, "SKETCH_ERROR", error)
            got = {r.user_id: r.percentile for r in capacity.exact_percentile(frame, "user_id", "value", p).collect()}
            assert got == pytest.approx(want)
    merged = capacity.merged_sketches(capacity.sketches(frame.withColumn("day", F.col("value") % 5), ["user_id", "day"], "value"), ["user_id"])
    errors = capacity.rank_errors(frame, capacity.sketch_percentile(merged, "user_id", 0.9), "user_id", "value", 0.9)
    assert all(r.rank_error <= 0.005 for r in errors.collect())


def test_large_upserts_leave_other_documents_in_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "DEALT_ROWS", 0)
    monkeypatch.setattr(versioned, "dealt_by", None)  # rows are written where they are made
    key = ["doc_id", "strategy", "part"]
    rows_ = [(i, s, p, f"text {i} {s} {p}") for i in range(60) for s in ("a", "b") for p in range(2)] + [(None, "a", 0, "no id")]
    frame = spark.createDataFrame(rows_, "doc_id bigint, strategy string, part int, text string")
    table = versioned.create(frame, ["doc_id"], str(tmp_path / "t"), buckets=4)
    change = spark.createDataFrame([(i, "a", 0, "new") for i in (3, 4, 90, None)], frame.schema)
    plan = lifecycle.upsert(frame, change, key, ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=bcast") + plan.count("strategy=broadcast") >= 2
    version = lifecycle.upsert_into(table, change, key)
    want = sorted(map(str, [r for r in rows_ if r[:3] not in {(3, "a", 0), (4, "a", 0)}] + [tuple(r) for r in change.collect()]))
    assert sorted(str(tuple(r)) for r in table.rows(version).collect()) == want
    assert table.append_new(frame.limit(0), key) == 0


def test_many_changes_are_applied_without_moving_texts(spark, tmp_path, monkeypatch):
    schema = "doc_id bigint, text string, op string, seq bigint"
    rows_ = [(i, f"a{i} b c", "insert", 1) for i in range(40)] + [(i, f"z{i} y", "delete" if i % 4 == 0 else "update", 2) for i in range(0, 40, 2)]
    rows_ += [(50, "same same same", "insert", 1)] * 2 + [(None, "none", "insert", 1), (60, "lost", "insert", None)]
    feed = spark.createDataFrame(rows_, schema)

    def build(docs):
        return chunking.fixed_chunks(docs, 2, 0)

    old = build(spark.createDataFrame([(7, "old old old old old old old"), (60, "old"), (70, "stays")], "doc_id bigint, text string"))
    got = {}
    for many in (0, 10**9):
        monkeypatch.setattr(lifecycle, "MANY_CHANGES", many)
        table = versioned.create(old, ["doc_id"], str(tmp_path / str(many)), buckets=4)
        got[many] = sorted(map(str, table.rows(lifecycle.apply_changes_to(table, feed, build)).collect()))
    assert got[0] == got[10**9] and len(got[0]) > 40
    last, _ = lifecycle._latest_in_place(feed.where("doc_id < 50"))
    assert "max_by" not in last._jdf.queryExecution().optimizedPlan().toString()
