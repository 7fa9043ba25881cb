"""Streams give what one batch over everything gives."""

import json
import random

import pytest

from changeflow import CUSTOMERS_TO_LOWER as LOWER
from changeflow import CUSTOMERS_TO_UPPER as UPPER_SIDE
from changeflow.operators import merge, quality, sync
from changeflow.operators.capture import diff_events
from changeflow.operators.decode import decode
from changeflow.sources.log import read_log, stream_log, write_log
from changeflow.sources.tables import save_bucketed
from changeflow.sources.workspace import workspace, written
from changeflow.streaming import apply as streams
from changeflow.streaming import replica as store
from changeflow.streaming.sync import create_sync, read_side, sync_stream
from test_apply import as_state, make_target, random_case, replay
from test_decode import make_log
from pyspark.sql import functions as F


def write_parts(spark, values, path, parts):
    """The log as several files, in order of arrival."""
    log = make_log(spark, values)
    edges = [round(i * len(values) / parts) for i in range(parts + 1)]
    for a, b in zip(edges, edges[1:]):
        part = log.where((F.col("offset") >= a) & (F.col("offset") < b)).coalesce(1)
        write_log(part, path, mode="append")


@pytest.fixture
def case(spark, tmp_path):
    rows, values = random_case(21)
    path = str(tmp_path / "replica")
    store.create_replica(make_target(spark, rows), path, LOWER)
    return rows, values, str(tmp_path), path


def follow(spark, base, path, **limits):
    log = stream_log(spark, f"{base}/log", LOWER.topic, **limits)
    query = streams.apply_stream(log, LOWER, path, f"{base}/checkpoint")
    query.awaitTermination()
    return query


def test_many_batches_equal_one(spark, case):
    rows, values, base, path = case
    write_parts(spark, values, f"{base}/log", 5)
    query = follow(spark, base, path, max_files=1)
    assert len(query.recentProgress) >= 5
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)
    outcomes = decode(read_log(spark, f"{base}/log"), LOWER)
    dead = outcomes.where("outcome NOT IN ('upsert', 'delete')")
    totals = store.read_counters(spark, path)
    assert sorted(map(str, totals.collect())) == sorted(map(str, quality.outcome_stats(outcomes).collect()))
    kept = store.read_dead_letters(spark, path)
    pick = ["offset", "value", "outcome", "reason"]
    assert sorted(map(str, kept.select(*pick).collect())) == sorted(
        map(str, dead.select(*pick).collect())
    )


def test_a_log_in_parquet(spark, case):
    rows, values, base, path = case
    write_log(make_log(spark, values), f"{base}/log", file_format="parquet")
    again = read_log(spark, f"{base}/log", file_format="parquet")
    assert sorted(r.offset for r in again.collect()) == list(range(len(values)))
    follow(spark, base, path, file_format="parquet")
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def test_resume_and_nothing_new(spark, case):
    rows, values, base, path = case
    half = len(values) // 2
    log = make_log(spark, values)
    for part in (F.col("offset") < half, F.col("offset") >= half):
        write_log(log.where(part), f"{base}/log", mode="append")
        follow(spark, base, path)
    batches = store.read_changes(spark, path, LOWER).select("_change.batch_id").distinct()
    assert batches.count() == 2
    follow(spark, base, path)
    batches = store.read_changes(spark, path, LOWER).select("_change.batch_id").distinct()
    assert batches.count() == 2
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def test_a_repeated_batch_replaces_itself(spark, case):
    rows, values, base, path = case
    decoded = store.slim(decode(make_log(spark, values), LOWER))
    for _ in range(2):
        store.write_batch(decoded, path, LOWER, 0)
    changes = store.read_changes(spark, path, LOWER)
    assert changes.count() == changes.select("id").distinct().count()
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)
    assert store.read_counters(spark, path).agg(F.sum("records")).first()[0] == len(values)


def test_counters_outlast_what_spark_remembers(spark, case):
    rows, values, base, path = case
    write_parts(spark, values, f"{base}/log", 7)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = follow(spark, base, path, max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(query.recentProgress) <= 2
    assert store.read_counters(spark, path).agg(F.sum("records")).first()[0] == len(values)


def test_files_that_arrive_late_are_read(spark, case):
    """A file may be much older, by its time stamp, than the newest one read before."""
    import glob
    import os
    import time

    rows, values, base, path = case
    half = len(values) // 2
    log = make_log(spark, values)
    write_log(log.where(F.col("offset") < half).coalesce(1), f"{base}/log", mode="append")
    follow(spark, base, path)
    seen = set(glob.glob(f"{base}/log/**/part-*", recursive=True))
    write_log(log.where(F.col("offset") >= half).coalesce(1), f"{base}/log", mode="append")
    old = time.time() - 400 * 86400
    late = set(glob.glob(f"{base}/log/**/part-*", recursive=True)) - seen
    for file in late:
        os.utime(file, (old, old))
    follow(spark, base, path)
    assert late
    assert store.read_counters(spark, path).agg(F.sum("records")).first()[0] == len(values)
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def test_torn_lines_keep_their_text(spark, case):
    rows, values, base, path = case
    write_log(make_log(spark, values).coalesce(1), f"{base}/log")
    torn = ['{"partition":0,"offset":7,"val', "no json", '{"partition":0,"offset":"x","value":"y"}']
    with open(f"{base}/log/topic={LOWER.topic}/part-torn.json", "w") as file:
        file.write("\n".join(torn))
    dead = decode(read_log(spark, f"{base}/log"), LOWER).where("outcome = 'error_torn'")
    assert sorted((r.value, r.offset, r.key) for r in dead.collect()) == sorted((t, None, None) for t in torn)
    follow(spark, base, path)
    kept = store.read_dead_letters(spark, path).where("outcome = 'error_torn'")
    assert sorted(r.value for r in kept.collect()) == sorted(torn)
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def test_a_batch_that_fails_half_way_is_repeated(spark, case, monkeypatch):
    rows, values, base, path = case
    write_parts(spark, values, f"{base}/log", 3)
    log = stream_log(spark, f"{base}/log", LOWER.topic, max_files=1)
    calls = []

    def broken(slimmed, path, mapping, batch_id):
        store.write_batch(slimmed, path, mapping, batch_id)
        calls.append(batch_id)
        if batch_id == 1:
            raise OSError("the disk is gone")

    monkeypatch.setattr(streams, "write_batch", broken)
    with pytest.raises(Exception, match="the disk is gone"):
        streams.apply_stream(log, LOWER, path, f"{base}/checkpoint").awaitTermination()
    monkeypatch.undo()
    # The changes of batch 1 are written, but the stream does not know that.
    assert calls[-1] == 1
    follow(spark, base, path, max_files=1)
    changes = store.read_changes(spark, path, LOWER)
    changes = changes.withColumn("batch_id", F.col("_change.batch_id"))
    assert {r.batch_id for r in changes.select("batch_id").distinct().collect()} == {0, 1, 2}
    per_batch = changes.groupBy("batch_id", "id").count()
    assert per_batch.where("count > 1").count() == 0
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def test_late_batch_with_older_offsets_does_not_undo_a_newer_change(spark, case):
    rows, values, base, path = case
    half = len(values) // 2
    log = make_log(spark, values)
    for batch, part in enumerate((F.col("offset") >= half, F.col("offset") < half)):
        store.write_batch(store.slim(decode(log.where(part), LOWER)), path, LOWER, batch)
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)
    by_arrival = store.read_replica(spark, path, LOWER, order=store.BY_BATCH)
    assert as_state(by_arrival) == replay(rows, values[half:] + values[:half])


def test_folding_between_batches_of_a_running_stream(spark, case):
    """The later records come first; after they are folded the earlier ones still lose."""
    rows, values, base, path = case
    third = len(values) // 3
    log = make_log(spark, values)
    parts = [F.col("offset") >= 2 * third, F.col("offset") < third]
    parts.append((F.col("offset") >= third) & (F.col("offset") < 2 * third))
    write_log(log.where(parts[0]).coalesce(1), f"{base}/log")
    feed = stream_log(spark, f"{base}/log", LOWER.topic)
    query = streams.apply_stream(feed, LOWER, path, f"{base}/checkpoint", interval="0 seconds")
    try:
        query.processAllAvailable()
        assert store.fold_replica(spark, path, LOWER) == 0
        assert store.folded_upto(spark, path) == 0
        assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values[2 * third :])
        for part in parts[1:]:
            write_log(log.where(part).coalesce(1), f"{base}/log", mode="append")
            query.processAllAvailable()
            assert query.isActive
            store.fold_replica(spark, path, LOWER)
    finally:
        query.stop()
    assert store.fold_replica(spark, path, LOWER) == store.folded_upto(spark, path) == 2
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)
    # What is folded is not read again.
    assert store.read_changes(spark, path, LOWER, after=2).count() == 0


def test_state_of_the_stream(spark, case):
    rows, values, base, _ = case
    write_parts(spark, values, f"{base}/log", 3)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    log = stream_log(spark, f"{base}/log", LOWER.topic, max_files=1)
    store.create_store(spark, f"{base}/latest", LOWER)
    query = streams.latest_stream(log, LOWER, f"{base}/latest", f"{base}/latest-checkpoint")
    query.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    for _ in range(2):
        latest = streams.read_latest(spark, f"{base}/latest", LOWER)
        state = as_state(latest.where("_change.outcome = 'upsert'"))
        assert state == replay({}, values)
        store.fold_replica(spark, f"{base}/latest", LOWER)


def test_two_way_stream_in_any_batches(spark, tmp_path):
    rng = random.Random(4)
    records = []
    for offset in range(40):
        mapping = rng.choice([LOWER, UPPER_SIDE])
        names = [c.source for c in mapping.columns]
        name = rng.choice(["a", "b", "é" * 200])
        image = dict(zip(names, (rng.randrange(6), name, "x", f"m{offset}")))
        gone = rng.random() < 0.2
        value = {"op": "d" if gone else "u", "before": image, "after": None if gone else image}
        value["ts_ms"] = rng.randrange(20)
        records.append((mapping.topic, 0, offset, "{}", json.dumps(value)))
    schema = "topic string, partition int, offset bigint, key string, value string"
    log = spark.createDataFrame(records, schema).withColumn("timestamp", F.lit(None).cast("timestamp"))
    start = [(k, "old", "x", "e") for k in range(4)]
    lower, upper = make_target(spark, {r[0]: r[1:] for r in start}), spark.createDataFrame(start, UPPER_SIDE.replica_schema)
    decided = sync.decide(sync.last_of_both(log, LOWER, UPPER_SIDE), LOWER, UPPER_SIDE)
    want = [
        sorted(map(tuple, merge.apply_written(rows, sync.settled_changes(decided, side, LOWER, m), m).collect()))
        for side, rows, m in ((sync.LOWER, lower, LOWER), (sync.UPPER, upper, UPPER_SIDE))
    ]
    base = str(tmp_path)
    create_sync(lower, upper, f"{base}/sides", LOWER, UPPER_SIDE)
    for part in ("offset % 3 = 2", "offset % 3 = 0", "offset % 3 = 1"):
        write_log(log.where(part), f"{base}/log", mode="append")
        # A folder for a topic without records would be missing.
        feeds = [stream_log(spark, f"{base}/log", m.topic) for m in (LOWER, UPPER_SIDE)]
        query = sync_stream(feeds[0].unionByName(feeds[1]), LOWER, UPPER_SIDE, f"{base}/sides", f"{base}/checkpoint")
        query.awaitTermination()
    got = [
        sorted(map(tuple, read_side(spark, f"{base}/sides", side, m).collect()))
        for side, m in ((sync.LOWER, LOWER), (sync.UPPER, UPPER_SIDE))
    ]
    assert got == want


class FakeSession:
    """A session on a cluster, with or without the setting that names the shared folder."""

    def __init__(self, settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": "yarn"})()


def test_workspace(spark):
    shared = FakeSession({"spark.checkpoint.dir": "hdfs://shared/jobs/"})
    assert workspace(shared, "log").startswith("hdfs://shared/jobs/log-")
    assert workspace(shared) != workspace(shared)
    with pytest.raises(ValueError):
        workspace(FakeSession({}))
    assert workspace(spark) != workspace(spark)


def test_written_table_keeps_rows_and_knows_its_size(spark, tmp_path):
    frame = spark.range(100).withColumn("x", F.col("id") * 2)
    table = written(frame, str(tmp_path / "t"))
    assert sorted(table.collect()) == sorted(frame.collect())


def test_bucketed_replicas_do_not_move(spark, tmp_path):
    rows = spark.range(2000).selectExpr(
        "id", "'a' AS first_name", "'b' AS last_name", "CAST(id AS STRING) AS email"
    )
    target = save_bucketed(rows, "replica_bucketed", "id", 4, str(tmp_path / "a"))
    changed = rows.where("id >= 1000").selectExpr(
        "id + 500 AS id", "'new' AS first_name", "last_name", "email", "struct('upsert' AS outcome) AS _change"
    )
    changes = save_bucketed(changed, "changes_bucketed", "id", 4, str(tmp_path / "b"))

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange")

    try:
        merged = merge.apply_batch(target, changes, LOWER)
        assert exchanges(merged) == 0
        assert merged.count() == 2500
        assert merged.where("first_name = 'new'").count() == 1000
        upper = changes.select(
            *[F.col(c.target).alias(c.source) for c in LOWER.columns]
        )
        compared = quality.reconcile(target, upper, LOWER)
        assert exchanges(compared) == 0
        assert compared.count() == 2500
        captured = diff_events(target, changes, LOWER, 1)
        assert exchanges(captured) == 0
        assert captured.count() == 2500
        # Against a side that is stored in any other way, only that side moves.
        moving = rows.repartition(3).withColumn("_change", F.struct(F.lit("upsert").alias("outcome")))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        one_side = merge.apply_batch(target, moving, LOWER)
        assert one_side.count() == 2000
        assert exchanges(one_side) == 2  # the repartition above and the move to the buckets
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE replica_bucketed")
        spark.sql("DROP TABLE changes_bucketed")
