"""The store of a replica: attempts and their commits, folding by file, clean-up, sync by key."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_apply import as_state, make_target, random_case, replay
from test_decode import make_log

from changeflow import CUSTOMERS_TO_LOWER as LOWER
from changeflow import CUSTOMERS_TO_UPPER as UPPER_SIDE
from changeflow.model import CHANGE
from changeflow.operators import sync
from changeflow.operators.capture import chunk_events, snapshot_events, with_position
from changeflow.operators.compact import latest_per_key
from changeflow.operators.decode import change_rows, decode
from changeflow.operators.merge import apply_batch
from changeflow.plans.queries import TURNS_FEED
from changeflow.sources.log import stream_log, write_log
from changeflow.sources.tables import in_range, key_ranges, range_predicates
from changeflow.streaming import commits
from changeflow.streaming import replica as store
from changeflow.streaming import sync as two_way


@pytest.fixture
def case(spark, tmp_path):
    rows, values = random_case(21)
    path = str(tmp_path / "replica")
    store.create_replica(make_target(spark, rows), path, LOWER)
    return rows, values, path


def batch_of(spark, values, first, last):
    log = make_log(spark, values).where((F.col("offset") >= first) & (F.col("offset") < last))
    return store.slim(decode(log, LOWER))


@pytest.mark.parametrize("dies_at", [0, 1, 2, 3])
def test_a_fault_anywhere_shows_the_old_batch(spark, case, monkeypatch, dies_at):
    """Whichever write fails, also the commit itself, readers see the state before, then all of it."""
    rows, values, path = case
    half = len(values) // 2
    store.write_batch(batch_of(spark, values, 0, half), path, LOWER, 0)
    before = as_state(store.read_replica(spark, path, LOWER))
    done, write, commit = [], store._write, commits.commit

    def failing(f):
        def run(*args, **kwargs):
            if len(done) == dies_at:
                raise OSError("gone")
            done.append(1)
            return f(*args, **kwargs)

        return run

    monkeypatch.setattr(store, "_write", failing(write))
    monkeypatch.setattr(store.log, "commit", failing(commit))
    with pytest.raises(OSError):
        store.write_batch(batch_of(spark, values, half, len(values)), path, LOWER, 1)
    monkeypatch.undo()
    assert as_state(store.read_replica(spark, path, LOWER)) == before
    assert store.read_counters(spark, path).agg(F.sum("records")).first()[0] == half
    store.write_batch(batch_of(spark, values, half, len(values)), path, LOWER, 1)
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)
    assert store.read_counters(spark, path).agg(F.sum("records")).first()[0] == len(values)


def test_readers_during_a_repeated_batch(spark, case, monkeypatch):
    """Between any two steps of a repetition a reader finds the batch as it was before."""
    rows, values, path = case
    batch = batch_of(spark, values, 0, len(values))
    store.write_batch(batch, path, LOWER, 0)
    seen, write = [], store._write

    def looking(df, where):
        write(df, where)
        seen.append(as_state(store.read_replica(spark, path, LOWER)))

    monkeypatch.setattr(store, "_write", looking)
    store.write_batch(batch, path, LOWER, 0)
    assert len(seen) == 3 and all(s == replay(rows, values) for s in seen)


def test_two_writers_never_take_the_same_version(spark, tmp_path, monkeypatch):
    path, last = str(tmp_path), commits._last_version
    for i in range(3):
        commits.commit(spark, path, commits.BATCH, i, f"a{i}")
    # As if the list was read before the other writer's commit.
    calls = []
    monkeypatch.setattr(commits, "_last_version", lambda f: 1 if not calls.append(1) and len(calls) == 1 else last(f))
    assert commits.commit(spark, path, commits.BATCH, 1, "again") == 4
    snap = commits.snapshot(spark, path)
    assert [(c.batch_id, c.attempt) for c in snap.batches] == [(0, "a0"), (1, "again"), (2, "a2")]


def parts_of(path):
    found = []
    for folder, _, files in os.walk(path):
        found += [os.path.join(folder, f) for f in files if f.startswith("part-")]
    return set(found)


def test_a_held_reader_survives_clean_up(spark, case):
    rows, values, path = case
    half = len(values) // 2
    store.write_batch(batch_of(spark, values, 0, half), path, LOWER, 0)
    with commits.held(spark, path) as snap:
        reader = store.read_replica(spark, path, LOWER, snap=snap)
        store.write_batch(batch_of(spark, values, half, len(values)), path, LOWER, 1)
        store.write_batch(batch_of(spark, values, half, len(values)), path, LOWER, 1)
        store.fold_replica(spark, path, LOWER)
        store.clean_replica(spark, path, LOWER, retain_seconds=0)
        assert as_state(reader) == replay(rows, values[:half])
        assert as_state(store.read_replica(spark, path, LOWER, snap=snap)) == replay(rows, values[:half])
    before = parts_of(path)
    letters = store.read_dead_letters(spark, path).count()
    assert store.clean_replica(spark, path, LOWER, retain_seconds=0) > 0
    assert len(parts_of(path)) < len(before)
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)
    assert store.read_counters(spark, path).agg(F.sum("records")).first()[0] == len(values)
    assert store.read_dead_letters(spark, path).count() == letters > 0
    assert store.clean_replica(spark, path, LOWER, retain_seconds=0) == 0
    assert not [f for f in parts_of(path) if "/changes/" in f]
    # The store goes on.
    store.write_batch(batch_of(spark, values, 0, half), path, LOWER, 2)
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def test_clean_up_keeps_what_is_recent(spark, case):
    rows, values, path = case
    store.write_batch(batch_of(spark, values, 0, len(values)), path, LOWER, 0)
    store.fold_replica(spark, path, LOWER)
    before = parts_of(path)
    assert store.clean_replica(spark, path, LOWER) == 0
    assert parts_of(path) == before
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def upserts(spark, ids, name, first_offset=0):
    rows = spark.createDataFrame([(i, name) for i in ids], "id long, first_name string").selectExpr(
        "id", "first_name", "'b' AS last_name", "'c' AS email"
    )
    return with_position(snapshot_events(rows, LOWER, 1), F.col("row_key.ID") + first_offset)


def test_folding_rewrites_only_files_with_a_changed_key(spark, tmp_path):
    path = str(tmp_path / "replica")
    target = spark.range(0, 40_000, 2).selectExpr("id", "'a' AS first_name", "'b' AS last_name", "'c' AS email")
    store.create_replica(target, path, LOWER, files=20)
    old = {r["file"]: r for r in store.read_index(spark, path, LOWER).collect()}
    assert len(old) == 20 and sum(r["rows"] for r in old.values()) == 20_000
    ranges = sorted((r["low"]["id"], r["high"]["id"]) for r in old.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    # Twenty keys, next to one another; and two that are new, in the span of another file.
    changed = list(range(10_000, 10_040, 2))
    holding = {f for f, r in old.items() if any(r["low"]["id"] <= i <= r["high"]["id"] for i in changed)}
    log = upserts(spark, changed, "new").unionByName(upserts(spark, [30_001, 30_003], "added"))
    store.write_batch(store.slim(decode(log, LOWER)), path, LOWER, 0)
    want = sorted(map(tuple, store.read_replica(spark, path, LOWER).collect()))
    store.fold_replica(spark, path, LOWER, files=1)
    new = {r["file"] for r in store.read_index(spark, path, LOWER).collect()}
    assert set(old) - new == holding and len(holding) <= 2
    assert len(new - set(old)) == 1
    assert sorted(map(tuple, store.read_replica(spark, path, LOWER).collect())) == want
    assert len(want) == 20_002 and sum(r[1] == "new" for r in want) == 20
    # A read of a few keys opens the files that may have them, and no others.
    some = store.read_replica(spark, path, LOWER, keys=spark.createDataFrame([(4,), (8,)], "id long"))
    assert sorted(r["id"] for r in some.collect()) == [4, 8]
    assert len([f for f in some.inputFiles() if "/base/" in f]) == 1


def test_folding_deletes_and_late_changes(spark, case):
    rows, values, path = case
    third = len(values) // 3
    for i, (a, b) in enumerate([(2 * third, len(values)), (0, third), (third, 2 * third)]):
        store.write_batch(batch_of(spark, values, a, b), path, LOWER, i)
        store.fold_replica(spark, path, LOWER, files=3)
    assert as_state(store.read_replica(spark, path, LOWER)) == replay(rows, values)


def test_a_composite_key_in_several_files(spark, tmp_path):
    path = str(tmp_path / "turns")
    turns = spark.range(900).selectExpr("id DIV 9 AS conv_id", "id % 9 AS turn", "'r' AS role", "'t' AS text")
    store.create_replica(turns, path, TURNS_FEED, files=6)
    changed = turns.where("conv_id = 50").withColumn("text", F.lit("new"))
    log = with_position(snapshot_events(changed, TURNS_FEED, 1), F.lit(0))
    store.write_batch(store.slim(decode(log, TURNS_FEED)), path, TURNS_FEED, 0)
    old = {r["file"] for r in store.read_index(spark, path, TURNS_FEED).collect()}
    store.fold_replica(spark, path, TURNS_FEED, files=1)
    assert 1 <= len(old - {r["file"] for r in store.read_index(spark, path, TURNS_FEED).collect()}) <= 2
    found = store.read_replica(spark, path, TURNS_FEED)
    assert found.count() == 900 and found.where("text = 'new'").count() == 9


def bytes_read(spark):
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalInputBytes() for i in range(executors.size()))


def test_what_a_batch_of_the_sync_reads_does_not_grow(spark, tmp_path, monkeypatch):
    """Batches over the same few keys, folded after every third."""
    rng, base = random.Random(8), str(tmp_path)
    start = [(k, "old", "x", "e") for k in range(400)]
    lower = make_target(spark, {r[0]: r[1:] for r in start})
    two_way.create_sync(lower, spark.createDataFrame(start, UPPER_SIDE.replica_schema), f"{base}/sides", LOWER, UPPER_SIDE)
    reads, sends = {}, {}
    monkeypatch.setattr(two_way, "_start", lambda log, mode, checkpoint, interval, write: sends.setdefault("write", write))
    empty = spark.createDataFrame([], "topic string, partition int, offset long, timestamp timestamp, key string, value string")
    two_way.sync_stream(empty, LOWER, UPPER_SIDE, f"{base}/sides", f"{base}/checkpoint", fold_every=3)
    logs = []
    for batch in range(12):
        parts = []
        for mapping, names in ((LOWER, LOWER.targets), (UPPER_SIDE, UPPER_SIDE.targets)):
            rows = [(rng.randrange(30), f"b{batch}", "x", "m") for _ in range(5)]
            rows = list({r[0]: r for r in rows}.values())
            schema = ", ".join(f"{n} {'bigint' if i == 0 else 'string'}" for i, n in enumerate(names))
            events = snapshot_events(spark.createDataFrame(rows, schema), mapping, batch)
            parts.append(with_position(events, F.lit(batch)))
        logs.append(parts[0].unionByName(parts[1]))
        before = bytes_read(spark)
        sends["write"](logs[-1], batch)
        reads[batch] = bytes_read(spark) - before
    early = sum(reads[b] for b in (3, 4, 5))
    late = sum(reads[b] for b in (9, 10, 11))
    assert 0 < late <= 1.5 * early, reads
    whole = logs[0]
    for part in logs[1:]:
        whole = whole.unionByName(part)
    decided = sync.decide(sync.last_of_both(whole, LOWER, UPPER_SIDE), LOWER, UPPER_SIDE)
    for side, rows, mapping in ((sync.LOWER, lower, LOWER), (sync.UPPER, spark.createDataFrame(start, UPPER_SIDE.replica_schema), UPPER_SIDE)):
        want = apply_batch(rows, sync.settled_changes(decided, side, LOWER, mapping), mapping)
        got = two_way.read_side(spark, f"{base}/sides", side, mapping)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    sent = two_way.read_writes(spark, f"{base}/sides", sync.LOWER)
    assert sent.count() > 0 and two_way.read_refused(spark, f"{base}/sides").count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_snapshot_in_chunks_under_any_interleaving(spark, tmp_path, seed):
    """Changes before, between and after the marks of every chunk, on keys of any size."""
    rng = random.Random(seed)
    ids = [0, 1, 2**40 - 1, 2**40, 2**40 + 5, 2**62, 2**63 - 1, 7, 8, -3, -(2**50)]
    source = {i: (f"s{i}", "x", "e") for i in ids if rng.random() < 0.7}
    start, history, states = dict(source), [], [dict(source)]
    names = [c.source for c in LOWER.columns]
    for offset in range(60):
        key = rng.choice(ids)
        row = (f"n{offset}", "x", "e")
        gone = rng.random() < 0.3
        source.pop(key, None) if gone else source.__setitem__(key, row)
        image = dict(zip(names, (key, *row)))
        value = {"op": "d" if gone else "u", "before": image, "after": None if gone else image, "ts_ms": offset}
        history.append(json.dumps(value))
        states.append(dict(source))
    log = make_log(spark, history)
    live = change_rows(decode(log, LOWER), LOWER)
    target = make_target(spark, start)
    chunks = key_ranges(target, LOWER, 3)
    events = None
    for chunk in chunks:
        low, read_at, high = sorted(rng.randrange(-1, 60) for _ in range(3))
        # The state after the record at ``read_at``.
        now = make_target(spark, states[read_at + 1]).where(in_range(LOWER, chunk))
        marks = [{0: low} if low >= 0 else {}, {0: high} if high >= 0 else {}]
        part = chunk_events(now, live, LOWER, *marks, 1)
        events = part if events is None else events.unionByName(part)
    both = log.select(*events.columns).unionByName(events)
    changes = latest_per_key(change_rows(decode(both, LOWER), LOWER), LOWER.keys)
    nothing = spark.createDataFrame([], LOWER.replica_schema)
    assert as_state(apply_batch(nothing, changes, LOWER)) == states[-1]


def test_key_ranges_of_equal_depth(spark):
    """Keys that crowd at one end; every key is in one range, and ranges hold about as many."""
    skewed = spark.range(20_000).selectExpr("CAST(pow(id, 3) AS BIGINT) AS id", "'a' AS first_name", "'b' AS last_name", "'c' AS email")
    ranges = key_ranges(skewed, LOWER, 10)
    sizes = [skewed.where(in_range(LOWER, r)).count() for r in ranges]
    assert len(sizes) == 10 and sum(sizes) == 20_000
    assert max(sizes) <= 2 * sorted(sizes)[5]
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        by_sql = [skewed.where(F.expr(p)).count() for p in range_predicates(LOWER, ranges)]
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")
    assert by_sql == sizes
    turns = spark.range(900).selectExpr("id DIV 9 AS conv_id", "id % 9 AS turn", "'r' AS role", "'t' AS text")
    ranges = key_ranges(turns, TURNS_FEED, 4)
    assert sum(turns.where(in_range(TURNS_FEED, r)).count() for r in ranges) == 900
    quoted = [p.replace('"', "`") for p in range_predicates(TURNS_FEED, ranges)]
    assert sum(turns.where(F.expr(p)).count() for p in quoted) == 900
    assert key_ranges(turns.where("false"), TURNS_FEED, 4) == [(None, None)]
