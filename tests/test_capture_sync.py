"""Capture, publish, compare and keep two sides in step."""

import json
from dataclasses import replace

import pytest

from changeflow import CUSTOMERS_TO_LOWER as TO_LOWER
from changeflow import CUSTOMERS_TO_UPPER as TO_UPPER
from changeflow.operators import merge, quality, route, sync
from changeflow.operators.capture import diff_events, snapshot_events, with_position
from changeflow.operators.compact import latest_per_key
from changeflow.operators.decode import change_rows, decode
from changeflow.sources import log as logs
from changeflow.sources import tables
from pyspark.sql import functions as F

# The sample rows of the two sides, in conflict on purpose.
UPPER_SEED = [
    (1, "John", "Doe", "john.doe@example.com"),
    (2, "Jane", "Smith", "jane.smith@example.com"),
    (3, "Bob", "Johnson", "bob.johnson@example.com"),
]
LOWER_SEED = [
    (1, "Alice", "Williams", "alice.williams@example.com"),
    (2, "Charlie", "Brown", "charlie.brown@example.com"),
    (3, "Diana", "Davis", "diana.davis@example.com"),
]


def frame(spark, rows, mapping):
    return spark.createDataFrame(rows, mapping.replica_schema)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def latest(log, mapping):
    return latest_per_key(change_rows(decode(log, mapping), mapping), mapping.keys)


A = [(1, "a", None, "m"), (2, "b", "", "m"), (3, "c", "z", None), (5, 'q"\\\n', "é", "漢")]
B = [(1, "a", None, "m"), (3, "c", None, "z"), (4, "new", "x", "y"), (5, "q", "é", "漢")]


@pytest.mark.parametrize("old, new", [(A, B), (B, A), ([], A), (A, []), (A, A)])
def test_applying_a_capture_leads_to_the_new_state(spark, old, new):
    a, b = frame(spark, old, TO_LOWER), frame(spark, new, TO_LOWER)
    events = diff_events(a, b, TO_LOWER, 7)
    log = with_position(events, F.lit(0))
    assert rows_of(merge.apply_batch(a, latest(log, TO_LOWER), TO_LOWER)) == rows_of(b)


def test_capture_images(spark):
    a, b = frame(spark, A, TO_LOWER), frame(spark, B, TO_LOWER)
    events = {r.key: json.loads(r.value) for r in diff_events(a, b, TO_LOWER, 7).collect()}
    assert set(events) == {'{"ID":2}', '{"ID":3}', '{"ID":4}', '{"ID":5}'}
    assert events['{"ID":2}'] == {
        "op": "d",
        "before": {"ID": 2, "FIRST_NAME": "b", "LAST_NAME": "", "EMAIL": "m"},
        "after": None,
        "source": {"schema": "DBZUSER", "table": "CUSTOMERS"},
        "ts_ms": 7,
    }
    assert events['{"ID":4}']["before"] is None and events['{"ID":4}']["op"] == "c"
    assert events['{"ID":3}']["before"]["LAST_NAME"] == "z"


def test_published_log_reads_back(spark, tmp_path):
    events = with_position(snapshot_events(frame(spark, A, TO_LOWER), TO_LOWER, 5), F.lit(3))
    tombstone = events.limit(1).withColumn("value", F.lit(None).cast("string"))
    path = str(tmp_path / "log")
    logs.write_log(events.union(tombstone), path)
    back = logs.read_log(spark, path).select(*events.columns)
    assert rows_of(back.na.fill("-")) == rows_of(events.union(tombstone).na.fill("-"))


def test_conflicting_seeds(spark):
    """With both snapshots on the way the source of truth wins a tie, and both sides agree."""
    upper, lower = frame(spark, UPPER_SEED, TO_UPPER), frame(spark, LOWER_SEED, TO_LOWER)
    lower_as_feed = snapshot_events(
        lower.toDF(*TO_UPPER.targets), TO_UPPER, 9
    )
    upper_as_feed = snapshot_events(upper.toDF(*TO_LOWER.targets), TO_LOWER, 9)
    log = with_position(lower_as_feed.union(upper_as_feed), F.lit(0))
    decided = sync.decide(sync.last_of_both(log, TO_LOWER, TO_UPPER), TO_LOWER, TO_UPPER)
    writes = sync.sync_changes(lower, upper, decided, TO_LOWER, TO_UPPER)
    assert writes.to_upper.count() == 0 and writes.refused.count() == 0
    new_lower = merge.apply_batch(lower, writes.to_lower, TO_LOWER)
    assert rows_of(new_lower) == UPPER_SEED
    compared = quality.reconcile(new_lower, upper, TO_LOWER)
    assert {r.status for r in compared.collect()} == {"match"}


UP, LOW = TO_LOWER.topic, TO_UPPER.topic


def one_change(mapping, key, name, ts_ms, offset, op="u"):
    image = dict(zip([c.source for c in mapping.columns], (key, name, "", "e")))
    value = {"op": op, "before": image, "after": None if op == "d" else image, "ts_ms": ts_ms}
    return (mapping.topic, 0, offset, "{}", json.dumps(value))


def test_conflicts(spark):
    changes = [
        # The later arrival counts inside a feed, whatever its time says.
        one_change(TO_LOWER, 1, "early", 50, 0),
        one_change(TO_LOWER, 1, "late", 10, 1),
        one_change(TO_UPPER, 1, "other", 20, 0),
        # Same time: the upper side wins.
        one_change(TO_LOWER, 2, "truth", 5, 2),
        one_change(TO_UPPER, 2, "loser", 5, 1),
        # A delete wins like any other change.
        one_change(TO_LOWER, 3, "kept", 5, 3),
        one_change(TO_UPPER, 3, "gone", 6, 2, op="d"),
        # No time at all is earlier than any.
        one_change(TO_LOWER, 4, "timeless", None, 4),
        one_change(TO_UPPER, 4, "timed", -3, 3),
    ]
    schema = "topic string, partition int, offset bigint, key string, value string"
    log = spark.createDataFrame(changes, schema)
    log = log.select(
        "topic", "partition", "offset", F.lit(None).cast("timestamp").alias("timestamp"), "key", "value"
    )
    want = {
        1: ("upsert", "other"),
        2: ("upsert", "truth"),
        3: ("delete", None),
        4: ("upsert", "timed"),
    }
    # However the log is cut, the same changes win.
    cuts = [["TRUE"], ["offset < 1", "offset >= 1"], ["offset % 2 = 1", "offset % 2 = 0"]]
    cuts += [[f"topic = '{t}'" for t in (a, b)] for a, b in ((UP, LOW), (LOW, UP))]
    for parts in cuts:
        last = None
        for part in parts:
            last = sync.last_of_both(log.where(part), TO_LOWER, TO_UPPER, last)
        decided = sync.decide(last, TO_LOWER, TO_UPPER).collect()
        got = {}
        for r in decided:
            change = r["_change"][r["_change"].winner]
            got[r.id] = (change.outcome, change.first_name)
        assert got == want, parts
    decided = sync.decide(sync.last_of_both(log, TO_LOWER, TO_UPPER), TO_LOWER, TO_UPPER)
    start = [(k, "old", "", "e") for k in (1, 2, 3, 4)]
    lower = frame(spark, start, TO_LOWER)
    upper = frame(spark, [(k, a, None, e) for k, a, _, e in start], TO_UPPER)
    writes = sync.sync_changes(lower, upper, decided, TO_LOWER, TO_UPPER)
    # A side gets what the other one won and nothing of its own.
    assert {r.id for r in writes.to_lower.collect()} == {2}
    assert {r.ID for r in writes.to_upper.collect()} == {1, 3, 4}
    held = {}
    for origin, rows, mapping in ((sync.LOWER, lower, TO_LOWER), (sync.UPPER, upper, TO_UPPER)):
        settled = sync.settled_changes(decided, origin, TO_LOWER, mapping)
        held[origin] = merge.apply_written(rows, settled, mapping)
    lower, upper = held[sync.LOWER], held[sync.UPPER]
    assert rows_of(lower) == [(1, "other", "", "e"), (2, "truth", "", "e"), (4, "timed", "", "e")]
    assert {r.status for r in quality.reconcile(lower, upper, TO_LOWER).collect()} == {"match"}


def test_a_side_keeps_what_the_other_cannot_store(spark):
    wide = "é" * 200
    changes = [
        one_change(TO_UPPER, 1, "ok", 1, 0),
        one_change(TO_UPPER, 1, wide, 2, 1),
        one_change(TO_LOWER, 2, "upper", 1, 0),
        one_change(TO_UPPER, 2, wide, 5, 2),
        # By the rules of its own side this one was never valid.
        one_change(TO_LOWER, 3, wide, 9, 1),
    ]
    schema = "topic string, partition int, offset bigint, key string, value string"
    log = spark.createDataFrame(changes, schema).withColumn("timestamp", F.lit(None).cast("timestamp"))
    decided = sync.decide(sync.last_of_both(log, TO_LOWER, TO_UPPER), TO_LOWER, TO_UPPER)
    nothing = {m: frame(spark, [], m) for m in (TO_LOWER, TO_UPPER)}
    lower = sync.settled_changes(decided, sync.LOWER, TO_LOWER, TO_LOWER)
    upper = sync.settled_changes(decided, sync.UPPER, TO_LOWER, TO_UPPER)
    lower = merge.apply_written(nothing[TO_LOWER], lower, TO_LOWER)
    upper = merge.apply_written(nothing[TO_UPPER], upper, TO_UPPER)
    assert {r.id: r.first_name for r in lower.collect()} == {1: wide, 2: wide}
    assert {r.ID: r.FIRST_NAME for r in upper.collect()} == {2: "upper"}
    refused = sync.refused_changes(decided, TO_LOWER).collect()
    assert {(r.side, r.key, r.outcome) for r in refused} == {
        ("upper", "1", "error_constraint"), ("upper", "2", "error_constraint"),
    }


def test_reconcile(spark):
    lower = frame(spark, [(1, "a", "", "e"), (2, "a", "b", "c"), (3, None, None, None)], TO_LOWER)
    upper = frame(spark, [(1, "a", None, "e"), (2, "a", "b", "d"), (4, None, None, None)], TO_UPPER)
    got = {r.key: r.status for r in quality.reconcile(lower, upper, TO_LOWER).collect()}
    assert got == {1: "match", 2: "differ", 3: "only_lower", 4: "only_upper"}


def test_constraints(spark):
    rows = [(1, "é" * 128, "b", "c"), (1, "a", None, None), (None, "a", "b", "x" * 256)]
    table = frame(spark, rows, TO_LOWER)
    in_bytes = replace(TO_LOWER, length_unit="bytes")
    expected = {
        ("length", "email", None, 256),
        ("not_null", "id", None, 1),
        ("unique", "id", "1", 2),
    }
    wide = {("length", "first_name", "1", 256)}
    for mapping, extra in ((TO_LOWER, set()), (in_bytes, wide)):
        found = quality.constraint_violations(table, mapping)
        assert {tuple(r) for r in found.collect()} == expected | extra
    both = quality.constraint_violations(table, {"c": TO_LOWER, "b": in_bytes})
    got = {tuple(r) for r in both.collect()}
    assert got == {("c", *r) for r in expected} | {("b", *r) for r in expected | wide}
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2
    pairs = replace(TO_LOWER, key_columns=2)
    unique = quality.constraint_violations(table, pairs).where("rule = 'unique'")
    assert unique.count() == 0


def test_health(spark):
    good = frame(spark, LOWER_SEED, TO_LOWER)
    empty = frame(spark, [], TO_UPPER)
    decoded = spark.createDataFrame([("upsert",)] * 3 + [("skip_no_op",)], "outcome string")

    def verdict(lower, upper, rate):
        checks = quality.sync_health(lower, upper, decoded, rate).collect()
        return {r.check_name: r.ok for r in checks}

    fine = verdict(good, good, 0.25)
    assert len(fine) == 5 and all(fine.values())
    poor = verdict(good, empty, 0.2)
    assert poor == {
        "lower_non_empty": True,
        "upper_non_empty": False,
        "counts_agree": False,
        "dead_letter_rate": False,
        "all": False,
    }


def test_routes(spark):
    names = ["oracle.DBZUSER.CUSTOMERS", "postgres.public.orders", "ddl-journal.upper", "x"]
    names.append("oracle.my.site.public.t")
    log = spark.createDataFrame([(n,) for n in names], "topic string")
    routed = {r.topic: tuple(r)[1:] for r in route.route_topics(log).collect()}
    assert routed["oracle.DBZUSER.CUSTOMERS"] == ("oracle", "DBZUSER", "CUSTOMERS", True)
    assert routed["ddl-journal.upper"] == ("ddl-journal", "upper", None, False)
    assert routed["oracle.my.site.public.t"] == ("oracle.my.site", "public", "t", True)
    assert routed["x"] == ("x", None, None, False)
    kept = route.include_tables(log, ["DBZUSER"], ["DBZUSER.CUSTOMERS", "public.orders"])
    assert [r.topic for r in kept.collect()] == ["oracle.DBZUSER.CUSTOMERS"]
    kept = route.include_tables(log, ["public"], ["public.t"])
    assert [r.topic for r in kept.collect()] == ["oracle.my.site.public.t"]
    assert route.topic_name("oracle", "DBZUSER", "CUSTOMERS") == TO_LOWER.topic


def test_kafka_options():
    options = logs.kafka_options("host:9092", topics=[TO_LOWER.topic, TO_UPPER.topic], max_offsets=9)
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "startingOffsets": "earliest",
        "subscribe": "oracle.DBZUSER.CUSTOMERS,postgres.public.customers",
        "maxOffsetsPerTrigger": "9",
    }
    by_name = logs.kafka_options("host:9092", pattern=route.FEED_PATTERN, start="latest")
    assert by_name["subscribePattern"] == route.FEED_PATTERN
    more = {"kafka.security.protocol": "SASL_SSL", "minPartitions": "64", "startingOffsets": "latest"}
    secured = logs.kafka_options("host:9092", topics=["t"], more=more)
    assert secured["kafka.security.protocol"] == "SASL_SSL" and secured["minPartitions"] == "64"
    assert secured["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        logs.kafka_options("host:9092")


def test_database_options():
    options = tables.jdbc_options("jdbc:x", "customers", "id", 0, 100, 4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    merge_rows, delete_rows = tables.merge_statements(TO_UPPER, "DBZUSER.CUSTOMERS", "STAGED")
    assert 'ON (t."ID" = s."ID")' in merge_rows
    assert 'UPDATE SET "FIRST_NAME" = s."FIRST_NAME", "LAST_NAME"' in merge_rows
    assert delete_rows.startswith("DELETE FROM DBZUSER.CUSTOMERS t WHERE EXISTS")
    # Both statements use the column that staging creates, by its exact name.
    assert all(f'"{tables.STAGED_OUTCOME}" = ' in text for text in (merge_rows, delete_rows))


def test_lookup_reaches_the_scan(spark, sf_dir):
    replica = spark.read.parquet(f"{sf_dir}/customer.parquet")
    found = tables.lookup(replica, "c_custkey", 100)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_custkey,100)" in plan


def test_catalog_listing(spark):
    spark.range(1).createOrReplaceTempView("customers_view")
    assert tables.tables_named(spark, "customers_view") == ["customers_view"]
    assert tables.tables_named(spark, "no_such_table") == []
    spark.catalog.dropTempView("customers_view")
