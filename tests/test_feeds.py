"""Many tables from one stream: routing, patterns, a table that cannot be written."""

import pytest
from pyspark.sql import functions as F

from changeflow import CUSTOMERS_TO_LOWER as LOWER
from changeflow.model import Column, TableMapping
from changeflow.operators.capture import snapshot_events, with_position
from changeflow.sources.log import stream_topics, write_log
from changeflow.streaming import feeds as many
from changeflow.streaming import replica as store

PARTS = TableMapping(topic="oracle.DBZUSER.PARTS", columns=(Column("P", "p", "bigint"), Column("N", "n")))
OTHERS = TableMapping(topic="ddl.x.y", columns=(Column("P", "p", "bigint"), Column("N", "n")))


def events(spark, mapping, ids, name, offset):
    cols = [F.lit(name).cast(c.type).alias(c.target) if i else F.col("id").alias(c.target) for i, c in enumerate(mapping.columns)]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").select(*cols)
    return with_position(snapshot_events(rows, mapping, 1), F.lit(offset))


def start(spark, base):
    feeds = many.registry([LOWER, PARTS])
    empty = {t: spark.createDataFrame([], m.replica_schema) for t, m in feeds.items()}
    many.create_feeds(empty, f"{base}/feeds", feeds)
    return feeds


def follow(spark, base, feeds):
    stream = stream_topics(spark, f"{base}/log", r"oracle\..*")
    many.apply_feeds(stream, feeds, f"{base}/feeds", f"{base}/checkpoint").awaitTermination()


def held(spark, base, mapping):
    rows = store.read_replica(spark, many.replica_path(f"{base}/feeds", mapping.topic), mapping)
    return {r[0]: r[1] for r in rows.collect()}


def test_a_table_that_fails_is_parked_and_put_in_later(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    feeds = start(spark, base)
    write = many.write_batch

    def failing(slimmed, path, mapping, batch_id):
        if mapping.topic == PARTS.topic:
            raise OSError("no room")
        write(slimmed, path, mapping, batch_id)

    for offset in range(3):
        write_log(events(spark, LOWER, [1, 2], f"a{offset}", offset), f"{base}/log", mode="append")
        write_log(events(spark, PARTS, [7, offset], f"p{offset}", offset), f"{base}/log", mode="append")
        write_log(events(spark, OTHERS, [9], "x", offset), f"{base}/log", mode="append")
        # The second batch fails; the third one is applied before the second is put in.
        monkeypatch.setattr(many, "write_batch", failing if offset == 1 else write)
        follow(spark, base, feeds)
    assert held(spark, base, LOWER) == {1: "a2", 2: "a2"}
    assert held(spark, base, PARTS) == {7: "p2", 0: "p0", 2: "p2"}
    parked = many.read_parked(spark, f"{base}/feeds", feeds)
    assert {(r.topic, r.batch_id, r.offset) for r in parked.collect()} == {(PARTS.topic, 1, 1)}
    assert many.replay_parked(spark, f"{base}/feeds", PARTS) == 1
    assert held(spark, base, PARTS) == {7: "p2", 0: "p0", 1: "p1", 2: "p2"}
    assert many.replay_parked(spark, f"{base}/feeds", PARTS) == 0
    assert many.read_parked(spark, f"{base}/feeds", feeds).count() == 0


def test_a_batch_that_fails_for_every_table_is_repeated(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    feeds = start(spark, base)
    write_log(events(spark, LOWER, [1], "a", 0).unionByName(events(spark, PARTS, [1], "p", 0)), f"{base}/log")
    write = many.write_batch

    def broken(*args):
        raise OSError("the disk is gone")

    monkeypatch.setattr(many, "write_batch", broken)
    with pytest.raises(Exception, match="the disk is gone"):
        follow(spark, base, feeds)
    monkeypatch.setattr(many, "write_batch", write)
    follow(spark, base, feeds)
    assert held(spark, base, LOWER) == {1: "a"} and held(spark, base, PARTS) == {1: "p"}
    assert many.read_parked(spark, f"{base}/feeds", feeds).count() == 0


def test_one_mapping_per_topic():
    with pytest.raises(ValueError):
        many.registry([PARTS, PARTS])
