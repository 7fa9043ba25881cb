"""Ranges of a file log by offset and time."""

import random

import pytest
from pyspark.sql import functions as F
from test_decode import make_log

from changeflow.sources import positions as at
from changeflow.sources.log import write_log


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_any_range_reads_its_files_only(spark, tmp_path, file_format):
    rng = random.Random(6)
    path, index = str(tmp_path / "log"), str(tmp_path / "index")
    log = make_log(spark, [str(i) for i in range(120)])
    log = log.withColumns(
        {"partition": (F.col("offset") % 3).cast("int"), "timestamp": F.timestamp_seconds(F.col("offset") * 60)}
    )
    edges = [0, 30, 50, 51, 90, 120]
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        part = log.where(F.col("offset").between(a, b - 1)).coalesce(1)
        write_log(part, path, mode="append", file_format=file_format)
        # The index grows by the files that are new.
        assert at.index_log(spark, path, index, file_format) == 1
    assert at.index_log(spark, path, index, file_format) == 0
    topic = log.first()["topic"]
    whole = {(r.partition, r.offset) for r in log.collect()}
    assert at.earliest(spark, index) == {(topic, p): p for p in range(3)}
    assert at.latest(spark, index) == {(topic, p): 118 + p for p in range(3)}
    for _ in range(4):
        start = {(topic, p): rng.randrange(125) for p in range(3)}
        end = {(topic, p): rng.randrange(125) for p in range(2)}
        got = at.read_between(spark, path, index, start, end, file_format)
        want = {
            (p, o) for p, o in whole if o >= start[topic, p] and ((topic, p) not in end or o < end[topic, p])
        }
        assert sorted((r.partition, r.offset) for r in got.collect()) == sorted(want)
        meets = 0
        for a, b in zip(edges, edges[1:]):
            spans = [[o for o in range(a, b) if o % 3 == p] for p in range(3)]
            meets += any(
                own and own[-1] >= start[topic, p] and ((topic, p) not in end or own[0] < end[topic, p])
                for p, own in enumerate(spans)
            )
        if meets:
            assert len(got.inputFiles()) == meets
    since = at.at_time(spark, path, index, F.timestamp_seconds(F.lit(75 * 60)), file_format)
    assert since == {(topic, 0): 75, (topic, 1): 76, (topic, 2): 77}
    never = at.at_time(spark, path, index, F.timestamp_seconds(F.lit(10**9)), file_format)
    assert never == at.latest(spark, index)
    # A partition that has no place yet is new, unless it is not wanted.
    some = at.read_between(spark, path, index, {(topic, 0): 117}, None, file_format)
    assert some.count() == 81 and some.where("partition = 0").count() == 1
    assert at.read_between(spark, path, index, {(topic, 0): 117}, None, file_format, new_partitions=False).count() == 1
    assert at.read_between(spark, path, index, {(topic, 0): 500}, None, file_format, new_partitions=False).count() == 0


def test_torn_lines_and_an_empty_index(spark, tmp_path):
    path, index = str(tmp_path / "log"), str(tmp_path / "index")
    assert at.read_index(spark, index).count() == 0 and at.latest(spark, index) == {}
    log = make_log(spark, ["a", "b"])
    write_log(log.coalesce(1), path)
    with open(f"{path}/topic={log.first()['topic']}/part-torn.json", "w") as file:
        file.write('{"partition":0,"off')
    assert at.index_log(spark, path, index) == 2
    assert at.index_log(spark, path, index) == 0
    assert at.read_between(spark, path, index, at.earliest(spark, index)).count() == 2
