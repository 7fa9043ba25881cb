"""Positions in a file log: start and stop anywhere, and read only the files in between.

A position is an offset for every partition of every topic, as a broker keeps it. An index beside
the log has the offsets and times that each file spans; it grows with the log, file by file.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.model import LOG_SCHEMA
from changeflow.sources.log import read_log

#: The first offset to read, or the last one, of every (topic, partition).
Positions = dict[tuple[str, int], int]

_INDEX_SCHEMA = (
    "file string, topic string, partition int, low bigint, high bigint, since timestamp, until timestamp"
)


def _plain(file: str) -> str:
    """A local file is spelled with one slash or with three."""
    return re.sub("^file:/+", "/", file)


def _source(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    reader = spark.read.schema(LOG_SCHEMA).format(file_format)
    return (reader.option("mode", "PERMISSIVE") if file_format == "json" else reader).load(path)


def index_log(spark: SparkSession, path: str, index: str, file_format: str = "json") -> int:
    """Add the files to the index that are not in it; returns how many. Only those are read.

    ``index`` is a folder outside of the log. A file of a log never changes once it is there. Lines
    that are no record have no position and are in no range of a file.
    """
    known = {_plain(r["file"]) for r in read_index(spark, index).select("file").distinct().collect()}
    new = sorted(f for f in _source(spark, path, file_format).inputFiles() if _plain(f) not in known)
    if not new:
        return 0
    reader = spark.read.schema(LOG_SCHEMA).option("basePath", path).format(file_format)
    records = reader.load([unquote(f) for f in new])
    spans = records.groupBy(F.col("_metadata.file_path").alias("file"), "topic", "partition").agg(
        F.min("offset").alias("low"),
        F.max("offset").alias("high"),
        F.min("timestamp").alias("since"),
        F.max("timestamp").alias("until"),
    )
    spans.coalesce(1).write.mode("append").parquet(index)
    return len(new)


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """``file, topic, partition, low, high, since, until``; empty before the first file."""
    empty = spark.createDataFrame([], _INDEX_SCHEMA)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(index)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(_INDEX_SCHEMA).parquet(index) if there else empty


def _by_partition(rows: DataFrame, value: SparkColumn) -> Positions:
    found = rows.where("partition is not null").groupBy("topic", "partition").agg(value.alias("at")).collect()
    return {(r["topic"], r["partition"]): r["at"] for r in found if r["at"] is not None}


def earliest(spark: SparkSession, index: str) -> Positions:
    """The first record of every partition."""
    return _by_partition(read_index(spark, index), F.min("low"))


def latest(spark: SparkSession, index: str) -> Positions:
    """Where every partition goes on: behind its last record."""
    return _by_partition(read_index(spark, index), F.max("high") + 1)


def at_time(spark: SparkSession, path: str, index: str, time: SparkColumn, file_format: str = "json") -> Positions:
    """The first offset of every partition whose record is of ``time`` or later.

    Partitions without such a record are where they go on. Files that end before are not read.
    """
    spans = read_index(spark, index)
    files = [r["file"] for r in spans.where(F.col("until") >= time).select("file").distinct().collect()]
    found = latest(spark, index)
    if files:
        reader = spark.read.schema(LOG_SCHEMA).option("basePath", path).format(file_format)
        later = reader.load([unquote(f) for f in files]).where(F.col("timestamp") >= time)
        found |= _by_partition(later, F.min("offset"))
    return found


def _within(start: Positions, end: Positions | None, low: str, high: str, unknown: bool) -> SparkColumn:
    """Whether ``low`` to ``high`` of a partition meets its range, from its start to before its end."""
    inside = F.lit(False)
    for (topic, partition), first in start.items():
        last = None if end is None else end.get((topic, partition))
        here = (F.col("topic") == topic) & (F.col("partition") == partition) & (F.col(high) >= first)
        if last is not None:
            here = here & (F.col(low) < last)
        inside = inside | here
    if unknown:
        # A partition that the start does not name is new, and read from its beginning.
        named = F.lit(False)
        for topic, partition in start:
            named = named | ((F.col("topic") == topic) & (F.col("partition") == partition))
        late = F.lit(False)
        for (topic, partition), last in (end or {}).items():
            late = late | ((F.col("topic") == topic) & (F.col("partition") == partition) & (F.col(low) >= last))
        inside = inside | (~named & ~late)
    return inside


def read_between(
    spark: SparkSession,
    path: str,
    index: str,
    start: Positions,
    end: Positions | None = None,
    file_format: str = "json",
    new_partitions: bool = True,
) -> DataFrame:
    """Records from ``start`` on, itself included, to before ``end``; to the end of the index if there is none.

    Only files are read that hold a record of the range, as the index knows them, so call
    ``index_log`` first. Partitions that ``start`` does not name are read from their beginning, or
    left out with ``new_partitions=False``. Positions are as many as there are partitions.
    """
    spans = read_index(spark, index).where(_within(start, end, "low", "high", new_partitions))
    files = [r["file"] for r in spans.select("file").distinct().collect()]
    if not files:
        return read_log(spark, path, file_format).where(F.lit(False)).select(*_COLUMNS)
    reader = spark.read.schema(LOG_SCHEMA).option("basePath", path).format(file_format)
    records = reader.load([unquote(f) for f in files]).where("partition is not null and offset is not null")
    return records.where(_within(start, end, "offset", "offset", new_partitions)).select(*_COLUMNS)


_COLUMNS = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
