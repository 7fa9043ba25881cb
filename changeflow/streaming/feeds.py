"""Follow the feeds of many tables with one query.

The tables are data: a registry of mappings by topic. A batch is read from the log once and routed
to the replicas of all tables that have records in it. A table that cannot be written does not
stop the others: its part of the batch is parked as it came and put in later.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.model import LOG_SCHEMA, TableMapping
from changeflow.operators.decode import decode
from changeflow.streaming.apply import _start
from changeflow.streaming.commits import BATCH, CHANGES, Commit, Folder, commit, is_store, new_attempt, snapshot
from changeflow.streaming.replica import create_replica, slim, write_batch

_PARKED_SCHEMA = f"{LOG_SCHEMA}, torn boolean"


def registry(mappings: Iterable[TableMapping]) -> dict[str, TableMapping]:
    """Mappings by topic; a topic belongs to one table."""
    out: dict[str, TableMapping] = {}
    for m in mappings:
        if m.topic in out:
            raise ValueError(f"two mappings for the topic {m.topic!r}")
        out[m.topic] = m
    return out


def replica_path(path: str, topic: str) -> str:
    """Where the replica of a topic lies."""
    return f"{path}/tables/{topic}"


def create_feeds(tables: dict[str, DataFrame], path: str, feeds: dict[str, TableMapping]) -> None:
    """Start the replicas of all feeds from the rows of their tables, by topic."""
    for topic, mapping in feeds.items():
        create_replica(tables[topic], replica_path(path, topic), mapping)


def _with_torn(records: DataFrame) -> DataFrame:
    return records if "torn" in records.columns else records.withColumn("torn", F.lit(False))


def apply_feeds(
    log: DataFrame,
    feeds: dict[str, TableMapping],
    path: str,
    checkpoint: str,
    key_policy: str = "reference",
    interval: str | None = None,
) -> StreamingQuery:
    """Apply all ``feeds`` of a log with many topics, see ``stream_topics``, to their replicas.

    The log is scanned once per batch; its records stay on memory and disk while the tables are
    written. Topics that no mapping names are left alone. If writing one table fails, its records
    are parked under ``path/parked`` and the batch goes on; ``read_parked`` shows them and
    ``replay_parked`` puts them in. While a table has parked batches, later ones may be applied
    before: the order of changes is that of offsets, so the result is the same. If every table
    of a batch fails, the cause is not a table, and the batch fails and is repeated.
    """
    spark = log.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        records = _with_torn(batch).where(F.col("topic").isin(list(feeds))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # One row per topic; tables without records are not touched.
            met = [r["topic"] for r in records.select("topic").distinct().collect()]
            failed: dict[str, Exception] = {}
            for topic in sorted(met):
                mapping = feeds[topic]
                own = records.where(F.col("topic") == topic)
                try:
                    if not is_store(spark, replica_path(path, topic)):
                        raise ValueError(f"no replica for {topic!r}")
                    write_batch(slim(decode(own, mapping, key_policy)), replica_path(path, topic), mapping, batch_id)
                except Exception as error:  # whatever is wrong with this table
                    failed[topic] = error
            if failed and len(failed) == len(met) and len(feeds) > 1:
                raise next(iter(failed.values()))
            for topic in failed:
                _park(spark, records.where(F.col("topic") == topic), path, topic, batch_id)
        finally:
            records.unpersist()

    return _start(log, "append", checkpoint, interval, write)


def _parked_at(path: str, topic: str) -> str:
    return f"{path}/parked/{topic}"


def _park(spark: SparkSession, records: DataFrame, path: str, topic: str, batch_id: int) -> None:
    where, attempt = _parked_at(path, topic), new_attempt()
    records.write.parquet(f"{where}/records/batch_id={batch_id}/attempt={attempt}")
    commit(spark, where, BATCH, batch_id, attempt)


def _waiting(spark: SparkSession, path: str, topic: str) -> list[Commit]:
    """Parked batches of a topic that were not put in yet."""
    # Putting a batch in is recorded as a later attempt of another kind.
    return [c for c in snapshot(spark, _parked_at(path, topic)).batches if c.kind == BATCH]


def _records(spark: SparkSession, path: str, topic: str, c: Commit) -> DataFrame:
    folder = f"{_parked_at(path, topic)}/records/batch_id={c.batch_id}/attempt={c.attempt}"
    return spark.read.schema(_PARKED_SCHEMA).parquet(folder)


def read_parked(spark: SparkSession, path: str, feeds: dict[str, TableMapping]) -> DataFrame:
    """Records that wait for their table, as the log has them, with ``batch_id``."""
    out = spark.createDataFrame([], f"{_PARKED_SCHEMA}, batch_id bigint")
    for topic in feeds:
        for c in _waiting(spark, path, topic):
            out = out.unionByName(_records(spark, path, topic, c).withColumn("batch_id", F.lit(c.batch_id).cast("bigint")))
    return out


def replay_parked(
    spark: SparkSession, path: str, mapping: TableMapping, key_policy: str = "reference"
) -> int:
    """Put the parked batches of a table in, under their own numbers; returns how many.

    Run it once the table can be written again; what fails stays parked. The replica must not have
    been folded beyond a parked batch in the meantime, because a base takes no earlier batch.
    """
    waiting = _waiting(spark, path, mapping.topic)
    where = replica_path(path, mapping.topic)
    base = snapshot(spark, where).base
    if waiting and base and base.batch_id >= waiting[0].batch_id:
        raise ValueError(f"batch {waiting[0].batch_id} of {mapping.topic!r} is parked and the base is beyond it")
    for c in waiting:
        records = _records(spark, path, mapping.topic, c)
        write_batch(slim(decode(records, mapping, key_policy)), where, mapping, c.batch_id)
        commit(spark, _parked_at(path, mapping.topic), CHANGES, c.batch_id, c.attempt)
        Folder(spark, f"{_parked_at(path, mapping.topic)}/records/batch_id={c.batch_id}").remove()
    return len(waiting)
