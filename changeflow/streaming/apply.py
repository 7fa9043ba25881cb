"""Follow a change log with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changeflow.model import TableMapping
from changeflow.operators.compact import latest_per_key
from changeflow.operators.decode import change_rows, decode
from changeflow.streaming.replica import read_state, slim, write_batch, write_changes

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(df: DataFrame, mode: str, checkpoint: str, interval: str | None, write):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(
        availableNow=True
    )
    return writer.foreachBatch(write).start()


def apply_stream(
    log: DataFrame,
    mapping: TableMapping,
    path: str,
    checkpoint: str,
    key_policy: str = "reference",
    interval: str | None = None,
) -> StreamingQuery:
    """Apply one topic to the replica at ``path``, which must exist.

    Runs until stopped with ``interval``, else until the log is read to its end. The
    checkpoint is the position of this direction: the next run goes on where this one ended.
    Bad records become dead letters and never stop the query; a failing disk or node does
    fail the batch, which Spark then repeats. Every batch stores its counts, see
    ``read_counters``.
    """
    decoded = slim(decode(log, mapping, key_policy))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, mapping, batch_id)

    return _start(decoded, "append", checkpoint, interval, write)


def latest_stream(
    log: DataFrame,
    mapping: TableMapping,
    path: str,
    checkpoint: str,
    key_policy: str = "reference",
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the last change per key as state of the stream.

    Every batch writes the keys it touched, with their state, as changes of the store at
    ``path`` (``create_store``), which ``fold_replica`` folds and ``read_latest`` reads. The
    state has one entry per key of the table and is kept on purpose; it lives in RocksDB,
    so it is bounded by the disks of the executors and not by their memory.
    """
    latest = latest_per_key(change_rows(decode(log, mapping, key_policy), mapping), mapping.keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_changes(batch, path, mapping, batch_id)

    # A query copies the settings of its session when it starts.
    conf = log.sparkSession.conf
    before = conf.get(_STATE_STORE, None)
    conf.set(_STATE_STORE, _ROCKSDB)
    try:
        return _start(latest, "update", checkpoint, interval, write)
    finally:
        if before is None:
            conf.unset(_STATE_STORE)
        else:
            conf.set(_STATE_STORE, before)


def read_latest(spark: SparkSession, path: str, mapping: TableMapping) -> DataFrame:
    """The last state that was written for every key, as change rows."""
    return read_state(spark, path, mapping)
