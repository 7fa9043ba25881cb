"""Follow both feeds of a table and keep its two replicas in step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.model import TableMapping
from changeflow.operators import sync
from changeflow.operators.merge import named
from changeflow.sources.workspace import workspace, written
from changeflow.streaming.apply import _start
from changeflow.streaming.commits import BATCH, Commit, Folder, commit, new_attempt, snapshot
from changeflow.streaming.replica import (
    BY_BATCH,
    create_replica,
    create_store,
    fold_replica,
    read_changes,
    read_replica,
    read_state,
    write_changes,
)

#: After so many batches the changes of both sides and the state are folded.
FOLD_EVERY = 4


def create_sync(
    lower: DataFrame, upper: DataFrame, path: str, to_lower: TableMapping, to_upper: TableMapping
) -> None:
    """Start from the rows of both sides: ``path/lower``, ``path/upper`` and the state."""
    create_replica(lower, f"{path}/{sync.LOWER}", to_lower)
    create_replica(upper, f"{path}/{sync.UPPER}", to_upper)
    create_store(lower.sparkSession, f"{path}/state", sync.state_mapping(to_lower))


def sync_stream(
    log: DataFrame,
    to_lower: TableMapping,
    to_upper: TableMapping,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Apply both feeds of ``log``, a union of their streams, to both replicas.

    One query reads both topics, so that no two batches decide about a key at the same time; its
    checkpoint has the position in either. A batch combines its changes with the state of the keys
    they touch, decides these keys anew and stores what each side is to have. ``read_writes`` has
    what is sent to a side: changes of the other one that really alter it, and no echo.
    ``read_refused`` has winners that a side cannot store. A repeated batch finds the state before
    it, and counts in place of the attempt before it.

    State and replicas are kept by key: a batch looks only into files that may hold one of its keys,
    and into the changes of the last batches. Every ``fold_every`` batches these are folded, where
    only files that hold a changed key are written anew. So what a batch reads does not grow with the
    batches before it.
    """
    spark = log.sparkSession
    state = sync.state_mapping(to_lower)
    sides = {sync.LOWER: to_lower, sync.UPPER: to_upper}

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % fold_every == 0:
            # This batch itself is left out: an attempt at it may have been stored before.
            fold_replica(spark, f"{path}/state", state, until=batch_id - 1)
            for name, side in sides.items():
                fold_replica(spark, f"{path}/{name}", side, BY_BATCH, until=batch_id - 1)
        mine, aside = Commit(0, BATCH, batch_id, new_attempt(), 0), workspace(spark, "sync")
        write_changes(sync.last_of_both(batch, to_lower, to_upper), f"{path}/state", state, batch_id)
        seen = read_changes(spark, f"{path}/state", state, batch_id - 1, batch_id)
        keys = written(seen.select(*named(to_lower.keys)).distinct(), f"{aside}/keys")
        origins = F.explode(F.array(*map(F.lit, sync.SIDES))).alias(sync.ORIGIN)
        both = keys.select(origins, *named(to_lower.keys))
        now = read_state(spark, f"{path}/state", state, until=batch_id, keys=both)
        decided = written(sync.decide(now, to_lower, to_upper), f"{aside}/decided")
        held = {
            name: read_replica(
                spark, f"{path}/{name}", side, BY_BATCH, until=batch_id - 1, keys=keys.toDF(*side.keys)
            )
            for name, side in sides.items()
        }
        writes = sync.sync_changes(held[sync.LOWER], held[sync.UPPER], decided, to_lower, to_upper)
        for name, sent in ((sync.LOWER, writes.to_lower), (sync.UPPER, writes.to_upper)):
            sent.write.parquet(f"{path}/sent/{name}/{_place(mine)}")
        writes.refused.write.parquet(f"{path}/sent/refused/{_place(mine)}")
        for name, side in sides.items():
            rows = sync.settled_changes(decided, name, to_lower, side)
            write_changes(rows, f"{path}/{name}", side, batch_id)
        commit(spark, f"{path}/sent", BATCH, batch_id, mine.attempt)
        Folder(spark, aside).remove()

    return _start(log, "append", checkpoint, interval, write)


def _place(c: Commit) -> str:
    return f"batch_id={c.batch_id}/attempt={c.attempt}"


def _sent(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    batches = snapshot(spark, f"{path}/sent").batches
    if not batches:
        return None
    reader = spark.read.option("basePath", f"{path}/sent/{name}")
    return reader.parquet(*[f"{path}/sent/{name}/{_place(c)}" for c in batches]).drop("attempt")


def read_writes(spark: SparkSession, path: str, origin: str) -> DataFrame | None:
    """What was sent to a side, as change rows with ``batch_id``; ``None`` before the first batch."""
    return _sent(spark, path, origin)


def read_refused(spark: SparkSession, path: str) -> DataFrame | None:
    """Winners that a side cannot store, with ``batch_id``; ``None`` before the first batch."""
    return _sent(spark, path, "refused")


def read_side(spark: SparkSession, path: str, origin: str, mapping: TableMapping) -> DataFrame:
    """The rows of one side as of the last batch."""
    return read_replica(spark, f"{path}/{origin}", mapping, BY_BATCH)
