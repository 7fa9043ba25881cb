"""A replica that is written by micro-batches: Parquet folders, merged when read.

``base`` holds the rows after some batch, in files that are clustered by key; ``index`` says which
files make up a base and which keys each of them spans. ``changes`` has the compacted changes of
the batches, ``dead_letters`` what they could not apply and ``stats`` how many records had which
outcome; ``totals`` sums the latter up for the batches in a base. Everything is written as an
attempt and counts once the commit log names it, see ``commits``: running a batch again changes
nothing, no batch rewrites the base, and readers never see a part of a batch or none of it. Rows
lie in a struct beside the struct of the change, so a table may call its columns as it likes.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.model import CHANGE, SQL_TYPES, UPSERT, VALID_OUTCOMES, TableMapping, ident
from changeflow.operators.compact import ARRIVAL, latest_per_key
from changeflow.operators.decode import change_rows, dead_letters
from changeflow.operators.merge import OUTCOME, by_key, named
from changeflow.operators.quality import outcome_stats
from changeflow.sources.workspace import workspace, written
from changeflow.streaming import commits as log
from changeflow.streaming.commits import BASE, BATCH, CHANGES, LETTERS, RETAIN_SECONDS, Commit, Folder, Snapshot, new_attempt, snapshot

_DEAD_SCHEMA = (
    "topic string, partition int, offset bigint, timestamp timestamp, key string, "
    "value string, op string, outcome string, reason string"
)
_STATS_SCHEMA = "topic string, op string, outcome string, records bigint"
_CHANGE_TYPE = (
    "struct<outcome string, op string, ts_ms bigint, topic string, partition int, offset bigint>"
)
#: Number of the base a replica starts with; batches count from 0.
START = -1
#: As much for changes that were never put on rows.
NO_BASE = -2


def _stored_schema(mapping: TableMapping) -> str:
    return f"row struct<{mapping.replica_schema}>, {CHANGE} {_CHANGE_TYPE}"


def _index_schema(mapping: TableMapping) -> str:
    key = ", ".join(f"{ident(c.target)} {SQL_TYPES[c.type]}" for c in mapping.key_fields)
    return f"file string, low struct<{key}>, high struct<{key}>, rows bigint"


def _stored(changes: DataFrame, mapping: TableMapping) -> DataFrame:
    return changes.select(F.struct(*named(mapping.targets)).alias("row"), CHANGE)


def _loaded(stored: DataFrame, mapping: TableMapping, *more: str) -> DataFrame:
    return stored.select(*[F.col("row")[c].alias(c) for c in mapping.targets], CHANGE, *more)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def _full(change: dict | None = None):
    """The struct of a change with all its fields; those that are not given are null."""
    given = change or {}
    fields = [f.split() for f in _CHANGE_TYPE.removeprefix("struct<").removesuffix(">").split(", ")]
    return F.struct(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields])


def _attempt(name: str, c: Commit) -> str:
    return f"{name}/batch_id={c.batch_id}/attempt={c.attempt}"


def _of_batches(spark: SparkSession, path: str, name: str, schema: str, batches: list[Commit]) -> DataFrame:
    """One of the tables of a store, as far as these attempts wrote it, with ``batch_id``."""
    schema = f"{schema}, batch_id bigint"
    if not batches:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{_attempt(name, c)}" for c in batches]
    stored = spark.read.schema(f"{schema}, attempt string").option("basePath", f"{path}/{name}")
    return stored.parquet(*folders).drop("attempt")


def create_replica(rows: DataFrame, path: str, mapping: TableMapping, files: int | None = None) -> None:
    """Start a replica from the rows of a table, in about so many files if it is said."""
    spark = rows.sparkSession
    _refuse_existing(spark, path)
    start = rows.select(*named(mapping.targets), _full({"outcome": F.lit(UPSERT)}).alias(CHANGE))
    attempt = new_attempt()
    _write_base(start, path, mapping, attempt, files)
    _write(_files_of(spark, path, mapping, attempt), f"{path}/index/attempt={attempt}")
    _write(spark.createDataFrame([], _STATS_SCHEMA), f"{path}/totals/attempt={attempt}")
    log.commit(spark, path, BASE, START, attempt)


def create_store(spark: SparkSession, path: str, mapping: TableMapping) -> None:
    """A store of changes without rows that they could be put on."""
    _refuse_existing(spark, path)
    attempt = new_attempt()
    _write(spark.createDataFrame([], _index_schema(mapping)), f"{path}/index/attempt={attempt}")
    _write(spark.createDataFrame([], _STATS_SCHEMA), f"{path}/totals/attempt={attempt}")
    log.commit(spark, path, BASE, NO_BASE, attempt)


def _refuse_existing(spark: SparkSession, path: str) -> None:
    if log.is_store(spark, path):
        raise ValueError(f"there is a store at {path} already")


def slim(decoded: DataFrame) -> DataFrame:
    """What a batch has to carry: the raw record is kept where it becomes a dead letter only."""
    dead = ~F.col("outcome").isin(*VALID_OUTCOMES)
    return decoded.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.when(dead, F.col("key")).alias("key"),
        F.when(dead, F.col("value")).alias("value"),
        "op",
        "ts_ms",
        "outcome",
        "reason",
        "row",
    )


def stage_changes(slimmed: DataFrame, path: str, mapping: TableMapping, batch_id: int) -> Commit:
    """The first write of an attempt at a batch; nobody reads it before the attempt is committed."""
    mine = Commit(0, BATCH, batch_id, new_attempt(), 0)
    latest = latest_per_key(change_rows(slimmed, mapping), mapping.keys)
    _write(_stored(latest, mapping), f"{path}/{_attempt('changes', mine)}")
    return mine


def write_batch(slimmed: DataFrame, path: str, mapping: TableMapping, batch_id: int) -> None:
    """Compact the valid changes of a batch and store them with its dead letters and counts."""
    # Three tables come out of one parse; what does not fit in memory goes to disk, and what is
    # lost with an executor is decoded again from the log.
    slimmed = slimmed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mine = stage_changes(slimmed, path, mapping, batch_id)
        _write(dead_letters(slimmed), f"{path}/{_attempt('dead_letters', mine)}")
        _write(outcome_stats(slimmed).coalesce(1), f"{path}/{_attempt('stats', mine)}")
    finally:
        slimmed.unpersist()
    log.commit(slimmed.sparkSession, path, BATCH, batch_id, mine.attempt)


def write_changes(changes: DataFrame, path: str, mapping: TableMapping, batch_id: int) -> None:
    """Store change rows, one per key, as those of a batch."""
    spark, mine = changes.sparkSession, Commit(0, CHANGES, batch_id, new_attempt(), 0)
    known = changes.schema[CHANGE].dataType.names
    full = _full({n: F.col(f"{CHANGE}.{n}") for n in known}).alias(CHANGE)
    _write(_stored(changes.select(*named(mapping.targets), full), mapping), f"{path}/{_attempt('changes', mine)}")
    stored = _of_batches(spark, path, "changes", _stored_schema(mapping), [mine])
    _write(outcome_stats(stored.select(f"{CHANGE}.*")).coalesce(1), f"{path}/{_attempt('stats', mine)}")
    log.commit(spark, path, CHANGES, batch_id, mine.attempt)


def folded_upto(spark: SparkSession, path: str) -> int:
    """The batch up to which changes are in the base."""
    return snapshot(spark, path).base.batch_id


def read_changes(
    spark: SparkSession,
    path: str,
    mapping: TableMapping,
    after: int = START - 1,
    until: int | None = None,
    snap: Snapshot | None = None,
) -> DataFrame:
    """The stored changes of a range of batches, by default of all; the batch is in the change.

    Batches that were folded are there until they are cleaned up.
    """
    chosen = (snap or snapshot(spark, path)).after(after, until)
    stored = _of_batches(spark, path, "changes", _stored_schema(mapping), chosen)
    moved = F.col(CHANGE).withField("batch_id", F.col("batch_id")).alias(CHANGE)
    return _loaded(stored.select("row", moved), mapping)


def read_dead_letters(spark: SparkSession, path: str, snap: Snapshot | None = None) -> DataFrame:
    """What the batches could not apply, with their numbers."""
    return _of_batches(spark, path, "dead_letters", _DEAD_SCHEMA, list((snap or snapshot(spark, path)).letters))


def read_counters(spark: SparkSession, path: str, snap: Snapshot | None = None) -> DataFrame:
    """``topic, op, outcome, records`` over all batches ever written; a repeated one counts once."""
    snap = snap or snapshot(spark, path)
    folded = spark.read.schema(_STATS_SCHEMA).parquet(f"{path}/totals/attempt={snap.base.attempt}")
    later = _of_batches(spark, path, "stats", _STATS_SCHEMA, snap.after(snap.base.batch_id)).drop("batch_id")
    return _summed(folded.unionByName(later))


def _summed(stats: DataFrame) -> DataFrame:
    return stats.groupBy("topic", "op", "outcome").agg(F.sum("records").alias("records"))


BY_BATCH = (f"{CHANGE}.batch_id", *ARRIVAL)


# --- the base -----------------------------------------------------------------------


def _write_base(rows: DataFrame, path: str, mapping: TableMapping, attempt: str, files: int | None) -> None:
    """Change rows as files clustered by key; how many follows from their size unless it is said."""
    keys = named(mapping.keys)
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    _write(_stored(ranged.sortWithinPartitions(*keys), mapping), f"{path}/base/attempt={attempt}")


def _key(mapping: TableMapping, row: str | None = None):
    """The key as one value that can be compared."""
    return F.struct(*[(F.col(row)[k] if row else named([k])[0]).alias(k) for k in mapping.keys])


def _files_of(spark: SparkSession, path: str, mapping: TableMapping, attempt: str) -> DataFrame:
    """Index rows of the files of one attempt; only keys are read."""
    stored = spark.read.schema(_stored_schema(mapping)).parquet(f"{path}/base/attempt={attempt}")
    file = F.concat(F.lit(f"attempt={attempt}/"), F.col("_metadata.file_name")).alias("file")
    key = _key(mapping, "row")
    return stored.select(file, key.alias("key")).groupBy("file").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("rows")
    )


def read_index(spark: SparkSession, path: str, mapping: TableMapping, snap: Snapshot | None = None) -> DataFrame:
    """``file, low, high, rows``: the files of the base and the keys they span."""
    base = (snap or snapshot(spark, path)).base
    return spark.read.schema(_index_schema(mapping)).parquet(f"{path}/index/attempt={base.attempt}")


def _spanning(index: DataFrame, keys: DataFrame, mapping: TableMapping) -> list[str]:
    """Files that may hold one of ``keys``.

    The keys are cut into ranges, one per partition of a shuffle and so a bounded number, each
    with the least and largest key in it; these are compared with what the files span.
    """
    # Not more than there are anyway, and one range where keys are few.
    ranged = keys.select(*named(mapping.keys)).repartitionByRange(*named(mapping.keys))
    ranges = (
        ranged.select(F.spark_partition_id().alias("part"), _key(mapping).alias("key"))
        .groupBy("part")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"))
    )
    met = index.join(F.broadcast(ranges), (F.col("low") <= F.col("last")) & (F.col("high") >= F.col("first")), "left_semi")
    return [r["file"] for r in met.select("file").collect()]


def _base_files(spark: SparkSession, path: str, mapping: TableMapping, files: list[str]) -> DataFrame:
    schema = _stored_schema(mapping)
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(f"{schema}, attempt string").option("basePath", f"{path}/base")
    return reader.parquet(*[f"{path}/base/{f}" for f in files])


def _base_rows(spark: SparkSession, path: str, mapping: TableMapping, upto: int, files: list[str]) -> DataFrame:
    """Change rows of files of the base."""
    numbered = F.col(CHANGE).withField("batch_id", F.lit(upto).cast("bigint")).alias(CHANGE)
    return _loaded(_base_files(spark, path, mapping, files).select("row", numbered), mapping)


def _holding(spark: SparkSession, path: str, mapping: TableMapping, files: list[str], keys: DataFrame) -> list[str]:
    """Those of ``files`` that do hold one of ``keys``; of the files only keys are read."""
    if not files:
        return []
    file = F.concat(F.lit("attempt="), F.col("attempt"), F.lit("/"), F.col("_metadata.file_name")).alias("file")
    stored = _base_files(spark, path, mapping, files).select(file, _key(mapping, "row").alias("key"))
    hit = stored.join(keys.select(_key(mapping).alias("key")), "key", "left_semi")
    return [r["file"] for r in hit.select("file").distinct().collect()]


def _updated(base: DataFrame, changes: DataFrame, mapping: TableMapping, order) -> DataFrame:
    """Rows of ``base`` with ``changes``, which may be older than what the base has."""
    # Which base rows are outdated needs the keys alone; only those are combined with changes.
    keys = changes.select(*named(mapping.keys)).distinct()
    touched = by_key(base, keys, mapping, "left_semi")
    last = latest_per_key(changes.unionByName(touched), mapping.keys, order)
    return by_key(base, keys, mapping, "left_anti").unionByName(last)


def read_state(
    spark: SparkSession,
    path: str,
    mapping: TableMapping,
    order=ARRIVAL,
    until: int | None = None,
    snap: Snapshot | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Change rows, one per key: the last change, or the row of the base where there is none.

    Deleted keys are among them, so that an older change that comes late finds them newer.
    ``until`` leaves out later batches, except those that are in the base already. ``keys``
    restricts the result to some keys; files that cannot hold them are not read.
    """
    snap = snap or snapshot(spark, path)
    upto = snap.base.batch_id
    changes = read_changes(spark, path, mapping, upto, until, snap)
    if keys is not None:
        changes = by_key(changes, keys, mapping, "left_semi")
    index = read_index(spark, path, mapping, snap)
    files = [r["file"] for r in index.select("file").collect()]
    base = lambda some: _base_rows(spark, path, mapping, upto, some)
    if keys is not None:
        some = _spanning(index, keys, mapping) if len(files) > 1 else files
        return _updated(by_key(base(some), keys, mapping, "left_semi"), changes, mapping, order)
    if not snap.after(upto, until):
        return base(files)
    if not files:
        return latest_per_key(changes, mapping.keys, order)
    # Files that no change can concern are read once and not compared with anything.
    some = _spanning(index, changes, mapping) if len(files) > 1 else files
    others = sorted(set(files) - set(some))
    state = _updated(base(some), changes, mapping, order)
    return base(others).unionByName(state) if others else state


def read_replica(
    spark: SparkSession,
    path: str,
    mapping: TableMapping,
    order=ARRIVAL,
    until: int | None = None,
    snap: Snapshot | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """The rows of the replica as of the last batch, or as of an earlier one; see ``read_state``."""
    state = read_state(spark, path, mapping, order, until, snap, keys)
    return state.where(F.col(OUTCOME) == UPSERT).select(*named(mapping.targets))


def fold_replica(
    spark: SparkSession,
    path: str,
    mapping: TableMapping,
    order=ARRIVAL,
    until: int | None = None,
    files: int | None = None,
) -> int:
    """Fold the batches written so far into a new base; returns the number of the last one.

    Only files that hold a changed key are written anew, with the new keys, into about ``files``
    files; all others are taken over by name. The index decides which files to look into, and
    their keys which of them are concerned. The stream goes on meanwhile and needs no restart,
    and readers follow the base that was there when they began. Offsets stay with the rows and
    deleted keys stay as deletes, so a change that comes late still loses. Files that no reader
    needs any more are removed by ``clean_replica``.
    """
    snap = snapshot(spark, path)
    upto = snap.base.batch_id
    chosen = snap.after(upto, until)
    if not chosen:
        return upto
    done, attempt = chosen[-1].batch_id, new_attempt()
    aside = workspace(spark, "fold")
    changes = read_changes(spark, path, mapping, upto, until, snap)
    changes = written(latest_per_key(changes, mapping.keys, order), f"{aside}/changes")
    index = read_index(spark, path, mapping, snap)
    touched = _holding(spark, path, mapping, _spanning(index, changes, mapping), changes)
    kept = F.col(CHANGE).dropFields("batch_id").alias(CHANGE)
    state = _updated(_base_rows(spark, path, mapping, upto, touched), changes, mapping, order)
    _write_base(state.select(*named(mapping.targets), kept), path, mapping, attempt, files)
    replaced = spark.createDataFrame([(f,) for f in touched], "file string")
    others = index.join(replaced, "file", "left_anti")
    _write(others.unionByName(_files_of(spark, path, mapping, attempt)), f"{path}/index/attempt={attempt}")
    earlier = spark.read.schema(_STATS_SCHEMA).parquet(f"{path}/totals/attempt={snap.base.attempt}")
    stats = _of_batches(spark, path, "stats", _STATS_SCHEMA, chosen).drop("batch_id")
    _write(_summed(earlier.unionByName(stats)).coalesce(1), f"{path}/totals/attempt={attempt}")
    log.commit(spark, path, BASE, done, attempt)
    Folder(spark, aside).remove()
    return done


def clean_replica(
    spark: SparkSession, path: str, mapping: TableMapping, retain_seconds: float = RETAIN_SECONDS
) -> int:
    """Remove files that no reader needs; returns how many folders and files went.

    What counts stays: the base, the batches after it, and all dead letters. So do the files
    of snapshots that are held (``commits.held``), of those that were the present one less than
    ``retain_seconds`` ago, and files that were written since then, which may be an attempt that
    is not committed yet. The log is shortened before anything is removed.
    """
    folder, now = Folder(spark, path), time.time()
    snap = snapshot(spark, path)
    kept = log.needed(spark, path, retain_seconds)
    # Dead letters outlast the fold; their records stay in the log.
    letters = [c._replace(kind=LETTERS) for c in snap.letters if c not in kept]
    log.gather(spark, path, sorted([*kept, *letters]))
    gone = 0

    def remove(name: str, changed: float) -> None:
        nonlocal gone
        # Some stores have no times for folders.
        changed = max([t for _, _, t in folder.listed(name)], default=changed)
        if now - changed >= retain_seconds:
            folder.remove(name)
            gone += 1

    batches = [c for c in kept if c.kind in (BATCH, CHANGES)]
    alive = {_attempt(name, c) for name in ("changes", "stats", "dead_letters") for c in batches}
    alive |= {_attempt("dead_letters", c) for c in letters}
    for name in ("changes", "stats", "dead_letters"):
        for batch, _, _ in folder.listed(name):
            for attempt, _, changed in folder.listed(f"{name}/{batch}"):
                if f"{name}/{batch}/{attempt}" not in alive:
                    remove(f"{name}/{batch}/{attempt}", changed)
    bases = [c for c in kept if c.kind == BASE]
    for name in ("index", "totals"):
        for attempt, _, changed in folder.listed(name):
            if attempt not in {f"attempt={c.attempt}" for c in bases}:
                remove(f"{name}/{attempt}", changed)
    named_files = set()
    for base in bases:
        index = read_index(spark, path, mapping, Snapshot(0, base, ()))
        named_files |= {r["file"] for r in index.select("file").collect()}
    for attempt, _, changed in folder.listed("base"):
        files = folder.listed(f"base/{attempt}")
        used = [f"{attempt}/{f}" for f, _, _ in files if f"{attempt}/{f}" in named_files]
        if not used:
            remove(f"base/{attempt}", changed)
            continue
        for f, _, written_at in files:
            if f.startswith("part-") and f"{attempt}/{f}" not in named_files:
                remove(f"base/{attempt}/{f}", written_at)
    return gone
