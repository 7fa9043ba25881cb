"""Make change events from table states, as records of a change log."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.coerce import to_wire
from changeflow.model import CHANGE, LOG_SCHEMA, TableMapping
from changeflow.operators.merge import by_key, named, same_key, same_payload

# Explicit nulls are part of an envelope: a null column is not a missing column.
_WITH_NULLS = {"ignoreNullFields": "false"}
_LOG_COLUMNS = [c.split()[0] for c in LOG_SCHEMA.split(", ")]


def _image(mapping: TableMapping, side: str = "") -> SparkColumn:
    """A replica row under the column names of the feed."""
    values = zip(named(mapping.targets, side), mapping.columns)
    return F.struct(*[to_wire(v, c).alias(c.source) for v, c in values])


def _records(
    df: DataFrame,
    mapping: TableMapping,
    op: SparkColumn,
    before: SparkColumn,
    after: SparkColumn,
    key: list[SparkColumn],
    ts_ms: int | SparkColumn,
    *more: SparkColumn,
) -> DataFrame:
    ts_ms = ts_ms if isinstance(ts_ms, SparkColumn) else F.lit(ts_ms).cast("bigint")
    _, schema, table = mapping.topic.rsplit(".", 2)
    envelope = F.struct(
        op.alias("op"),
        before.alias("before"),
        after.alias("after"),
        F.struct(F.lit(schema).alias("schema"), F.lit(table).alias("table")).alias("source"),
        ts_ms.alias("ts_ms"),
    )
    row_key = F.struct(*[to_wire(k, c).alias(c.source) for k, c in zip(key, mapping.key_fields)])
    return df.select(
        F.lit(mapping.topic).alias("topic"),
        F.to_json(row_key).alias("key"),
        F.to_json(envelope, _WITH_NULLS).alias("value"),
        ts_ms.alias("ts_ms"),
        row_key.alias("row_key"),
        *more,
    )


def snapshot_events(table: DataFrame, mapping: TableMapping, ts_ms: int | SparkColumn) -> DataFrame:
    """One ``r`` event per row: ``topic, key, value``, and the time and key as columns. Narrow."""
    nothing = F.lit(None).cast("string")
    key = named(mapping.keys)
    return _records(table, mapping, F.lit("r"), nothing, _image(mapping), key, ts_ms)


def diff_events(
    old: DataFrame, new: DataFrame, mapping: TableMapping, ts_ms: int | SparkColumn
) -> DataFrame:
    """The events that lead from one state of a table to another, as ``snapshot_events`` has them.

    ``c``, ``u`` and ``d`` carry full images; a changed key becomes a ``d`` and a ``c``.
    """
    columns = named(mapping.targets)
    a = old.select(*columns).withColumn(CHANGE, F.lit(True)).alias("a")
    b = new.select(*columns).withColumn(CHANGE, F.lit(True)).alias("b")
    joined = a.join(b, same_key(mapping, "a", "b"), "full_outer")
    in_a, in_b = F.col(f"a.{CHANGE}").isNotNull(), F.col(f"b.{CHANGE}").isNotNull()
    op = F.when(~in_a, "c").when(~in_b, "d").otherwise("u")
    return _records(
        joined.where(~(in_a & in_b & same_payload(mapping, "a", "b"))),
        mapping,
        op,
        F.when(in_a, _image(mapping, "a")),
        F.when(in_b, _image(mapping, "b")),
        [F.coalesce(p, q) for p, q in zip(named(mapping.keys, "a"), named(mapping.keys, "b"))],
        ts_ms,
    )


def with_position(events: DataFrame, offset: str | SparkColumn, partition=0) -> DataFrame:
    """Give captured events a place in a file log. A broker assigns its own instead.

    Within one key the offsets must grow with time; a capture holds at most one event per
    key, so any number above those already in the log will do. ``offset`` may use the captured
    columns ``ts_ms`` and ``row_key``, so that nothing is parsed back out of the event.
    """
    offset = F.expr(offset) if isinstance(offset, str) else offset
    partition = partition if isinstance(partition, SparkColumn) else F.lit(partition)
    return events.select(
        "topic",
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.timestamp_millis("ts_ms").alias("timestamp"),
        "key",
        "value",
    )


#: The last offset of every partition at some time; a partition without records may be missing.
Marks = dict[int, int]


def end_marks(records: DataFrame) -> Marks:
    """Where a log ends: one row per partition."""
    ends = records.where(F.col("offset").isNotNull()).groupBy("partition").agg(F.max("offset").alias("last"))
    return {r["partition"]: r["last"] for r in ends.collect()}


def _marked(marks: Marks, partition: SparkColumn) -> SparkColumn:
    """The mark of a partition; -1, before the first record, if it has none."""
    if not marks:
        return F.lit(-1).cast("bigint")
    known = F.create_map(*[F.lit(x).cast("bigint") for pair in marks.items() for x in pair])
    return F.coalesce(F.try_element_at(known, partition.cast("bigint")), F.lit(-1).cast("bigint"))


def settled_rows(rows: DataFrame, live: DataFrame, mapping: TableMapping, low: Marks, high: Marks) -> DataFrame:
    """Rows of a chunk of a table that no change between two marks concerns.

    ``low`` is where the log ended before the chunk was read and ``high`` where it ended afterwards;
    ``live`` has the change rows of the log, at least those between the marks, both included.
    A row with a change in between may have been read before it or after it; the change itself
    says what the row is, so the row is left out.
    """
    place, offset = F.col(f"{CHANGE}.partition"), F.col(f"{CHANGE}.offset")
    between = live.where((offset >= _marked(low, place)) & (offset <= _marked(high, place)))
    return by_key(rows, between, mapping, "left_anti")


def chunk_events(
    rows: DataFrame,
    live: DataFrame,
    mapping: TableMapping,
    low: Marks,
    high: Marks,
    ts_ms: int | SparkColumn,
    partition: int | SparkColumn = 0,
) -> DataFrame:
    """Log records of a chunk of a snapshot that is taken while the table changes.

    They stand at the ``high`` mark of ``partition``, the one that has the changes of the row's key
    (an expression over the replica's columns). A change up to the low mark is in the row and has
    a smaller offset; one between the marks keeps the row out; a later one has a larger offset.
    So chunks may be read in any order and at any time, and their records applied in any order
    among those of the log, which must be followed from the low mark on, itself included: what
    comes out is the table as the log leaves it. No offset is shifted, so keys and offsets may
    be of any size.
    """
    partition = partition if isinstance(partition, SparkColumn) else F.lit(partition)
    kept = settled_rows(rows, live, mapping, low, high)
    placed = kept.select(*named(mapping.targets), partition.cast("int").alias(CHANGE))
    key = named(mapping.keys)
    nothing = F.lit(None).cast("string")
    # The partition travels in the place of the change, so that no column can clash.
    events = _records(placed, mapping, F.lit("r"), nothing, _image(mapping), key, ts_ms, F.col(CHANGE))
    return with_position(events, _marked(high, F.col(CHANGE)), F.col(CHANGE)).select(*_LOG_COLUMNS)
