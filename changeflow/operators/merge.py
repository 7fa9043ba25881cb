"""Merge compacted changes (one row per key, see ``change_rows``) into a replica."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.model import CHANGE, DELETE, UPSERT, TableMapping, ident

OUTCOME = f"{CHANGE}.outcome"


def named(names: list[str], side: str = "") -> list[Column]:
    """Columns by name, of one side of a join if it is given."""
    prefix = f"{side}." if side else ""
    return [F.col(f"{prefix}{ident(n)}") for n in names]


def same_key(mapping: TableMapping, a: str, b: str) -> Column:
    pairs = zip(named(mapping.keys, a), named(mapping.keys, b))
    return reduce(lambda x, y: x & y, [p == q for p, q in pairs])


def same_payload(mapping: TableMapping, a: str, b: str) -> Column:
    names = [c.target for c in mapping.payload]
    pairs = zip(named(names, a), named(names, b))
    return reduce(lambda x, y: x & y, [p.eqNullSafe(q) for p, q in pairs], F.lit(True))


def by_key(target: DataFrame, keys: DataFrame, mapping: TableMapping, how: str) -> DataFrame:
    """Rows of ``target`` with (``left_semi``) or without (``left_anti``) their key in ``keys``."""
    old, new = target.alias("old"), keys.select(*named(mapping.keys)).alias("new")
    return old.join(new, same_key(mapping, "old", "new"), how)


def merge_upsert(target: DataFrame, rows: DataFrame, mapping: TableMapping) -> DataFrame:
    """Matched keys take all columns of ``rows``, unmatched ones are inserted."""
    columns = named(mapping.targets)
    kept = by_key(target, rows, mapping, "left_anti")
    return kept.select(*columns).unionByName(rows.select(*columns))


def merge_delete(target: DataFrame, keys: DataFrame, mapping: TableMapping) -> DataFrame:
    """Drop the rows whose key is listed; an absent key changes nothing."""
    return by_key(target, keys, mapping, "left_anti").select(*named(mapping.targets))


def apply_batch(target: DataFrame, changes: DataFrame, mapping: TableMapping) -> DataFrame:
    """Upserts and deletes in one pass over both sides.

    A full outer join reads ``changes`` once, which matters while they are still a plan over
    the log; they are hash-partitioned by the key already, so only the target is shuffled,
    and not even that one when it is bucketed by the key.
    """
    old, new = target.alias("old"), changes.alias("new")
    outcome = F.col(f"new.{OUTCOME}")
    pairs = zip(mapping.targets, named(mapping.targets, "old"), named(mapping.targets, "new"))
    columns = [F.when(outcome == UPSERT, b).otherwise(a).alias(name) for name, a, b in pairs]
    joined = old.join(new, same_key(mapping, "old", "new"), "full_outer")
    return joined.where(outcome.isNull() | (outcome == UPSERT)).select(*columns)


def apply_written(target: DataFrame, changes: DataFrame, mapping: TableMapping) -> DataFrame:
    """The same result for changes that were written to a table.

    Spark knows the size of a table, so it broadcasts the changed keys when they are under
    its threshold and leaves the target where it lies; above it, this is a sort-merge join.
    """
    return merge_upsert_written(by_key(target, changes, mapping, "left_anti"), changes, mapping)


def merge_upsert_written(kept: DataFrame, changes: DataFrame, mapping: TableMapping) -> DataFrame:
    """Rows that no change touches, together with the changed ones."""
    columns = named(mapping.targets)
    upserts = changes.where(F.col(OUTCOME) == UPSERT)
    return kept.select(*columns).unionByName(upserts.select(*columns))


def effective_changes(target: DataFrame, changes: DataFrame, mapping: TableMapping) -> DataFrame:
    """The changes that really alter the replica; field ``action`` of the change tells how.

    An upsert of equal columns and a delete of an absent key are left out; that is what
    stops the echo of a change between two replicas. The target is first cut down to the keys
    that are changed, with the changes on the side that may be broadcast, so that a large
    replica is not moved to look up a few rows; for that read them from a written table.
    """
    touched = by_key(target, changes, mapping, "left_semi").select(*named(mapping.targets))
    old, new = touched.withColumn(CHANGE, F.lit(True)).alias("old"), changes.alias("new")
    outcome, found = F.col(f"new.{OUTCOME}"), F.col(f"old.{CHANGE}").isNotNull()
    same = same_payload(mapping, "old", "new")
    action = (
        F.when((outcome == UPSERT) & ~found, "insert")
        .when((outcome == UPSERT) & ~same, "update")
        .when((outcome == DELETE) & found, "delete")
    )
    joined = new.join(old, same_key(mapping, "old", "new"), "left")
    change = F.col(f"new.{CHANGE}").withField("action", action).alias(CHANGE)
    altered = joined.select(*named(mapping.targets, "new"), change)
    return altered.where(F.col(f"{CHANGE}.action").isNotNull())
