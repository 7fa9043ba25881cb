"""Replica tables at rest: Parquet, bucketed tables and JDBC."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.model import CHANGE, DELETE, SQL_TYPES, UPSERT, TableMapping, ident
from changeflow.operators.merge import OUTCOME, named


def scan_replica(spark: SparkSession, path: str, mapping: TableMapping) -> DataFrame:
    """Scan a Parquet table under its feed names and return it under the replica names."""
    return spark.read.parquet(path).select(
        *[F.col(ident(c.source)).alias(c.target) for c in mapping.columns]
    )


def lookup(replica: DataFrame, key: str, value: int | str) -> DataFrame:
    """The row with one key; the filter reaches the Parquet or JDBC scan."""
    return replica.where(F.col(ident(key)) == F.lit(value))


def save_bucketed(replica: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Store a replica bucketed and sorted by its key.

    Merging into it, comparing it or diffing it then shuffles only the other side, and
    nothing at all when that one is bucketed alike.
    """
    # One task per bucket writes one file per bucket.
    replica.repartition(buckets, key).write.mode("errorifexists").option("path", path).bucketBy(
        buckets, key
    ).sortBy(key).saveAsTable(table)
    return replica.sparkSession.table(table)


def tables_named(spark: SparkSession, name: str) -> list[str]:
    """Full names of the catalog tables called ``name``."""
    found = [t for t in spark.catalog.listTables() if t.name == name]
    return [".".join([*(t.namespace or []), t.name]) for t in found]


#: The keys after one value and up to another, as tuples; ``None`` is open.
KeyRange = tuple[tuple | None, tuple | None]


def key_ranges(table: DataFrame, mapping: TableMapping, count: int) -> list[KeyRange]:
    """At most ``count`` ranges of the key with about as many rows each, however keys are spread.

    Spark samples the keys to cut them for a shuffle; the last key of every part is the end of a
    range. The first and the last range are open, so every key is in exactly one, those
    that come later too. Only keys are read.
    """
    keys = table.select(*named(mapping.keys))
    parts = keys.repartitionByRange(count, *named(mapping.keys)).withColumn(CHANGE, F.spark_partition_id())
    key = F.struct(*named(mapping.keys))
    ends = [tuple(r["last"]) for r in parts.groupBy(CHANGE).agg(F.max(key).alias("last")).orderBy("last").collect()]
    edges = [None, *ends[:-1], None]
    return list(zip(edges, edges[1:]))


def in_range(mapping: TableMapping, range_: KeyRange) -> SparkColumn:
    """Whether the key of a row is in a range."""
    after, upto = range_
    key = F.struct(*named(mapping.keys))
    bound = lambda values: F.struct(
        *[F.lit(v).cast(SQL_TYPES[c.type]).alias(c.target) for v, c in zip(values, mapping.key_fields)]
    )
    inside = F.lit(True)
    if after is not None:
        inside = inside & (key > bound(after))
    if upto is not None:
        inside = inside & (key <= bound(upto))
    return inside


def _sql_after(names: list[str], values: tuple, last: str) -> str:
    """SQL for a key beyond ``values``, column by column; ``last`` compares the last column."""
    name, value = names[0], values[0]
    if len(names) == 1:
        return f"{name} {last} {value}"
    return f"({name} {last[0]} {value} OR ({name} = {value} AND {_sql_after(names[1:], values[1:], last)}))"


def range_predicates(mapping: TableMapping, ranges: list[KeyRange]) -> list[str]:
    """One SQL condition per range, for the parallel scan of a database table.

    Names are those of the replica in double quotes, texts and dates are quoted as literals.
    """

    def literal(value) -> str:
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"

    names = ['"' + k.replace('"', '""') + '"' for k in mapping.keys]
    out = []
    for after, upto in ranges:
        parts = []
        if after is not None:
            parts.append(_sql_after(names, tuple(map(literal, after)), ">"))
        if upto is not None:
            parts.append(_sql_after(names, tuple(map(literal, upto)), "<="))
        out.append(" AND ".join(parts) or "1 = 1")
    return out


def jdbc_options(
    url: str, table: str, key: str, lower: int, upper: int, partitions: int
) -> dict[str, str]:
    """Options for a scan in parallel key ranges."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, driver_options: dict[str, str], **scan) -> DataFrame:
    """Scan a database table; ``driver_options`` hold user, password and driver class."""
    return spark.read.format("jdbc").options(**jdbc_options(**scan), **driver_options).load()


def read_jdbc_ranges(
    spark: SparkSession, url: str, table: str, predicates: list[str], driver_options: dict[str, str]
) -> DataFrame:
    """Scan a database table, one task per predicate; see ``range_predicates``."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=driver_options)


#: Column of a staging table that tells upserts from deletes.
STAGED_OUTCOME = "_outcome"


def staged(changes: DataFrame, mapping: TableMapping) -> DataFrame:
    """A compacted batch as a staging table has it."""
    return changes.select(*named(mapping.targets), F.col(OUTCOME).alias(STAGED_OUTCOME))


def stage_jdbc(
    changes: DataFrame, mapping: TableMapping, url: str, table: str, driver_options: dict[str, str]
) -> None:
    """Put a compacted batch into a staging table, replacing the one before."""
    staged(changes, mapping).write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, truncate="true", **driver_options
    ).save()


def merge_statements(mapping: TableMapping, target: str, staging: str) -> list[str]:
    """The set-based statements that apply a staging table inside the database.

    Names are quoted, as Spark quotes them when it creates the staging table; a database
    that folds unquoted names would not find them otherwise.
    """

    def q(name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    def pairs(names) -> str:
        return " AND ".join(f"t.{q(n)} = s.{q(n)}" for n in names)

    names, outcome = mapping.targets, q(STAGED_OUTCOME)
    sets = ", ".join(f"{q(c.target)} = s.{q(c.target)}" for c in mapping.payload)
    update = f"WHEN MATCHED THEN UPDATE SET {sets} " if sets else ""
    return [
        f"MERGE INTO {target} t USING (SELECT * FROM {staging} WHERE {outcome} = '{UPSERT}') s "
        f"ON ({pairs(mapping.keys)}) {update}"
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(map(q, names))}) "
        f"VALUES ({', '.join('s.' + q(n) for n in names)})",
        f"DELETE FROM {target} t WHERE EXISTS (SELECT 1 FROM {staging} s "
        f"WHERE {pairs(mapping.keys)} AND s.{outcome} = '{DELETE}')",
    ]
