"""Prove that replicas agree and that a feed is sound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.coerce import text_length
from changeflow.model import CHANGE, VALID_OUTCOMES, TableMapping, ident
from changeflow.operators.merge import named, same_key


def constraint_violations(
    table: DataFrame, checks: TableMapping | dict[str, TableMapping]
) -> DataFrame:
    """Rows ``rule, column_name, key, detail`` for every broken rule of the replica.

    ``not_null`` and ``unique`` on the key, ``length`` on text columns; ``detail`` is the
    number of rows with that key or the measured length. Several mappings of one table with the
    same key, by name, are checked together and told apart by column ``checked``.
    """
    mappings = checks if isinstance(checks, dict) else {"": checks}
    first = next(iter(mappings.values()))
    if any(m.keys != first.keys for m in mappings.values()):
        raise ValueError("mappings that are checked together need the same key")
    key = key_text(first)
    name = ", ".join(first.keys)
    incomplete = reduce(lambda a, b: a | b, [k.isNull() for k in named(first.keys)])
    rules = []
    for checked, mapping in mappings.items():
        for c in mapping.payload:
            if c.type == "string" and c.max_length is not None:
                size = F.expr(text_length(ident(c.target), mapping.length_unit))
                rules.append(F.when(size > c.max_length, _violation(checked, "length", c.target, size)))
        rules.append(F.when(incomplete, _violation(checked, "not_null", name, F.lit(1))))
    per_row = table.select(key.alias("key"), F.inline(F.array_compact(F.array(*rules))))
    counted = table.where(~incomplete).groupBy(key.alias("key")).count().where("count > 1")
    twice = counted.select(
        "key",
        F.inline(F.array(*[_violation(c, "unique", name, F.col("count")) for c in mappings])),
    )
    columns = ["rule", "column_name", "key", "detail"]
    if isinstance(checks, dict):
        columns = ["checked", *columns]
    return per_row.select(*columns).unionByName(twice.select(*columns))


def key_text(mapping: TableMapping) -> SparkColumn:
    """The key as text: the value of a single column, else a JSON object."""
    keys = named(mapping.keys)
    return keys[0].cast("string") if len(keys) == 1 else F.to_json(F.struct(*keys))


def _violation(checked: str, rule: str, column: str, detail: SparkColumn) -> SparkColumn:
    return F.struct(
        F.lit(checked).alias("checked"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        detail.cast("bigint").alias("detail"),
    )


def replica_counts(replicas: dict[str, DataFrame]) -> DataFrame:
    """``replica, row_count, label`` for each named replica."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("replica"),
            "row_count",
            F.concat(F.lit("rows held: "), F.col("row_count").cast("string")).alias("label"),
        )
        for name, df in replicas.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile(lower: DataFrame, upper: DataFrame, mapping: TableMapping) -> DataFrame:
    """Compare two replicas key by key: ``key, status``.

    ``mapping`` leads from the names of ``upper`` to those of ``lower``. Status is ``match``,
    ``differ``, ``only_lower`` or ``only_upper``; a key of several columns is a struct. An empty text counts as NULL, because one
    side cannot store it.
    """

    def plain(df: DataFrame, names: list[str]) -> DataFrame:
        values = [
            F.nullif(v, F.lit("")) if c.type == "string" else v
            for v, c in zip(named(names), mapping.columns)
        ]
        values = [v.alias(c.target) for v, c in zip(values, mapping.columns)]
        n = mapping.key_columns
        return df.select(*values[:n], F.struct(F.lit(1), *values[n:]).alias(CHANGE))

    a = plain(lower, mapping.targets).alias("a")
    b = plain(upper, [c.source for c in mapping.columns]).alias("b")
    left, right = F.col(f"a.{CHANGE}"), F.col(f"b.{CHANGE}")
    status = (
        F.when(right.isNull(), "only_lower")
        .when(left.isNull(), "only_upper")
        .when(left == right, "match")
        .otherwise("differ")
    )
    keys = [F.coalesce(p, q) for p, q in zip(named(mapping.keys, "a"), named(mapping.keys, "b"))]
    key = keys[0] if len(keys) == 1 else F.struct(*[k.alias(n) for k, n in zip(keys, mapping.keys)])
    joined = a.join(b, same_key(mapping, "a", "b"), "full_outer")
    return joined.select(key.alias("key"), status.alias("status"))


def outcome_stats(decoded: DataFrame) -> DataFrame:
    """Records per topic, operation and outcome."""
    return decoded.groupBy("topic", "op", "outcome").agg(F.count(F.lit(1)).alias("records"))


def sync_health(
    lower: DataFrame, upper: DataFrame, decoded: DataFrame, max_dead_rate: float
) -> DataFrame:
    """Checks as rows ``check_name, ok, detail``, with the verdict in row ``all``.

    Only existence probes stop early; the counts are plain aggregates with one row each.
    """

    def non_empty(name: str, df: DataFrame) -> DataFrame:
        found = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
        return found.select(
            F.lit(f"{name}_non_empty").alias("check_name"),
            (F.col("n") > 0).alias("ok"),
            F.col("n").cast("string").alias("detail"),
        )

    counts = replica_counts({"lower": lower, "upper": upper}).agg(
        F.min("row_count").alias("least"),
        F.max("row_count").alias("most"),
    )
    counts = counts.select(
        F.lit("counts_agree").alias("check_name"),
        (F.col("least") == F.col("most")).alias("ok"),
        F.concat_ws(" / ", F.col("least").cast("string"), F.col("most").cast("string")).alias(
            "detail"
        ),
    )
    dead = F.count_if(~F.col("outcome").isin(*VALID_OUTCOMES))
    rate = decoded.agg(dead.alias("dead"), F.count(F.lit(1)).alias("n")).select(
        F.lit("dead_letter_rate").alias("check_name"),
        (F.col("dead") <= F.col("n") * F.lit(max_dead_rate)).alias("ok"),
        F.concat_ws(" / ", F.col("dead").cast("string"), F.col("n").cast("string")).alias("detail"),
    )
    checks = (
        non_empty("lower", lower)
        .unionByName(non_empty("upper", upper))
        .unionByName(counts)
        .unionByName(rate)
    )
    # The verdict comes out of the same pass over the checks.
    return checks.rollup("check_name").agg(
        F.bool_and("ok").alias("ok"),
        F.when(F.grouping("check_name") == 0, F.max("detail")).alias("detail"),
    ).select(F.coalesce("check_name", F.lit("all")).alias("check_name"), "ok", "detail")
