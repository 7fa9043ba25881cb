"""Choose feeds by the name of their topic, ``prefix.schema.table``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what the topics of captured tables look like.
FEED_PATTERN = r"^(oracle|postgres)\."


def topic_name(prefix: str, schema: str, table: str) -> str:
    return f"{prefix}.{schema}.{table}"


def _parts() -> tuple[Column, Column, Column]:
    """Prefix, schema and table. The prefix may have dots, schema and table are the last two."""
    parts = F.split("topic", r"\.")
    full = F.size(parts) >= 3
    cut = F.greatest(F.size(parts) - 2, F.lit(1))
    return (
        F.array_join(F.slice(parts, 1, cut), "."),
        F.when(full, F.element_at(parts, -2)).otherwise(F.get(parts, F.lit(1))),
        F.when(full, F.element_at(parts, -1)),
    )


def route_topics(log: DataFrame) -> DataFrame:
    """Add ``origin, schema_name, table_name`` and ``is_feed`` (matches the feed pattern)."""
    origin, schema, table = _parts()
    return log.select(
        "*",
        origin.alias("origin"),
        schema.alias("schema_name"),
        table.alias("table_name"),
        F.col("topic").rlike(FEED_PATTERN).alias("is_feed"),
    )


def include_tables(log: DataFrame, schemas: Sequence[str], tables: Sequence[str]) -> DataFrame:
    """Only records of listed schemas and listed ``schema.table`` names."""
    _, schema, table = _parts()
    return log.where(schema.isin(*schemas) & F.concat_ws(".", schema, table).isin(*tables))
