"""Turn the text of a JSON field into a typed column. Nothing here ever throws."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F

from changeflow.model import Column

KEY_POLICIES = ("reference", "strict")


def coerce_key(text: str, policy: str = "reference", type_: str = "bigint") -> str:
    """SQL for a key of a text, NULL when the key cannot be used.

    A text key is the text, a date its days. For integers a fraction is cut off and a whole double
    such as ``1.0`` counts as an integer. Under ``reference`` a missing or non-numeric text becomes
    0; under ``strict`` those and fractions are unusable. Booleans and numbers beyond the type are
    unusable always.
    """
    if policy not in KEY_POLICIES:
        raise ValueError(f"unknown key policy {policy!r}")
    if type_ == "string":
        return text
    if type_ == "date_days":
        return f"date_from_unix_date(try_cast({text} AS INT))"
    number = f"try_cast({text} AS DOUBLE)"
    whole = f"coalesce(try_cast({text} AS BIGINT), try_cast({number} AS BIGINT))"
    fits = whole if type_ == "bigint" else f"try_cast({whole} AS {type_})"
    if policy == "strict":
        return f"CASE WHEN CAST({whole} AS DOUBLE) = {number} THEN {fits} END"
    return f"""CASE WHEN {text} IN ('true', 'false') THEN NULL
      WHEN {number} IS NULL THEN CAST(0 AS {type_}) ELSE {fits} END"""


def coerce_value(text: str, column: Column, empty_is_null: bool = False) -> str:
    """SQL for the replica value of a text; NULL when the text does not fit the type.

    A number with a fraction does not fit an integer column; ``2.0`` does.
    """
    if column.type == "string":
        return f"nullif({text}, '')" if empty_is_null else text
    if column.type == "double":
        return f"try_cast({text} AS DOUBLE)"
    whole = "BIGINT" if column.type == "timestamp_millis" else "INT"
    whole = column.type if column.type in ("bigint", "int") else whole
    digits = f"IF({text} RLIKE '^[+-]?[0-9]+$', try_cast({text} AS {whole}), NULL)"
    number = f"try_cast({text} AS DOUBLE)"
    exact = f"coalesce({digits}, IF({number} = floor({number}), try_cast({number} AS {whole}), NULL))"
    if column.type == "timestamp_millis":
        return from_millis(exact)
    if column.type == "date_days":
        return f"date_from_unix_date({exact})"
    return exact


def from_millis(millis: str) -> str:
    """SQL for the timestamp of epoch milliseconds, NULL when no timestamp is that far away."""
    limit = (2**63 - 1) // 1000
    return f"timestamp_millis(IF({millis} BETWEEN -{limit} AND {limit}, {millis}, NULL))"


def text_length(value: str, unit: str) -> str:
    return f"octet_length({value})" if unit == "bytes" else f"char_length({value})"


def to_wire(value: SparkColumn, column: Column) -> SparkColumn:
    """The inverse: a replica value as it is written into an envelope."""
    if column.type == "timestamp_millis":
        return F.unix_millis(value.cast("timestamp"))
    if column.type == "date_days":
        return F.unix_date(value)
    return value.cast(column.type)
