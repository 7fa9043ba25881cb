"""A change log with sound and broken records, derived from the ``events`` table.

Both customer feeds carry events: ``value`` decides which side an event happened on, the
number in ``props`` which of the record shapes below it gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from changeflow.model import CUSTOMERS_TO_LOWER, CUSTOMERS_TO_UPPER, TableMapping

# Rules of the derivation, stated again in the comparison SQL.
SIDE_SPLIT = 35.0
ID_STEP = 12
PARTITIONS = 4
TOO_LONG = 300
CUT_AT = 40


def change_log(events: DataFrame) -> DataFrame:
    """The records of both feeds."""
    upper = _feed(events.where(f"value < {SIDE_SPLIT}"), CUSTOMERS_TO_LOWER, "concat('L', k)")
    lower = _feed(
        events.where(f"value >= {SIDE_SPLIT} OR value IS NULL"),
        CUSTOMERS_TO_UPPER,
        "IF(k < 55, '', concat('L', k))",
    )
    return upper.unionByName(lower)


def _feed(events: DataFrame, mapping: TableMapping, last_name: str) -> DataFrame:
    key, first, last, mail = [c.source for c in mapping.columns]
    _, schema, table = mapping.topic.rsplit(".", 2)
    email = "concat('u', user_id, '.', k, '@example.com')"
    row = f"""struct(
      user_id * {ID_STEP} AS {key}, event_type AS {first},
      IF(k >= 50, {last_name}, NULL) AS {last},
      IF(event_type = 'purchase' AND k < 5, rpad({email}, {TOO_LONG}, 'x'), {email}) AS {mail})"""
    op = """CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r'
      WHEN 'error' THEN CASE WHEN k < 45 THEN 'd' WHEN k < 85 THEN 'u' ELSE 't' END
      ELSE 'u' END"""
    no_after = """(event_type = 'click' AND k < 5
      OR event_type = 'error' AND (k < 45 OR k >= 70))"""
    # Explicit nulls are part of an envelope.
    sound = f"""to_json(struct(
        {op} AS op,
        IF(event_type = 'error' AND k < 35, {row}, NULL) AS before,
        IF({no_after}, NULL, {row}) AS after,
        struct('{schema}' AS schema, '{table}' AS table) AS source,
        unix_millis(CAST(ts AS TIMESTAMP)) AS ts_ms),
      map('ignoreNullFields', 'false'))"""
    value = f"""CASE
      WHEN event_type = 'view' AND k < 5 THEN regexp_replace(sound, ',"{mail}":"[^"]*"', '')
      WHEN event_type = 'purchase' AND k BETWEEN 5 AND 9
        THEN regexp_replace(sound, '("{key}":[0-9]+)', '$1.0')
      WHEN event_type <> 'error' OR k < 35 OR k >= 85 THEN sound
      WHEN k < 45 THEN replace(sound, '"before":null', '"before":{{}}')
      WHEN k < 55 THEN NULL
      WHEN k < 70 THEN left(sound, {CUT_AT})
      ELSE replace(sound, '"op":"u",', '') END"""
    numbered = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    )
    return numbered.selectExpr("*", f"{sound} AS sound").selectExpr(
        f"'{mapping.topic}' AS topic",
        f"CAST(user_id % {PARTITIONS} AS INT) AS partition",
        "event_id AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        f"to_json(struct(user_id * {ID_STEP} AS {key})) AS key",
        f"{value} AS value",
    )
