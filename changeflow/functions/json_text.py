"""JSON expressions that follow last-wins on duplicate names and keep missing apart from null.

Expressions are SQL text: one text per projection reaches the JVM in one call, where a tree
of Column objects takes one call per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

TEXT_MAP = "map<string,string>"
# Plain JSON only: Spark would otherwise also take single quotes and NaN.
_STRICT = "'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false'"


def quoted(text: str) -> str:
    """A text as SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def parsed(text: str, schema: str, flawed: str | None = None) -> str:
    """A JSON text as ``schema``; ``flawed`` names the field that keeps a bad record."""
    keep = f", 'columnNameOfCorruptRecord', {quoted(flawed)}" if flawed else ""
    return f"from_json({text}, '{schema}', map({_STRICT}{keep}))"


def text_map(text: str) -> str:
    """A JSON object as map of name to text, duplicates kept; NULL for anything else."""
    return parsed(text, TEXT_MAP)


def last_first(entries: str) -> str:
    """The names of a map from the last to the first, so that a search finds the last one."""
    return f"reverse(map_keys({entries}))"


def place_of(names: str, name: str) -> str:
    """Place of a name counted from the end of the map; NULL when missing."""
    return f"CAST(nullif(array_position({names}, {quoted(name)}), 0) AS INT)"


def value_at(values: str, place: str) -> str:
    return f"try_element_at({values}, -{place})"


def last_value(entries: str, name: str) -> str:
    """Value of the last entry called ``name``; NULL when missing or null."""
    return value_at(f"map_values({entries})", place_of(last_first(entries), name))


def is_other_json(text: str) -> str:
    """Whether a text that could not be read as JSON object is JSON of another kind."""
    # An array is not tried as variant, which takes no objects with duplicate names.
    return f"""CASE left(ltrim(' \\t\\r\\n', {text}), 1)
      WHEN '{{' THEN FALSE
      WHEN '[' THEN {parsed(text, "array<string>")} IS NOT NULL
      ELSE try_parse_json({text}) IS NOT NULL END"""


def also(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns to those there are."""
    return df.selectExpr("*", *[f"{value} AS {name}" for name, value in columns.items()])


def settled(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns that later filters leave alone.

    A filter on a projected column is pushed below the projection, down to the scan if it can,
    and repeats every expression on its way, parses included. A generator is a barrier to
    that, and still runs inside generated code.
    """
    named = ", ".join(f"{value} AS {name}" for name, value in columns.items())
    return df.selectExpr("*", f"inline(array(struct({named})))")
