"""Data model: the change log, the envelope, and the mapping of one table to its replica."""

from __future__ import annotations

from dataclasses import dataclass

# Columns of a change log; the same names and types as Spark's Kafka source after
# key and value are cast to text.
LOG_SCHEMA = (
    "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
)

# Fixed values of the envelope: the operation codes and what they are called.
OP_NAMES = {"c": "create", "u": "update", "d": "delete", "r": "read"}
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"

# Every record gets exactly one of these outcomes; only the first two change a replica.
UPSERT = "upsert"
DELETE = "delete"
ERROR_TORN = "error_torn"
ERROR_TOMBSTONE = "error_tombstone"
ERROR_MALFORMED = "error_malformed"
ERROR_MISSING_COLUMN = "error_missing_column"
ERROR_BAD_KEY = "error_bad_key"
ERROR_CONSTRAINT = "error_constraint"
SKIP_NO_OP = "skip_no_op"
SKIP_UNKNOWN_OP = "skip_unknown_op"
SKIP_NO_AFTER = "skip_no_after"
SKIP_NO_BEFORE_KEY = "skip_no_before_key"
VALID_OUTCOMES = (UPSERT, DELETE)

# A change row has the columns of its replica and one struct with everything else, under this
# name, so that a table may call its columns whatever it likes otherwise.
CHANGE = "_change"

# How a column travels in the JSON: SQL type of the replica column by mapping type.
# Decimals are sent as doubles, timestamps as epoch milliseconds, dates as epoch days.
SQL_TYPES = {
    "string": "string",
    "bigint": "bigint",
    "int": "int",
    "double": "double",
    "timestamp_millis": "timestamp",
    "date_days": "date",
}
# Types a key may have: those whose text names one value.
KEY_TYPES = ("bigint", "int", "string", "date_days")


def ident(name: str) -> str:
    """A column name as SQL identifier, whatever characters it has."""
    escaped = name.replace("`", "``")
    return f"`{escaped}`"


@dataclass(frozen=True)
class Column:
    """One replicated column: its name in the feed, its name in the replica, its type."""

    source: str
    target: str
    type: str = "string"
    max_length: int | None = None


@dataclass(frozen=True)
class TableMapping:
    """How the feed of one table is written to its replica.

    The first ``key_columns`` columns are the key.

    ``length_unit`` and ``empty_is_null`` describe the replica that receives the rows:
    whether its text limits count characters or bytes, and whether it stores an empty
    text as NULL.
    """

    topic: str
    columns: tuple[Column, ...]
    length_unit: str = "characters"
    empty_is_null: bool = False
    key_columns: int = 1

    def __post_init__(self) -> None:
        if self.length_unit not in ("characters", "bytes"):
            raise ValueError(f"unknown length unit {self.length_unit!r}")
        unknown = [c.type for c in self.columns if c.type not in SQL_TYPES]
        if unknown:
            raise ValueError(f"unknown column types {unknown}")
        if not 1 <= self.key_columns <= len(self.columns):
            raise ValueError("a key has at least one column and at most all of them")
        unfit = [c.type for c in self.key_fields if c.type not in KEY_TYPES]
        if unfit:
            raise ValueError(f"a key cannot have the types {unfit}")
        for names in (self.targets, [c.source for c in self.columns]):
            if len(set(names)) < len(names) or CHANGE in names:
                raise ValueError(f"column names must be unique and not {CHANGE!r}: {names}")

    @property
    def key_fields(self) -> tuple[Column, ...]:
        return self.columns[: self.key_columns]

    @property
    def keys(self) -> list[str]:
        """Names of the key in the replica."""
        return [c.target for c in self.key_fields]

    @property
    def payload(self) -> tuple[Column, ...]:
        """The columns behind the key."""
        return self.columns[self.key_columns :]

    @property
    def targets(self) -> list[str]:
        return [c.target for c in self.columns]

    @property
    def replica_schema(self) -> str:
        return ", ".join(f"{ident(c.target)} {SQL_TYPES[c.type]}" for c in self.columns)


# The two directions of the customers table. Topic names, column names in
# both spellings, and the limit of 255, counted in bytes by the upper-case side (which
# also stores an empty text as NULL) and in characters by the lower-case side.
CUSTOMERS_TO_LOWER = TableMapping(
    topic="oracle.DBZUSER.CUSTOMERS",
    columns=(
        Column("ID", "id", "bigint"),
        Column("FIRST_NAME", "first_name", max_length=255),
        Column("LAST_NAME", "last_name", max_length=255),
        Column("EMAIL", "email", max_length=255),
    ),
)
CUSTOMERS_TO_UPPER = TableMapping(
    topic="postgres.public.customers",
    columns=(
        Column("id", "ID", "bigint"),
        Column("first_name", "FIRST_NAME", max_length=255),
        Column("last_name", "LAST_NAME", max_length=255),
        Column("email", "EMAIL", max_length=255),
    ),
    length_unit="bytes",
    empty_is_null=True,
)
