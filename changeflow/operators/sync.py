"""Keep two replicas of one table in step while both are being changed.

Both sides change the same rows. What has been seen of either side is kept as state, the last
valid change per origin and key, and combining states is associative: however a log is cut
into batches, and in whatever order the two feeds are read, the same changes win.
"""

from __future__ import annotations

from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.coerce import coerce_value, text_length
from changeflow.model import CHANGE, ERROR_CONSTRAINT, Column, TableMapping, ident
from changeflow.operators.compact import latest_per_key
from changeflow.operators.decode import change_rows, decode
from changeflow.operators.merge import by_key, effective_changes, merge_upsert_written, named
from changeflow.operators.quality import key_text

UPPER = "upper"
LOWER = "lower"
# Column of the side a change was made on.
ORIGIN = f"{CHANGE}_origin"
SIDES = (LOWER, UPPER)


class Synced(NamedTuple):
    """Changes to write on each side, freed of echoes, and what a side's limits refuse."""

    to_lower: DataFrame
    to_upper: DataFrame
    refused: DataFrame


def last_of_both(
    log: DataFrame,
    to_lower: TableMapping,
    to_upper: TableMapping,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """The last valid change per key of each feed, as change rows under the lower side's names.

    Column ``ORIGIN`` is the side a change was made on. A change is valid by the limits of its
    own side; text is kept as it was sent. ``earlier`` is the result for what came before;
    the two are combined, in one job over the whole log.
    """

    def feed(mapping: TableMapping, owner: TableMapping, origin: str) -> DataFrame:
        columns = tuple(
            replace(c, target=low.target, max_length=own.max_length)
            for c, low, own in zip(mapping.columns, to_lower.columns, owner.columns)
        )
        own_rules = replace(mapping, columns=columns, length_unit=owner.length_unit, empty_is_null=False)
        return change_rows(decode(log, own_rules), own_rules).withColumn(ORIGIN, F.lit(origin))

    # The feed that goes to the lower side is written by the upper one.
    both = feed(to_lower, to_upper, UPPER).unionByName(feed(to_upper, to_lower, LOWER))
    return combined(both if earlier is None else both.unionByName(earlier), to_lower)


def combined(rows: DataFrame, to_lower: TableMapping) -> DataFrame:
    """The last change per origin and key; in any grouping of the rows the same."""
    return latest_per_key(rows, [ORIGIN, *to_lower.keys])


def state_mapping(to_lower: TableMapping) -> TableMapping:
    """The table that ``last_of_both`` makes: the origin is part of the key."""
    origin = Column(ORIGIN, ORIGIN)
    return replace(to_lower, columns=(origin, *to_lower.columns), key_columns=to_lower.key_columns + 1)


def _fits(row: str, names: TableMapping, side: TableMapping) -> SparkColumn:
    """Whether the texts of a row keep to the limits of a side."""
    fits = F.lit(True)
    for low, c in zip(names.columns, side.columns):
        if c.type == "string" and c.max_length is not None:
            size = F.expr(text_length(f"{row}.{ident(low.target)}", side.length_unit))
            fits = fits & F.coalesce(size <= c.max_length, F.lit(True))
    return fits


def decide(last: DataFrame, to_lower: TableMapping, to_upper: TableMapping) -> DataFrame:
    """One row per key of ``last_of_both``: the key, and in ``_change`` what each side is to have.

    Fields ``upper`` and ``lower`` are the last change of either feed, ``winner`` says which of
    them counts: inside a feed the last arrival did, that is settled already; between the feeds
    the later ``ts_ms`` wins, a missing one is earlier than any, and the upper-case side, the
    source of truth, wins a tie. ``fits`` says whether the other side can store the winner.
    """
    keys = to_lower.keys
    row = F.struct(*named(to_lower.targets), *[F.col(f"{CHANGE}.{f}") for f in ("outcome", "ts_ms")])
    origin = F.col(ORIGIN)
    feeds = last.groupBy(*named(keys)).agg(
        F.struct(*[F.max(F.when(origin == s, row)).alias(s) for s in SIDES]).alias(CHANGE)
    )
    upper, lower = F.col(f"{CHANGE}.{UPPER}"), F.col(f"{CHANGE}.{LOWER}")
    least = F.lit(-(2**63)).cast("bigint")
    upper_wins = upper.isNotNull() & (
        lower.isNull() | (F.coalesce(upper["ts_ms"], least) >= F.coalesce(lower["ts_ms"], least))
    )
    fits = F.when(upper_wins, _fits(f"{CHANGE}.{UPPER}", to_lower, to_lower)).otherwise(
        _fits(f"{CHANGE}.{LOWER}", to_lower, to_upper)
    )
    winner = F.when(upper_wins, F.lit(UPPER)).otherwise(F.lit(LOWER))
    settled = F.col(CHANGE).withField("winner", winner).withField("fits", fits)
    return feeds.select(*named(keys), settled.alias(CHANGE))


def _rows(decided: DataFrame, chosen: SparkColumn, names: TableMapping, side: TableMapping) -> DataFrame:
    """Change rows of one side out of a chosen change; keys without one are left out."""
    picked = decided.select(*named(names.keys), chosen.alias(CHANGE)).where(F.col(CHANGE).isNotNull())
    columns = []
    for i, (low, c) in enumerate(zip(names.columns, side.columns)):
        value = ident(low.target) if i < names.key_columns else f"{CHANGE}.{ident(low.target)}"
        if c.type == "string":
            value = coerce_value(value, Column(c.source, c.target), side.empty_is_null)
        columns.append(F.expr(value).alias(c.target))
    change = F.struct(F.col(f"{CHANGE}.outcome"), F.col(f"{CHANGE}.ts_ms")).alias(CHANGE)
    return picked.select(*columns, change)


def own_changes(decided: DataFrame, origin: str, names: TableMapping, side: TableMapping) -> DataFrame:
    """What a side has changed itself."""
    return _rows(decided, F.col(f"{CHANGE}.{origin}"), names, side)


def foreign_changes(decided: DataFrame, origin: str, names: TableMapping, side: TableMapping) -> DataFrame:
    """Winning changes of the other side that a side can store."""
    other = UPPER if origin == LOWER else LOWER
    comes = (F.col(f"{CHANGE}.winner") == other) & F.col(f"{CHANGE}.fits")
    return _rows(decided, F.when(comes, F.col(f"{CHANGE}.{other}")), names, side)


def settled_changes(decided: DataFrame, origin: str, names: TableMapping, side: TableMapping) -> DataFrame:
    """What a side holds in the end: the other side's change where it wins and fits, else its own."""
    other = UPPER if origin == LOWER else LOWER
    comes = (F.col(f"{CHANGE}.winner") == other) & F.col(f"{CHANGE}.fits")
    chosen = F.when(comes, F.col(f"{CHANGE}.{other}")).otherwise(F.col(f"{CHANGE}.{origin}"))
    return _rows(decided, chosen, names, side)


def refused_changes(decided: DataFrame, names: TableMapping) -> DataFrame:
    """Winners that the other side cannot store: ``side, key, outcome, row`` (as JSON)."""
    side = F.when(F.col(f"{CHANGE}.winner") == UPPER, F.lit(LOWER)).otherwise(F.lit(UPPER))
    winner = F.when(F.col(f"{CHANGE}.winner") == UPPER, F.col(f"{CHANGE}.{UPPER}")).otherwise(
        F.col(f"{CHANGE}.{LOWER}")
    )
    return decided.where(~F.col(f"{CHANGE}.fits")).select(
        side.alias("side"),
        key_text(names).alias("key"),
        F.lit(ERROR_CONSTRAINT).alias("outcome"),
        F.to_json(winner, {"ignoreNullFields": "false"}).alias("row"),
    )


def sync_changes(
    lower: DataFrame,
    upper: DataFrame,
    decided: DataFrame,
    to_lower: TableMapping,
    to_upper: TableMapping,
) -> Synced:
    """What to write on each side, which may or may not hold its own changes yet.

    A change that its side already holds is not among it. ``decided`` is read several times; have
    it come from a written table, so that Spark knows whether it is small. Of a replica only the
    rows with a decided key are looked at.
    """

    def writes(replica: DataFrame, origin: str, side: TableMapping) -> DataFrame:
        own = own_changes(decided, origin, to_lower, side)
        foreign = foreign_changes(decided, origin, to_lower, side)
        touched = by_key(replica, foreign, side, "left_semi")
        held = merge_upsert_written(by_key(touched, own, side, "left_anti"), own, side)
        return effective_changes(held, foreign, side)

    return Synced(
        writes(lower, LOWER, to_lower),
        writes(upper, UPPER, to_upper),
        refused_changes(decided, to_lower),
    )
