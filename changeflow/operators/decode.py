"""Decode a change log: one parse per record, one outcome per record, no failures."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow import model as m
from changeflow.functions.coerce import coerce_key, coerce_value, from_millis, text_length
from changeflow.functions.json_text import (
    TEXT_MAP,
    also,
    is_other_json,
    last_first,
    last_value,
    parsed,
    place_of,
    quoted,
    settled,
    text_map,
    value_at,
)
from changeflow.model import Column, TableMapping

# Columns that are worked on in one step.
BLOCK = 5
_ENVELOPE = f"op string, before {TEXT_MAP}, after {TEXT_MAP}, ts_ms string, _flawed string"


def _in(names) -> str:
    return f"({', '.join(quoted(n) for n in names)})"


def _parse(log: DataFrame) -> DataFrame:
    """Add what classification needs: the envelope fields and the row image.

    The typed parse reads every sound record in one pass. Only records it cannot settle
    (a flaw anywhere, or no ``op`` value) are parsed again as a plain map, which tells a
    missing field from a null one and a JSON object from a text that looks like one. All
    parsing ends here: parsers do not take part in whole-stage code generation, and what
    follows should.
    """
    df = also(log, _typed=parsed("value", _ENVELOPE, "_flawed"))

    def root(name: str) -> str:
        return last_value("root", name)

    def row_image(name: str) -> str:
        is_object = f"{parsed('value', f'{name} {TEXT_MAP}')}.{name} IS NOT NULL"
        return f"CASE WHEN {is_object} THEN {text_map(root(name))} END"

    # The lambda binds the second parse to a name, so that it is made once per record.
    second_look = f"""transform(array({text_map("value")}), root -> struct(
        {root("op")} AS op,
        {root("ts_ms")} AS ts_ms,
        {root("before")} IS NOT NULL AS has_before,
        {root("after")} IS NOT NULL AS has_after,
        coalesce(map_contains_key(root, 'op'), FALSE) AS has_op,
        root IS NULL AND NOT {is_other_json("value")} AS malformed,
        CASE WHEN root IS NULL THEN NULL
          WHEN {root("op")} = {quoted(m.DELETE_OP)} THEN {row_image("before")}
          ELSE {row_image("after")} END AS image))[0]"""
    unsettled = "_typed IS NOT NULL AND (_typed._flawed IS NOT NULL OR _typed.op IS NULL)"
    df = also(
        df,
        _late=f"CASE WHEN {unsettled} THEN {second_look} END",
        _tombstone="value IS NULL",
    )
    unsettled = "_late IS NOT NULL"
    in_time = f"IF(_typed.op = {quoted(m.DELETE_OP)}, _typed.before, _typed.after)"
    image = f"IF({unsettled}, _late.image, {in_time})"
    has = f"coalesce(IF({unsettled}, _late.has_{{0}}, _typed.{{0}} IS NOT NULL), FALSE)"
    return also(
        df,
        _op=f"IF({unsettled}, _late.op, _typed.op)",
        _ts_ms=f"try_cast(IF({unsettled}, _late.ts_ms, _typed.ts_ms) AS BIGINT)",
        _has_before=has.format("before"),
        _has_after=has.format("after"),
        _blank="_typed IS NULL",
        _malformed="coalesce(_late.malformed, FALSE)",
        _no_op="NOT coalesce(_late.has_op, TRUE)",
        _names=last_first(image),
        _values=f"map_values({image})",
    )


def decode(log: DataFrame, mapping: TableMapping, key_policy: str = "reference") -> DataFrame:
    """Decode and classify the records of ``mapping.topic``.

    Returns the log columns, ``message_key`` (the first key field of the record key), ``op``,
    ``ts_ms``, ``event_time``, ``source`` (as JSON text), ``has_before``, ``has_after``,
    ``outcome``, ``reason`` and ``row``, a struct of the replica columns, which are filled for the
    outcomes ``upsert`` and ``delete`` (key only) alone. Narrow: no shuffle, no Python. Only
    columns that are used cost anything.
    """
    log = log.where(F.col("topic") == mapping.topic)
    kept = [c for c in log.columns if c != "torn"]
    df = _parse(log)
    # Small steps, each column computed once and few columns at a time: one large expression
    # would make a method that the JVM refuses to compile.
    n = mapping.key_columns
    columns = list(enumerate(mapping.columns))
    blocks = [columns[i : i + BLOCK] for i in range(0, len(columns), BLOCK)]
    for b, block in enumerate(blocks):
        df = also(df, **{f"_place{i}": place_of("_names", c.source) for i, c in block})
        df = also(df, **{f"_text{i}": value_at("_values", f"_place{i}") for i, _ in block})
        df = also(df, **{f"_value{i}": _value(i, c, mapping, key_policy) for i, c in block})
        missing = [(c, f"_place{i} IS NULL") for i, c in block]
        broken = [(c, rule) for i, c in block if (rule := _breaks(i, c, mapping, n)) is not None]
        # Projections in a row become one method; a generator between them starts another one.
        add = also if len(blocks) == 1 else settled
        done = {
            f"_row{b}": f"named_struct({', '.join(f'{_q(i)}, _value{i}' for i, _ in block)})",
            f"_missing{b}": _listed(missing),
            f"_broken{b}": _listed(broken),
        }
        keys = [i for i, _ in block if i < n]
        if keys:
            done |= {
                f"_no_key{b}": " OR ".join(f"_place{i} IS NULL" for i in keys),
                f"_bad_key{b}": " OR ".join(f"_value{i} IS NULL" for i in keys),
                f"_bad_text{b}": f"coalesce({', '.join(f'IF(_value{i} IS NULL, _text{i}, NULL)' for i in keys)}, NULL)",
            }
        df = add(df, **done)
        if len(blocks) > 1:
            df = df.drop(*[f"_{kind}{i}" for i, _ in block for kind in ("place", "text", "value")])
    key_blocks = range(-(-n // BLOCK))
    any_of = lambda name: " OR ".join(f"{name}{b} IS NOT NULL" for b in range(len(blocks)))
    all_of = lambda name: f"concat_ws(',', {', '.join(f'{name}{b}' for b in range(len(blocks)))})"
    df = also(
        df,
        _missing=f"CASE WHEN {any_of('_missing')} THEN {all_of('_missing')} END",
        _broken=f"CASE WHEN {any_of('_broken')} THEN {all_of('_broken')} END",
        _no_key=" OR ".join(f"_no_key{b}" for b in key_blocks),
        _bad_key=" OR ".join(f"_bad_key{b}" for b in key_blocks),
        _bad_text=f"coalesce({', '.join(f'_bad_text{b}' for b in key_blocks)}, NULL)",
    )
    torn = "coalesce(torn, FALSE)" if "torn" in log.columns else "FALSE"
    upserts, deletes = f"_op IN {_in(m.UPSERT_OPS)}", f"_op = {quoted(m.DELETE_OP)}"
    df = settled(
        df,
        outcome=f"""CASE
          WHEN {torn} THEN '{m.ERROR_TORN}'
          WHEN _tombstone THEN '{m.ERROR_TOMBSTONE}'
          WHEN _blank THEN '{m.SKIP_NO_OP}'
          WHEN _malformed THEN '{m.ERROR_MALFORMED}'
          WHEN _no_op THEN '{m.SKIP_NO_OP}'
          WHEN _op IS NULL OR _op NOT IN {_in(m.OP_NAMES)} THEN '{m.SKIP_UNKNOWN_OP}'
          WHEN {upserts} AND NOT _has_after THEN '{m.SKIP_NO_AFTER}'
          WHEN {upserts} AND _missing IS NOT NULL THEN '{m.ERROR_MISSING_COLUMN}'
          WHEN {deletes} AND _no_key THEN '{m.SKIP_NO_BEFORE_KEY}'
          WHEN _bad_key THEN '{m.ERROR_BAD_KEY}'
          WHEN {upserts} AND _broken IS NOT NULL THEN '{m.ERROR_CONSTRAINT}'
          WHEN {upserts} THEN '{m.UPSERT}'
          ELSE '{m.DELETE}' END""",
        op=f"IF({torn}, NULL, _op)",
        ts_ms=f"IF({torn}, NULL, _ts_ms)",
        has_before=f"NOT {torn} AND _has_before",
        has_after=f"NOT {torn} AND _has_after",
    )
    reason = f"""CASE outcome
      WHEN '{m.ERROR_MISSING_COLUMN}' THEN _missing
      WHEN '{m.ERROR_CONSTRAINT}' THEN _broken
      WHEN '{m.ERROR_BAD_KEY}' THEN _bad_text
      WHEN '{m.SKIP_UNKNOWN_OP}' THEN op END"""
    valid = f"outcome IN {_in(m.VALID_OUTCOMES)}"
    source = f"IF(_malformed OR {torn}, NULL, get_json_object(value, '$.source'))"

    def field(i: int, c: Column) -> str:
        filled = valid if i < n else f"outcome = '{m.UPSERT}'"
        return f"{quoted(c.target)}, IF({filled}, _row{i // BLOCK}.{_c(i)}, NULL)"

    return df.selectExpr(
        *kept,
        f"{last_value(text_map('key'), mapping.columns[0].source)} AS message_key",
        "op",
        "ts_ms",
        f"{from_millis('ts_ms')} AS event_time",
        f"{source} AS source",
        "has_before",
        "has_after",
        "outcome",
        f"{reason} AS reason",
        f"named_struct({', '.join(field(i, c) for i, c in columns)}) AS row",
    )


def _c(i: int) -> str:
    return f"c{i}"


def _q(i: int) -> str:
    return quoted(_c(i))


def _value(i: int, column: Column, mapping: TableMapping, key_policy: str) -> str:
    if i >= mapping.key_columns:
        return coerce_value(f"_text{i}", column, mapping.empty_is_null)
    text = f"nullif(_text{i}, '')" if column.type == "string" and mapping.empty_is_null else f"_text{i}"
    return coerce_key(text, key_policy, column.type)


def _breaks(i: int, column: Column, mapping: TableMapping, n: int) -> str | None:
    """Condition under which the replica would refuse the value; NULL values always fit."""
    if column.type != "string":
        return None if i < n else f"(_text{i} IS NOT NULL AND _value{i} IS NULL)"
    if column.max_length is None:
        return None
    size = text_length(f"_value{i}", mapping.length_unit)
    return f"coalesce({size} > {column.max_length}, FALSE)"


def _listed(rules) -> str:
    """Feed names of the columns whose rule holds, as one text; NULL if none does."""
    if not rules:
        return "CAST(NULL AS STRING)"
    names = [f"IF({rule}, {quoted(c.source)}, NULL)" for c, rule in rules]
    return f"CASE WHEN {' OR '.join(r for _, r in rules)} THEN concat_ws(',', {', '.join(names)}) END"


def valid_changes(decoded: DataFrame) -> DataFrame:
    """The records that change a replica."""
    return decoded.where(F.col("outcome").isin(*m.VALID_OUTCOMES))


def change_rows(decoded: DataFrame, mapping: TableMapping) -> DataFrame:
    """The valid changes as rows of the replica, all else of a change in one struct."""
    change = F.struct("outcome", "op", "ts_ms", "topic", "partition", "offset").alias(m.CHANGE)
    row = [F.col("row")[c].alias(c) for c in mapping.targets]
    return valid_changes(decoded).select(*row, change)


def dead_letters(decoded: DataFrame) -> DataFrame:
    """The records that do not: raw record, outcome and reason."""
    return decoded.where(~F.col("outcome").isin(*m.VALID_OUTCOMES)).select(
        "topic", "partition", "offset", "timestamp", "key", "value", "op", "outcome", "reason"
    )


def op_name(op: SparkColumn) -> SparkColumn:
    """Name of an operation code; NULL for an unknown one."""
    names = F.create_map(*[F.lit(x) for pair in m.OP_NAMES.items() for x in pair])
    return names[op]
