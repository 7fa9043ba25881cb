"""One hand-written record per rule of the outcome taxonomy."""

import json

import pytest

from changeflow import CUSTOMERS_TO_LOWER, CUSTOMERS_TO_UPPER, Column, TableMapping
from changeflow.operators import merge
from changeflow.operators.compact import latest_per_key
from changeflow.operators.decode import change_rows, dead_letters, decode, op_name, valid_changes
from pyspark.sql import functions as F

UPPER = CUSTOMERS_TO_LOWER.topic
ROW = {"ID": 1, "FIRST_NAME": "a", "LAST_NAME": None, "EMAIL": "e"}


def row_json(**changes):
    return json.dumps({**ROW, **changes})


def create(image):
    return '{"op":"c","after":' + image + "}"


# value, outcome, id
CASES = [
    (create(row_json()), "upsert", 1),
    (create(row_json(ID=1.0)), "upsert", 1),
    (create(row_json(ID="12.7")), "upsert", 12),
    (create(row_json(ID=12.7)), "upsert", 12),
    (create(row_json(ID=-12.7)), "upsert", -12),
    (create(row_json(ID="abc")), "upsert", 0),
    (create(row_json(ID="")), "upsert", 0),
    (create(row_json(ID=None)), "upsert", 0),
    (create(row_json(ID=True)), "error_bad_key", None),
    (create(row_json(ID=1e30)), "error_bad_key", None),
    (create(row_json(ID=9999999999999999999)), "error_bad_key", None),
    (create(row_json(ID=9223372036854775807)), "upsert", 9223372036854775807),
    (create('{"ID":1,"FIRST_NAME":"a","LAST_NAME":null}'), "error_missing_column", None),
    (create('{"FIRST_NAME":"a","LAST_NAME":null,"EMAIL":"e"}'), "error_missing_column", None),
    (create("{}"), "error_missing_column", None),
    (create('"x"'), "error_missing_column", None),
    (create("[1,2]"), "error_missing_column", None),
    (create("7"), "error_missing_column", None),
    (create(json.dumps(row_json())), "error_missing_column", None),
    ("{'op':'c'}", "error_malformed", None),
    (create('{"ID":NaN,"FIRST_NAME":"a","LAST_NAME":"b","EMAIL":"c"}'), "error_malformed", None),
    ('{"op":"u","after":null}', "skip_no_after", None),
    ('{"op":"u"}', "skip_no_after", None),
    ('{"op":"u","before":' + row_json() + "}", "skip_no_after", None),
    ('{"op":"u","before":5,"after":null}', "skip_no_after", None),
    ('{"op":"u","before":5,"after":' + row_json(ID=8) + "}", "upsert", 8),
    ('{"op":"r","before":null,"after":' + row_json(ID=9) + "}", "upsert", 9),
    ('{"op":"d","before":{"ID":1},"after":null}', "delete", 1),
    ('{"op":"d","before":{"ID":null}}', "delete", 0),
    ('{"op":"d","before":{"ID":true}}', "error_bad_key", None),
    ('{"op":"d","before":{"ID":3},"after":"x"}', "delete", 3),
    ('{"op":"d","before":{}}', "skip_no_before_key", None),
    ('{"op":"d","before":null}', "skip_no_before_key", None),
    ('{"op":"d"}', "skip_no_before_key", None),
    ('{"op":"d","before":5}', "skip_no_before_key", None),
    ('{"op":"d","before":"{\\"ID\\":1}"}', "skip_no_before_key", None),
    ('{"op":"t"}', "skip_unknown_op", None),
    ('{"op":"C","after":' + row_json() + "}", "skip_unknown_op", None),
    ('{"op":null}', "skip_unknown_op", None),
    ('{"op":1}', "skip_unknown_op", None),
    ('{"op":{"a":1}}', "skip_unknown_op", None),
    ('{"op":null,"after":5}', "skip_unknown_op", None),
    ('{"after":{}}', "skip_no_op", None),
    ('{"after":5}', "skip_no_op", None),
    ("{}", "skip_no_op", None),
    ('[{"op":"c"}]', "skip_no_op", None),
    ('[{"op":"c","op":"d"}]', "skip_no_op", None),
    ("[]", "skip_no_op", None),
    ("5", "skip_no_op", None),
    ("null", "skip_no_op", None),
    ('"c"', "skip_no_op", None),
    ("", "skip_no_op", None),
    ("  ", "skip_no_op", None),
    ("\n\t", "skip_no_op", None),
    (None, "error_tombstone", None),
    ('{"op":"c"', "error_malformed", None),
    ('{"op":"c","after":{"ID":1,}}', "error_malformed", None),
    ('{"op":"c" "after":{}}', "error_malformed", None),
    ("abc", "error_malformed", None),
    (create(row_json(ID=4)) + " garbage", "upsert", 4),
    ('{"op":"c","op":"d","before":{"ID":6}}', "delete", 6),
    ('{"op":"d","op":null,"before":{"ID":6}}', "skip_unknown_op", None),
    ('{"op":"u","after":null,"after":' + row_json(ID=5) + "}", "upsert", 5),
    ('{"op":"u","after":' + row_json() + ',"after":null}', "skip_no_after", None),
    ('{"op":"u","after":' + row_json() + ',"after":5}', "error_missing_column", None),
    ('{"op":"u","after":5,"after":' + row_json(ID=5) + "}", "upsert", 5),
    (
        create('{"ID":1,"FIRST_NAME":"a","LAST_NAME":"b","EMAIL":"c","ID":2}'),
        "upsert",
        2,
    ),
    (
        create('{"id":1,"first_name":"a","last_name":"b","email":"c"}'),
        "error_missing_column",
        None,
    ),
    ('{"op":"c","after":' + "[" * 1500 + "]" * 1500 + "}", "error_malformed", None),
    (create(row_json(EMAIL="x" * 256)), "error_constraint", None),
    (create(row_json(EMAIL="x" * 255)), "upsert", 1),
    (create(row_json(EMAIL="é" * 255)), "upsert", 1),
    (create(row_json(EMAIL="é" * 256)), "error_constraint", None),
]


def make_log(spark, values, topic=UPPER, key='{"ID":1}'):
    rows = [(topic, 0, i, key, v) for i, v in enumerate(values)]
    schema = "topic string, partition int, offset bigint, key string, value string"
    df = spark.createDataFrame(rows, schema)
    stamp = F.timestamp_millis(F.lit(0).cast("bigint"))
    return df.select("topic", "partition", "offset", stamp.alias("timestamp"), "key", "value")


def decoded_rows(df):
    return sorted(df.collect(), key=lambda r: r.offset)


def test_every_outcome(spark):
    rows = decoded_rows(decode(make_log(spark, [c[0] for c in CASES]), CUSTOMERS_TO_LOWER))
    got = [(c[0], r.outcome, r.row.id) for c, r in zip(CASES, rows)]
    assert len(rows) == len(CASES)
    assert got == CASES


def test_outcomes_do_not_depend_on_session_settings(spark):
    values = [c[0] for c in CASES]
    settings = {
        "spark.sql.ansi.enabled": "false",
        "spark.sql.json.enablePartialResults": "false",
        "spark.sql.codegen.wholeStage": "false",
    }
    for name, value in settings.items():
        before = spark.conf.get(name)
        spark.conf.set(name, value)
        try:
            rows = decoded_rows(decode(make_log(spark, values), CUSTOMERS_TO_LOWER))
            assert [(c[0], r.outcome, r.row.id) for c, r in zip(CASES, rows)] == CASES, name
        finally:
            spark.conf.set(name, before)


def test_filtering_gives_the_same_rows(spark):
    log = make_log(spark, [c[0] for c in CASES])
    decoded = decode(log, CUSTOMERS_TO_LOWER)
    valid = {r.offset for r in valid_changes(decoded).collect()}
    dead = {r.offset for r in dead_letters(decoded).collect()}
    assert valid == {i for i, c in enumerate(CASES) if c[1] in ("upsert", "delete")}
    assert valid | dead == set(range(len(CASES))) and not valid & dead


def test_strict_keys(spark):
    cases = [
        (row_json(ID=1.0), 1),
        (row_json(ID="7"), 7),
        (row_json(ID="12.7"), None),
        (row_json(ID=None), None),
        (row_json(ID="abc"), None),
        (row_json(ID=True), None),
        (row_json(ID=1e30), None),
        (row_json(ID=9007199254740993), 9007199254740993),
    ]
    log = make_log(spark, [create(c[0]) for c in cases])
    rows = decoded_rows(decode(log, CUSTOMERS_TO_LOWER, "strict"))
    assert [r.row.id for r in rows] == [c[1] for c in cases]
    assert {r.outcome for r in rows if r.row.id is None} == {"error_bad_key"}


def test_text_columns(spark):
    values = [
        create('{"ID":1,"FIRST_NAME":12.50,"LAST_NAME":true,"EMAIL":null}'),
        create('{"ID":1,"FIRST_NAME":7,"LAST_NAME":"","EMAIL":"x","EMAIL":"y"}'),
        '{"op":"d","before":{"ID":1,"FIRST_NAME":"gone"}}',
    ]
    rows = decoded_rows(decode(make_log(spark, values), CUSTOMERS_TO_LOWER))
    got = [(r.row.first_name, r.row.last_name, r.row.email) for r in rows]
    assert got == [("12.5", "true", None), ("7", "", "y"), (None, None, None)]


def test_upper_side_counts_bytes_and_has_no_empty_text(spark):
    def image(email):
        return create(json.dumps({"id": 1, "first_name": "", "last_name": "b", "email": email}))

    log = make_log(spark, [image("x" * 255), image("é" * 128)], topic=CUSTOMERS_TO_UPPER.topic)
    first, second = decoded_rows(decode(log, CUSTOMERS_TO_UPPER))
    assert (first.outcome, first.row.FIRST_NAME, first.row.LAST_NAME) == ("upsert", None, "b")
    assert (second.outcome, second.reason) == ("error_constraint", "email")


def test_reasons_and_metadata(spark):
    values = [
        create('{"ID":1,"FIRST_NAME":"a"}'),
        create(row_json(ID="true")),
        '{"op":"t","ts_ms":1642000000}',
        '{"op":"d","before":{"ID":2},"after":5,"ts_ms":"12"}',
    ]
    rows = decoded_rows(decode(make_log(spark, values, key='{"ID":31}'), CUSTOMERS_TO_LOWER))
    assert [r.reason for r in rows] == ["LAST_NAME,EMAIL", "true", "t", None]
    assert [r.ts_ms for r in rows] == [None, None, 1642000000, 12]
    assert [(r.has_before, r.has_after) for r in rows] == [
        (False, True),
        (False, True),
        (False, False),
        (True, True),
    ]
    assert {r.message_key for r in rows} == {"31"}


def test_envelope_metadata(spark):
    values = [
        '{"op":"t","source":{"table":"T","lsn":1},"ts_ms":1642000000123}',
        '{"op":"t","ts_ms":9223372036854775807}',
        '{"op":"t","ts_ms":"soon","source":null}',
        '{"op":"t","source":{"table":"T"},"ts_ms":1642000000123',
    ]
    decoded = decode(make_log(spark, values), CUSTOMERS_TO_LOWER)
    decoded = decoded.withColumn("millis", F.unix_millis("event_time"))
    got = [(r.millis, r.source) for r in decoded_rows(decoded)]
    assert got == [(1642000000123, '{"table":"T","lsn":1}'), (None, None), (None, None), (None, None)]


def test_typed_columns_that_do_not_fit(spark):
    mapping = TableMapping(
        topic=UPPER,
        columns=(
            Column("ID", "id", "bigint"),
            Column("N", "n", "int"),
            Column("D", "d", "double"),
            Column("T", "t", "timestamp_millis"),
            Column("DAY", "day", "date_days"),
        ),
    )

    def image(**changes):
        return create(json.dumps({"ID": 1, "N": 2, "D": 0.5, "T": 1000, "DAY": 1, **changes}))

    values = [
        image(),
        image(N=None, D=None, T=None, DAY=None),
        image(N=2.0, D=3),
        image(N="x"),
        image(N=3000000000),
        image(N=12.7),
        image(N="3.9"),
        image(D="x"),
        image(T=9223372036854775807),
        image(T=1.5),
        image(DAY="1970-01-01"),
        image(DAY=0.5),
    ]
    rows = decoded_rows(decode(make_log(spark, values), mapping))
    assert [r.outcome for r in rows] == ["upsert"] * 3 + ["error_constraint"] * 9
    assert [r.reason for r in rows[3:]] == ["N"] * 4 + ["D", "T", "T", "DAY", "DAY"]
    first, second, third = [r.row for r in rows[:3]]
    assert (first.n, first.d, first.t.second, str(first.day)) == (2, 0.5, 1, "1970-01-02")
    assert (second.n, second.d, second.t, second.day) == (None, None, None, None)
    assert (third.n, third.d) == (2, 3.0)


def test_other_topics_are_left_out(spark):
    log = make_log(spark, [c[0] for c in CASES], topic="oracle.DBZUSER.OTHER")
    assert decode(log, CUSTOMERS_TO_LOWER).count() == 0


def test_op_names(spark):
    df = spark.createDataFrame([(o,) for o in ("c", "u", "d", "r", "t", None)], "op string")
    names = [r[0] for r in df.select(op_name(F.col("op"))).collect()]
    assert names == ["create", "update", "delete", "read", None, None]


def test_the_record_is_parsed_once(spark, tmp_path):
    # Through a file: on local rows the optimizer would evaluate the plan itself.
    make_log(spark, [c[0] for c in CASES]).write.parquet(str(tmp_path / "log"))
    decoded = decode(spark.read.parquet(str(tmp_path / "log")), CUSTOMERS_TO_LOWER)
    filters = ["TRUE", "outcome = 'upsert'", "op = 'd'", "ts_ms > 5", "row.id = 3 AND has_after"]
    for condition in filters:
        plan = decoded.where(condition)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("StructField(_flawed") == 1, condition
        assert plan.count("transform(") == 1, condition


def test_unneeded_columns_are_not_read(spark, tmp_path):
    make_log(spark, [c[0] for c in CASES]).write.parquet(str(tmp_path / "log"))
    decoded = decode(spark.read.parquet(str(tmp_path / "log")), CUSTOMERS_TO_LOWER)
    plan = decoded.select("row.id", "outcome")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<topic:string,value:string>" in plan
    assert "EqualTo(topic,oracle.DBZUSER.CUSTOMERS)" in plan


def method_sizes(spark, df):
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$")
    plan = df._jdf.queryExecution().executedPlan()
    stages = debug.__getattr__("MODULE$").codegenStringSeq(plan).iterator()
    sizes = []
    while stages.hasNext():
        sizes.append(stages.next()._3().maxMethodCodeSize())
    return sizes


@pytest.mark.parametrize("width", [4, 16, 40])
def test_generated_methods_stay_small_enough_to_compile(spark, tmp_path, width):
    kinds = ["string", "bigint", "double", "timestamp_millis", "date_days"]
    columns = [Column("K", "k", "bigint")]
    columns += [
        Column(f"C{i}", f"c{i}", kinds[i % 5], 50 if i % 5 == 0 else None) for i in range(width - 1)
    ]
    mapping = TableMapping(topic=UPPER, columns=tuple(columns))
    image = {"K": 1, **{f"C{i}": 5 for i in range(width - 1)}}
    values = [create(json.dumps(image)), create(json.dumps({**image, "C1": "x"})), create('{"K":1}')]
    make_log(spark, values).write.parquet(str(tmp_path / "log"))
    decoded = decode(spark.read.parquet(str(tmp_path / "log")), mapping)
    sizes = method_sizes(spark, decoded)
    assert sizes and 0 < max(sizes) < 8000
    rows = decoded_rows(decoded)
    assert [r.outcome for r in rows] == ["upsert", "error_constraint", "error_missing_column"]
    assert rows[1].reason == "C1" and rows[2].reason == ",".join(f"C{i}" for i in range(width - 1))
    assert len(rows[0].row) == width and rows[0].row.c1 == 5


def test_names_that_clash_or_need_quoting(spark):
    names = ["unit price", "a$b", "value", "source", "timestamp", "key", "op", "outcome", "row", "x.y", "`"]
    columns = tuple(Column(n, n) for n in names)
    mapping = TableMapping(topic=UPPER, columns=columns, key_columns=2)
    image = {n: f"<{n}>" for n in names}
    values = [create(json.dumps(image)), json.dumps({"op": "d", "before": {"a$b": "2", "unit price": "1"}})]
    decoded = decode(make_log(spark, values), mapping)
    changes = change_rows(decoded, mapping)
    first, second = sorted(changes.collect(), key=lambda r: r["_change"].offset)
    assert tuple(first)[:-1] == tuple(image.values())
    assert tuple(second)[:2] == ("1", "2") and set(second[2:-1]) == {None}
    latest = latest_per_key(changes, mapping.keys)
    target = spark.createDataFrame([["1", "2", *["old"] * 9]], mapping.replica_schema)
    after = merge.apply_batch(target, latest, mapping).collect()
    assert [tuple(r) for r in after] == [tuple(image.values())]
    assert merge.effective_changes(target, latest, mapping).count() == 2
    assert merge.apply_written(target, latest, mapping).count() == 1


def test_text_and_composite_keys(spark):
    mapping = TableMapping(
        topic=UPPER,
        columns=(Column("K", "k", max_length=4), Column("N", "n", "int"), Column("D", "d", "date_days"), Column("V", "v")),
        key_columns=3,
    )

    def image(k, n, d, **more):
        return json.dumps({"K": k, "N": n, "D": d, **more})

    values = [
        create(image("u-1", 1, 0, V="a")),
        create(image("u-2", 1, 0, V="b")),
        create(image("u-1", 2.7, 0, V="c")),
        create(image("u-1", 1, 0, V="last")),
        create(image(None, 1, 0, V="x")),
        create(image("u-1", 3000000000, 0, V="x")),
        create(image("u-1", 1, "soon", V="x")),
        create(image("longer", 1, 0, V="x")),
        '{"op":"d","before":' + image("u-2", 1, 0) + "}",
        '{"op":"d","before":{"K":"u-1","N":1}}',
    ]
    decoded = decode(make_log(spark, values), mapping)
    assert [r.outcome for r in decoded_rows(decoded)] == [
        *["upsert"] * 4, *["error_bad_key"] * 3, "error_constraint", "delete", "skip_no_before_key",
    ]
    latest = latest_per_key(change_rows(decoded, mapping), mapping.keys)
    got = {(r.k, r.n): (r["_change"].outcome, r.v) for r in latest.collect()}
    assert got == {("u-1", 1): ("upsert", "last"), ("u-1", 2): ("upsert", "c"), ("u-2", 1): ("delete", None)}


def test_mappings_that_cannot_work_are_refused():
    good = Column("A", "a", "bigint")
    for columns, keys in (
        ((Column("A", "a", "double"),), 1),
        ((Column("A", "a", "timestamp_millis"),), 1),
        ((good, Column("B", "a")), 1),
        ((good,), 2),
        ((good, Column("B", "_change")), 1),
    ):
        with pytest.raises(ValueError):
            TableMapping(topic=UPPER, columns=columns, key_columns=keys)


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError):
        decode(make_log(spark, ["{}"]), CUSTOMERS_TO_LOWER, "loose")
