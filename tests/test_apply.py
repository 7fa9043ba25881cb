"""The engine against a plain replay of the log, record by record."""

import json
import random

import pytest

from changeflow import CUSTOMERS_TO_LOWER as LOWER
from changeflow.operators import merge
from changeflow.operators.compact import latest_per_key
from changeflow.operators.decode import change_rows, decode
from pyspark.sql import functions as F
from test_decode import UPPER, make_log

COLUMNS = ("ID", "FIRST_NAME", "LAST_NAME", "EMAIL")


def random_value(rng, keys):
    """A record that is sound more often than not."""
    key = rng.choice([0] * 5 + list(range(keys)))
    image = {
        "ID": rng.choice([key, float(key), str(key)]),
        "FIRST_NAME": rng.choice(["a", "b", None, ""]),
        "LAST_NAME": rng.choice(["x", None]),
        "EMAIL": rng.choice(["m", "n" * 255, "o" * 256 if rng.random() < 0.2 else "p"]),
    }
    shape = rng.random()
    if shape < 0.05:
        return None
    if shape < 0.1:
        return rng.choice(["", "[]", "5", "{", '{"op":"c"', '{"op":null}', '{"op":"t"}'])
    if shape < 0.15:
        del image[rng.choice(COLUMNS)]
    if shape < 0.35:
        return json.dumps({"op": "d", "before": image, "after": None})
    if shape < 0.4:
        return json.dumps({"op": "u", "before": image, "after": None})
    return json.dumps({"op": rng.choice("cur"), "before": None, "after": image})


def replay(rows, values):
    """One record after the other, as a consumer without any batching would do it."""
    state = dict(rows)
    for value in values:
        try:
            root = json.loads(value)
            op = root["op"]
            if op in ("c", "u", "r") and root.get("after") is not None:
                after = root["after"]
                key, *rest = [after[c] for c in COLUMNS]
                if all(v is None or len(v) <= 255 for v in rest):
                    state[int(float(key))] = tuple(rest)
            elif op == "d" and "ID" in (root.get("before") or {}):
                state.pop(int(float(root["before"]["ID"])), None)
        except (TypeError, ValueError, KeyError):
            continue
    return state


def as_state(df):
    return {r[0]: tuple(r[1:]) for r in df.select(*LOWER.targets).collect()}


def make_target(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], LOWER.replica_schema)


def changes_of(log):
    return latest_per_key(change_rows(decode(log, LOWER), LOWER), LOWER.keys)


def apply_all(target, log):
    return merge.apply_batch(target, changes_of(log), LOWER)


def random_case(seed, keys=12, length=120):
    rng = random.Random(seed)
    rows = {k: ("old", None, "mail") for k in range(0, keys, 2)}
    return rows, [random_value(rng, keys) for _ in range(length)]


@pytest.mark.parametrize("seed", range(6))
def test_same_as_sequential_replay(spark, seed):
    rows, values = random_case(seed)
    target = make_target(spark, rows)
    assert as_state(apply_all(target, make_log(spark, values))) == replay(rows, values)


def test_any_split_into_batches_gives_the_same(spark):
    rows, values = random_case(99)
    log = make_log(spark, values).cache()
    want = replay(rows, values)
    for cuts in ([40], [1, 2, 60], [10, 50, 110]):
        target = make_target(spark, rows)
        edges = [0, *cuts, len(values)]
        for a, b in zip(edges, edges[1:]):
            part = log.where((F.col("offset") >= a) & (F.col("offset") < b))
            # A checkpoint per batch would be usual; rows are few here.
            target = make_target(spark, as_state(apply_all(target, part)))
        assert as_state(target) == want, cuts


def test_replay_and_row_order_change_nothing(spark):
    rows, values = random_case(7)
    log = make_log(spark, values)
    target = make_target(spark, rows)
    want = replay(rows, values)
    once = apply_all(target, log)
    assert as_state(apply_all(once, log)) == want
    assert as_state(apply_all(target, log.orderBy(F.rand(1)))) == want
    assert as_state(apply_all(target, log.union(log))) == want


def test_merge_forms_agree(spark):
    rows, values = random_case(11)
    target = make_target(spark, rows)
    changes = changes_of(make_log(spark, values)).cache()
    want = as_state(merge.apply_batch(target, changes, LOWER))
    assert as_state(merge.apply_written(target, changes, LOWER)) == want
    upserts = changes.where("_change.outcome = 'upsert'")
    deletes = changes.where("_change.outcome = 'delete'")
    by_steps = merge.merge_delete(merge.merge_upsert(target, upserts, LOWER), deletes, LOWER)
    assert as_state(by_steps) == want


def test_effective_changes_are_exactly_the_difference(spark):
    rows, values = random_case(13)
    target = make_target(spark, rows)
    changes = changes_of(make_log(spark, values)).cache()
    after = replay(rows, values)
    effective = merge.effective_changes(target, changes, LOWER)
    got = {(r.id, r["_change"].action) for r in effective.collect()}
    want = {(k, "insert") for k in after.keys() - rows.keys()}
    want |= {(k, "delete") for k in rows.keys() - after.keys()}
    want |= {(k, "update") for k in rows.keys() & after.keys() if rows[k] != after[k]}
    assert got == want
    applied = merge.apply_batch(target, effective, LOWER)
    assert as_state(applied) == after
    echo = merge.effective_changes(make_target(spark, after), changes, LOWER)
    assert echo.count() == 0


def test_a_bad_record_does_not_hide_a_good_one(spark):
    good = '{"op":"c","after":{"ID":1,"FIRST_NAME":"a","LAST_NAME":"b","EMAIL":"c"}}'
    bad = '{"op":"u","after":{"ID":1,"FIRST_NAME":"late"}}'
    state = as_state(apply_all(make_target(spark, {}), make_log(spark, [good, bad])))
    assert state == {1: ("a", "b", "c")}


def test_a_changed_key_leaves_the_old_row(spark):
    moved = (
        '{"op":"u","before":{"ID":1},'
        '"after":{"ID":2,"FIRST_NAME":"a","LAST_NAME":null,"EMAIL":null}}'
    )
    state = as_state(apply_all(make_target(spark, {1: ("a", None, None)}), make_log(spark, [moved])))
    assert state == {1: ("a", None, None), 2: ("a", None, None)}


def test_documented_scenario(spark):
    insert = {"ID": 100, "FIRST_NAME": "Test", "LAST_NAME": "User", "EMAIL": "test@example.com"}
    log = make_log(spark, [json.dumps({"op": "c", "before": None, "after": insert})], UPPER)
    state = as_state(apply_all(make_target(spark, {}), log))
    assert state[100] == ("Test", "User", "test@example.com")


def test_a_key_with_a_third_of_the_log_is_combined_before_the_shuffle(spark, tmp_path):
    """No task receives the rows of the hot key, only one row for it from each sender."""
    n, tasks = 60000, 8
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    rows = spark.range(0, n, 1, tasks).select(
        key.alias("key"), F.col("id").alias("offset"), F.lit(0).alias("partition"), "id"
    )
    rows.write.parquet(str(tmp_path / "rows"))
    latest = latest_per_key(spark.read.parquet(str(tmp_path / "rows")), "key", ("offset", "partition"))
    result = {r.key: r.id for r in latest.where("key = 0 OR key = 1").collect()}
    assert result == {0: n - 3, 1: 1}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")
    assert "Window" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_target_is_not_moved_to_look_up_a_few_rows(spark, tmp_path):
    rows = spark.range(100_000).selectExpr(
        "id", "uuid() AS first_name", "uuid() AS last_name", "uuid() AS email"
    )
    rows.write.parquet(str(tmp_path / "replica_rows"))
    target = spark.read.parquet(str(tmp_path / "replica_rows"))
    value = '{"op":"u","after":{"ID":%d,"FIRST_NAME":"n","LAST_NAME":"n","EMAIL":"n"}}'
    changes_of(make_log(spark, [value % i for i in (1, 2, 300_000)])).write.parquet(str(tmp_path / "changes"))
    changes = spark.read.parquet(str(tmp_path / "changes"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 10))
    try:
        effective = merge.effective_changes(target, changes, LOWER)
        assert sorted((r.id, r["_change"].action) for r in effective.collect()) == [
            (1, "update"), (2, "update"), (300_000, "insert"),
        ]
        plan = plan_of(effective).split("Initial Plan")[0]
        # The scan of the target meets the broadcast keys before anything is moved.
        lines = plan.splitlines()
        semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
        scan = next(i for i, line in enumerate(lines) if i > semi and "Scan parquet" in line)
        assert "BroadcastHashJoin" in lines[semi]
        assert not any("Exchange" in line for line in lines[semi:scan])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
