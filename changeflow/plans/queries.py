"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.coerce import coerce_key
from changeflow.model import CUSTOMERS_TO_LOWER as TO_LOWER
from changeflow.model import CUSTOMERS_TO_UPPER as TO_UPPER
from changeflow.model import Column, TableMapping
from changeflow.operators import merge, quality, route, sync
from changeflow.operators.capture import chunk_events, diff_events, end_marks, snapshot_events, with_position
from changeflow.operators.compact import latest_per_key
from changeflow.operators.decode import dead_letters as dead_letters_of
from changeflow.model import CHANGE, ERROR_TORN, ident
from changeflow.operators.decode import change_rows, decode, op_name
from changeflow.operators.merge import OUTCOME, named
from changeflow.plans.change_log import ID_STEP, PARTITIONS
from changeflow.plans.change_log import change_log as derive_log
from changeflow.sources.log import read_log, stream_log, stream_topics, write_log
from changeflow.sources.positions import at_time, index_log, latest, read_between
from changeflow.sources.tables import in_range, key_ranges, lookup, scan_replica
from changeflow.sources.workspace import workspace, written
from changeflow.streaming.apply import apply_stream, latest_stream, read_latest
from changeflow.streaming.feeds import apply_feeds, create_feeds, read_parked, registry, replay_parked, replica_path
from changeflow.streaming.replica import (
    clean_replica,
    create_replica,
    create_store,
    fold_replica,
    read_changes,
    read_counters,
    read_dead_letters,
    read_replica,
    slim,
    stage_changes,
    write_batch,
)
from changeflow.streaming.sync import create_sync, read_side, sync_stream

# Fixed time stamp of captured events, so that a capture can be compared as text.
CAPTURED_AT = 1704067200000
# Share of records that may be dead letters before a feed counts as unhealthy.
MAX_DEAD_RATE = 0.25
# Where a snapshot stands that was taken before the first live change.
BEFORE_ALL = -1
# Parts of a key space and of a log, files of a base, batches until changes are folded.
CHUNKS, PARTS, BASE_FILES, FOLD_AFTER = 4, 6, 8, 2
# How much of a log one micro-batch takes at most.
BATCH_BYTES = 64 * 2**30

CUSTOMER_TABLE = TableMapping(
    topic=TO_UPPER.topic,
    columns=(
        Column("c_custkey", "ID", "bigint"),
        Column("c_mktsegment", "FIRST_NAME"),
        Column("c_name", "LAST_NAME"),
    ),
)
ORDERS_FEED = TableMapping(
    topic="postgres.public.orders",
    columns=(
        Column("O_ORDERKEY", "o_orderkey", "bigint"),
        Column("O_CUSTKEY", "o_custkey", "bigint"),
        Column("O_ORDERSTATUS", "o_orderstatus"),
        Column("O_TOTALPRICE", "o_totalprice", "double"),
        Column("O_ORDERDATE", "o_orderdate", "timestamp_millis"),
        Column("O_DAY", "o_day", "date_days"),
    ),
)
NATION_FEED = TableMapping(
    topic="oracle.DBZUSER.NATION",
    columns=(Column("N_NATIONKEY", "n_nationkey", "bigint"), Column("N_NAME", "n_name")),
)
REGION_FEED = TableMapping(
    topic="oracle.SYS.REGION",
    columns=(Column("R_REGIONKEY", "r_regionkey", "bigint"), Column("R_NAME", "r_name")),
)
DOCUMENTS_FEED = TableMapping(
    topic="postgres.public.documents",
    columns=(
        Column("doc_id", "doc_id", "bigint"),
        Column("text", "text"),
        Column("lang", "lang"),
        Column("source", "source"),
        Column("n_chars", "n_chars", "bigint"),
    ),
)
EVENTS_FEED = TableMapping(
    topic="postgres.public.events",
    columns=(
        Column("event id", "event_id", "bigint"),
        Column("offset", "offset", "bigint"),
        Column("outcome", "outcome"),
        Column("value", "value", "double"),
        Column("a $.b", "a $.b"),
    ),
)
TURNS_FEED = TableMapping(
    topic="postgres.public.conversations",
    columns=(
        Column("conv_id", "conv_id", "bigint"),
        Column("turn", "turn", "bigint"),
        Column("role", "role"),
        Column("text", "text"),
    ),
    key_columns=2,
)
USERS_FEED = TableMapping(
    topic="postgres.public.users",
    columns=(
        Column("name", "user_name", "string", max_length=64),
        Column("event_id", "event_id", "bigint"),
        Column("event_type", "event_type"),
    ),
)
# A prefix may have dots of its own.
DOTTED_FEED = replace(REGION_FEED, topic="oracle.site-2.west.GEO.REGION")
# A topic that is no feed of a table.
HISTORY_TOPIC = "ddl-journal.upper"
# Share of the lines that ``torn_lines`` cuts, and after how many characters.
TORN_EVERY, TORN_AT = 10, 25
# A text of so many two-byte characters fits 255 characters and not 255 bytes.
WIDE = 200
# Share of the events that are sent again with a change.
CHANGED_EVERY = 7


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return derive_log(_table(spark, sf, "events"))


def _customers(spark: SparkSession, sf: str, mapping: TableMapping) -> DataFrame:
    """The replica before any change, the whole customer table on either side."""
    names = mapping.targets
    return _table(spark, sf, "customer").select(
        F.col("c_custkey").alias(names[0]),
        F.col("c_mktsegment").alias(names[1]),
        F.col("c_name").alias(names[2]),
        F.lit(None).cast("string").alias(names[3]),
    )


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds, without the row columns that the two sides name alike."""
    log = _log(spark, sf)
    upper, lower = decode(log, TO_LOWER), decode(log, TO_UPPER)
    return upper.drop("row").unionByName(lower.drop("row"))


def _latest(spark: SparkSession, sf: str, mapping: TableMapping) -> DataFrame:
    return _latest_of(_log(spark, sf), mapping)


def _latest_of(log: DataFrame, mapping: TableMapping) -> DataFrame:
    return latest_per_key(change_rows(decode(log, mapping), mapping), mapping.keys)


def _after(spark: SparkSession, sf: str, mapping: TableMapping) -> DataFrame:
    """The replica after its feed was applied."""
    return merge.apply_batch(_customers(spark, sf, mapping), _latest(spark, sf, mapping), mapping)


def _capture(spark: SparkSession, sf: str) -> DataFrame:
    """Events that lead from the customers to the state after the feed."""
    old = _customers(spark, sf, TO_LOWER)
    return diff_events(old, _after(spark, sf, TO_LOWER), TO_LOWER, CAPTURED_AT)


def _all_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """A log with more tables than the customers, and a topic that is no feed."""
    orders = snapshot_events(_orders(spark, sf), ORDERS_FEED, CAPTURED_AT)
    nation = snapshot_events(_table(spark, sf, "nation"), NATION_FEED, CAPTURED_AT)
    region = snapshot_events(_table(spark, sf, "region"), REGION_FEED, CAPTURED_AT)
    dotted = snapshot_events(_table(spark, sf, "region"), DOTTED_FEED, CAPTURED_AT)
    history = region.withColumn("topic", F.lit(HISTORY_TOPIC))
    log = _log(spark, sf).select("topic", "key", "value")
    for feed in (orders, nation, region, dotted, history):
        log = log.unionByName(feed.select("topic", "key", "value"))
    return log


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate").alias("o_day")
    return _table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", day
    )


# --- sources ------------------------------------------------------------------------


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log written as files and replayed from the beginning."""
    path = workspace(spark, "log")
    write_log(_log(spark, sf), path)
    return read_log(spark, path).select(
        "topic",
        "partition",
        "offset",
        F.unix_millis("timestamp").alias("timestamp_ms"),
        "key",
        "value",
    )


def include_list(spark: SparkSession, sf: str) -> DataFrame:
    tables = ["DBZUSER.CUSTOMERS", "public.customers", "GEO.REGION"]
    kept = route.include_tables(_all_feeds(spark, sf), ["DBZUSER", "public", "GEO"], tables)
    return kept.select("topic", "key", "value")


def topic_route(spark: SparkSession, sf: str) -> DataFrame:
    routed = route.route_topics(_all_feeds(spark, sf).select("topic"))
    return routed.groupBy("topic", "origin", "schema_name", "table_name", "is_feed").agg(
        F.count(F.lit(1)).alias("records")
    )


def snapshot_of_customers(spark: SparkSession, sf: str) -> DataFrame:
    events = snapshot_events(_customers(spark, sf, TO_LOWER), TO_LOWER, CAPTURED_AT)
    return events.select("topic", "key", "value")


def capture_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _capture(spark, sf).select("topic", "key", "value")


def replica_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_replica(spark, f"{sf}/customer.parquet", CUSTOMER_TABLE)


def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A row written on one side is looked up on the other: 100 and 200."""
    lower = lookup(_customers(spark, sf, TO_LOWER), "id", 100)
    upper = lookup(_customers(spark, sf, TO_UPPER), "ID", 200)
    found = lower.withColumn("side", F.lit("lower"))
    return found.union(upper.withColumn("side", F.lit("upper")))


# --- decoding -----------------------------------------------------------------------


def decode_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return _decoded(spark, sf).select(
        "topic",
        "offset",
        "message_key",
        "op",
        "ts_ms",
        F.unix_micros("event_time").alias("event_micros"),
        "source",
        "has_before",
        "has_after",
    )


def classify_events(spark: SparkSession, sf: str) -> DataFrame:
    return _decoded(spark, sf).select("topic", "offset", "op", "outcome", "reason")


def project_rows(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)

    def rows(mapping: TableMapping) -> DataFrame:
        place = [F.col(f"{CHANGE}.{c}") for c in ("topic", "offset")]
        return change_rows(decode(log, mapping), mapping).select(*place, *named(mapping.targets))

    return rows(TO_LOWER).union(rows(TO_UPPER))


def coerce_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Key texts of many shapes made from every event."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    text = (
        F.when(kind == "signup", number)
        .when(kind == "view", F.concat(number, F.lit(".0")))
        .when(kind == "click", F.concat(number, F.lit(".7")))
        .when(kind == "purchase", F.concat(F.lit("key "), number))
        .when(F.col("value") < 10, "true")
        .when(F.col("value") < 20, F.concat(F.lit("99999999999999"), number, F.lit("00000")))
        .when(F.col("value") < 30, "1e30")
    )
    keyed = _table(spark, sf, "events").select("event_id", text.alias("key_text"))
    return keyed.select(
        "*",
        F.expr(coerce_key("key_text")).alias("reference_key"),
        F.expr(coerce_key("key_text", "strict")).alias("strict_key"),
    )


def typed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as feed and back: doubles, epoch milliseconds, epoch days.

    The same orders come once more with a customer number that has a fraction; those are refused.
    """
    events = snapshot_events(_orders(spark, sf), ORDERS_FEED, CAPTURED_AT)
    log = with_position(events, "row_key.O_ORDERKEY")
    cut = F.regexp_replace("value", '("O_CUSTKEY":[0-9]+)', "$1.5")
    log = log.unionByName(log.withColumn("value", cut))
    decoded = decode(log, ORDERS_FEED).select("outcome", "reason", "key", "row.*")
    # As the orders table has it: a time stamp without zone; the day in its usual spelling.
    return decoded.select(
        "outcome",
        "reason",
        F.get_json_object("key", "$.O_ORDERKEY").cast("bigint").alias("key"),
        *ORDERS_FEED.targets,
    ).withColumns(
        {
            "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
            "o_day": F.col("o_day").cast("string"),
        }
    )


def _mirrored(spark: SparkSession, table: DataFrame, mapping: TableMapping) -> DataFrame:
    """A table through snapshot, log, decoding, compaction and the replica folders."""
    base = workspace(spark, "mirror")
    rows = table.select(*[F.col(ident(c.target)).alias(c.target) for c in mapping.columns])
    write_log(with_position(snapshot_events(rows, mapping, CAPTURED_AT), F.lit(0)), f"{base}/log")
    nothing = spark.createDataFrame([], mapping.replica_schema)
    create_replica(nothing, f"{base}/replica", mapping)
    log = stream_log(spark, f"{base}/log", mapping.topic, max_bytes=BATCH_BYTES)
    _run(apply_stream(log, mapping, f"{base}/replica", f"{base}/checkpoint"))
    return read_replica(spark, f"{base}/replica", mapping)


def mirror_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All columns, one of them called like a field of the envelope."""
    return _mirrored(spark, _table(spark, sf, "documents"), DOCUMENTS_FEED)


def mirror_events(spark: SparkSession, sf: str) -> DataFrame:
    """A column called like one of the log, and others called like those that decoding adds."""
    events = _table(spark, sf, "events").selectExpr(
        "event_id", "user_id AS offset", "event_type AS outcome", "value", "props AS `a $.b`"
    )
    return _mirrored(spark, events, EVENTS_FEED)


def mirror_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """A key of two columns."""
    return _mirrored(spark, _table(spark, sf, "conversations"), TURNS_FEED)


def text_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of every user under a text key; ``error`` events delete the user."""
    user = "concat('u', user_id)"
    gone = "event_type = 'error'"
    image = f"struct({user} AS name, event_id, event_type)"
    value = f"""to_json(struct(
        IF({gone}, 'd', 'u') AS op, IF({gone}, {image}, NULL) AS before,
        IF({gone}, NULL, {image}) AS after), map('ignoreNullFields', 'false'))"""
    log = _table(spark, sf, "events").selectExpr(
        f"'{USERS_FEED.topic}' AS topic",
        "0 AS partition",
        "event_id AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        f"to_json(struct({user} AS name)) AS key",
        f"{value} AS value",
    )
    latest = _latest_of(log, USERS_FEED)
    return latest.select(F.col(OUTCOME).alias("outcome"), *named(USERS_FEED.targets))


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    dead = dead_letters_of(decode(log, TO_LOWER)).unionByName(
        dead_letters_of(decode(log, TO_UPPER))
    )
    return dead.select("topic", "partition", "offset", "key", "value", "op", "outcome", "reason")


def op_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _decoded(spark, sf).select(
        "topic", "offset", "op", op_name(F.col("op")).alias("operation")
    )


def constraint_check(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against limits in characters and bytes, conversations against a unique key."""
    texts = TableMapping(
        topic="",
        columns=(
            Column("doc_id", "doc_id", "bigint"),
            Column("source", "source", max_length=255),
            Column("text", "text", max_length=255),
        ),
    )
    turns = TableMapping(
        topic="",
        columns=(
            Column("conv_id", "conv_id", "bigint"),
            Column("role", "role", max_length=255),
            Column("text", "text", max_length=255),
        ),
    )
    by_unit = {
        "documents, characters": texts,
        "documents, bytes": replace(texts, length_unit="bytes"),
    }
    documents = quality.constraint_violations(_table(spark, sf, "documents"), by_unit)
    return documents.unionByName(
        quality.constraint_violations(_table(spark, sf, "conversations"), {"conversations": turns})
    )


# --- merging ------------------------------------------------------------------------


def both_latest(spark: SparkSession, sf: str) -> DataFrame:
    def rows(mapping: TableMapping) -> DataFrame:
        change = [F.col(f"{CHANGE}.{c}") for c in ("topic", "offset", "outcome")]
        return _latest(spark, sf, mapping).select(*change, *named(mapping.targets))

    return rows(TO_LOWER).union(rows(TO_UPPER))


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    latest = written(_latest(spark, sf, TO_LOWER), workspace(spark, "changes"))
    upserts = latest.where(F.col(OUTCOME) == "upsert")
    return merge.merge_upsert(_customers(spark, sf, TO_LOWER), upserts, TO_LOWER)


def merge_delete(spark: SparkSession, sf: str) -> DataFrame:
    deletes = _latest(spark, sf, TO_LOWER).where(F.col(OUTCOME) == "delete")
    return merge.merge_delete(_customers(spark, sf, TO_LOWER), deletes, TO_LOWER)


def _with_action(changes: DataFrame) -> DataFrame:
    return changes.select(F.col(f"{CHANGE}.action").alias("action"), *named(TO_LOWER.targets))


def effective_changes(spark: SparkSession, sf: str) -> DataFrame:
    latest = written(_latest(spark, sf, TO_LOWER), workspace(spark, "changes"))
    return _with_action(merge.effective_changes(_customers(spark, sf, TO_LOWER), latest, TO_LOWER))


def effective_echo(spark: SparkSession, sf: str) -> DataFrame:
    """The feed is applied, then sent again with a real change in a share of its records."""
    base = workspace(spark, "echo")
    latest = written(_latest(spark, sf, TO_LOWER), f"{base}/latest")
    held = merge.apply_written(_customers(spark, sf, TO_LOWER), latest, TO_LOWER)
    changed = (F.col("id") % CHANGED_EVERY == 0) & (F.col(OUTCOME) == "upsert")
    again = latest.withColumn(
        "email", F.when(changed, F.concat("email", F.lit(".new"))).otherwise(F.col("email"))
    )
    return _with_action(merge.effective_changes(held, written(again, f"{base}/again"), TO_LOWER))


def apply_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: log in, new state of the replica out, in one pass over both."""
    return _after(spark, sf, TO_LOWER)


def apply_staged(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship for a batch that is small beside its target."""
    changes = written(_latest(spark, sf, TO_LOWER), workspace(spark, "changes"))
    return merge.apply_written(_customers(spark, sf, TO_LOWER), changes, TO_LOWER)


def _sink(spark: SparkSession, sf: str, mapping: TableMapping) -> DataFrame:
    """Through the replica folders, the way a stream writes them."""
    path = workspace(spark, "replica")
    create_replica(_customers(spark, sf, mapping), path, mapping)
    write_batch(slim(decode(_log(spark, sf), mapping)), path, mapping, 0)
    return read_replica(spark, path, mapping)


def apply_to_lower(spark: SparkSession, sf: str) -> DataFrame:
    return _sink(spark, sf, TO_LOWER)


def apply_to_upper(spark: SparkSession, sf: str) -> DataFrame:
    return _sink(spark, sf, TO_UPPER)


def publish_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Captured changes, published, read back and applied to the old state."""
    path = workspace(spark, "published")
    write_log(with_position(_capture(spark, sf), "row_key.ID"), path)
    latest = _latest_of(read_log(spark, path), TO_LOWER)
    return merge.apply_batch(_customers(spark, sf, TO_LOWER), latest, TO_LOWER)


def _decided(spark: SparkSession, *logs: DataFrame) -> DataFrame:
    """What both sides are to have after logs that come one after the other."""
    base, last = workspace(spark, "sync"), None
    for i, log in enumerate(logs):
        last = written(sync.last_of_both(log, TO_LOWER, TO_UPPER, last), f"{base}/last-{i}")
    return written(sync.decide(last, TO_LOWER, TO_UPPER), f"{base}/decided")


def _both_sides(spark: SparkSession, sf: str, decided: DataFrame) -> DataFrame:
    """The customers of either side with the decided rows."""
    sides = []
    for origin, mapping in ((sync.LOWER, TO_LOWER), (sync.UPPER, TO_UPPER)):
        settled = sync.settled_changes(decided, origin, TO_LOWER, mapping)
        rows = merge.apply_written(_customers(spark, sf, mapping), settled, mapping)
        sides.append(rows.withColumn("side", F.lit(origin)))
    return sides[0].union(sides[1])


def bidirectional_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Afterwards both sides hold the winners."""
    return _both_sides(spark, sf, _decided(spark, _log(spark, sf)))


def sync_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same when the whole feed of one side comes before any of the other."""
    log = _log(spark, sf)
    upper_first = [log.where(F.col("topic") == m.topic) for m in (TO_LOWER, TO_UPPER)]
    return _both_sides(spark, sf, _decided(spark, *upper_first))


def sync_writes(spark: SparkSession, sf: str) -> DataFrame:
    """What is sent to each side."""
    decided = _decided(spark, _log(spark, sf))
    lower, upper = (_customers(spark, sf, m) for m in (TO_LOWER, TO_UPPER))
    writes = sync.sync_changes(lower, upper, decided, TO_LOWER, TO_UPPER)
    action = F.col(f"{CHANGE}.action").alias("action")
    to_lower = writes.to_lower.select(F.lit("lower").alias("side"), action, *named(TO_LOWER.targets))
    to_upper = writes.to_upper.select(F.lit("upper").alias("side"), action, *named(TO_UPPER.targets))
    return to_lower.union(to_upper)


def sync_unequal_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Names that only the lower side can store: it keeps them, the upper side gets none."""
    wide = F.lit("é" * WIDE)
    is_wide = (F.col("topic") == TO_UPPER.topic) & (F.col("offset") % 3 == 0)
    named_wide = F.regexp_replace("value", '"last_name":(null|"[^"]*")', F.concat(F.lit('"last_name":"'), wide, F.lit('"')))
    log = _log(spark, sf)
    log = log.withColumn("value", F.when(is_wide, named_wide).otherwise(F.col("value")))
    decided = _decided(spark, log)
    sides = _both_sides(spark, sf, decided).withColumn("outcome", F.lit("held"))
    refused = sync.refused_changes(decided, TO_LOWER).select(
        F.col("key").cast("bigint").alias("id"),
        F.get_json_object("row", "$.first_name").alias("first_name"),
        F.get_json_object("row", "$.last_name").alias("last_name"),
        F.get_json_object("row", "$.email").alias("email"),
        "side",
        "outcome",
    )
    return sides.unionByName(refused)


# --- verification -------------------------------------------------------------------


def replica_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.replica_counts(
        {
            "customers": _customers(spark, sf, TO_LOWER),
            "lower": _after(spark, sf, TO_LOWER),
            "upper": _after(spark, sf, TO_UPPER),
        }
    )


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reconcile(_after(spark, sf, TO_LOWER), _after(spark, sf, TO_UPPER), TO_LOWER)


def outcome_stats(spark: SparkSession, sf: str) -> DataFrame:
    return quality.outcome_stats(_decoded(spark, sf))


def sync_health(spark: SparkSession, sf: str) -> DataFrame:
    sides = {
        m.topic: written(_after(spark, sf, m), workspace(spark, "replica"))
        for m in (TO_LOWER, TO_UPPER)
    }
    return quality.sync_health(
        sides[TO_LOWER.topic], sides[TO_UPPER.topic], _decoded(spark, sf), MAX_DEAD_RATE
    )


# --- streaming ----------------------------------------------------------------------


def _run(query) -> None:
    query.awaitTermination()


def torn_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A log of all events with lines that a writer left unfinished, in batch and as a stream."""
    base = workspace(spark, "torn")
    fields = "partition, offset, date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSXXX\") AS timestamp, key, value"
    line = f"to_json(struct({fields}), map('ignoreNullFields', 'false'))"
    cut = f"IF(offset % {TORN_EVERY} = 3, left({line}, {TORN_AT}), {line})"
    lines = _log(spark, sf).selectExpr("topic", f"{cut} AS line")
    lines.write.partitionBy("topic").text(f"{base}/log")
    both = None
    for mapping in (TO_LOWER, TO_UPPER):
        path = f"{base}/{mapping.topic}"
        create_replica(spark.createDataFrame([], mapping.replica_schema), path, mapping)
        log = stream_log(spark, f"{base}/log", mapping.topic, max_bytes=BATCH_BYTES)
        _run(apply_stream(log, mapping, path, f"{path}-checkpoint"))
        in_batch = dead_letters_of(decode(read_log(spark, f"{base}/log"), mapping))
        for read, letters in (("batch", in_batch), ("stream", read_dead_letters(spark, path))):
            torn = F.when(F.col("outcome") == ERROR_TORN, F.col("value")).alias("line")
            found = letters.select(F.lit(read).alias("read"), "topic", "offset", "outcome", torn)
            both = found if both is None else both.unionByName(found)
    return both


def stream_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds followed by one stream, in parts, until both sides agree."""
    base = workspace(spark, "sync-stream")
    lower, upper = (_customers(spark, sf, m) for m in (TO_LOWER, TO_UPPER))
    create_sync(lower, upper, f"{base}/sides", TO_LOWER, TO_UPPER)
    log = _log(spark, sf)
    for part in ("offset % 2 = 1", "offset % 2 = 0"):
        write_log(log.where(part), f"{base}/log", mode="append")
        feeds = [
            stream_log(spark, f"{base}/log", m.topic, max_bytes=BATCH_BYTES) for m in (TO_LOWER, TO_UPPER)
        ]
        both = feeds[0].unionByName(feeds[1])
        _run(sync_stream(both, TO_LOWER, TO_UPPER, f"{base}/sides", f"{base}/checkpoint"))
    sides = [
        read_side(spark, f"{base}/sides", side, mapping).withColumn("side", F.lit(side))
        for side, mapping in ((sync.LOWER, TO_LOWER), (sync.UPPER, TO_UPPER))
    ]
    return sides[0].union(sides[1])


def stream_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every batch, summed up from what the batches stored."""
    return read_counters(spark, _follow(spark, sf, TO_LOWER))


def compact_then_follow(spark: SparkSession, sf: str) -> DataFrame:
    """The later half of the log first, folded; then the earlier half, which must not win."""
    base = workspace(spark, "fold")
    create_replica(_customers(spark, sf, TO_LOWER), f"{base}/replica", TO_LOWER)
    log = _log(spark, sf)
    middle = _table(spark, sf, "events").agg(F.floor(F.avg("event_id"))).first()[0] or 0
    for part in (F.col("offset") > middle, F.col("offset") <= middle):
        write_log(log.where(part), f"{base}/log", mode="append")
        feed = stream_log(spark, f"{base}/log", TO_LOWER.topic, max_bytes=BATCH_BYTES)
        _run(apply_stream(feed, TO_LOWER, f"{base}/replica", f"{base}/checkpoint"))
        fold_replica(spark, f"{base}/replica", TO_LOWER)
    return read_replica(spark, f"{base}/replica", TO_LOWER)


def _follow(spark: SparkSession, sf: str, mapping: TableMapping) -> str:
    """A replica to which the log was applied by a stream; returns its folder."""
    base = workspace(spark, "stream")
    write_log(_log(spark, sf), f"{base}/log")
    create_replica(_customers(spark, sf, mapping), f"{base}/replica", mapping)
    log = stream_log(spark, f"{base}/log", mapping.topic, max_bytes=BATCH_BYTES)
    _run(apply_stream(log, mapping, f"{base}/replica", f"{base}/checkpoint"))
    return f"{base}/replica"


def stream_apply(spark: SparkSession, sf: str) -> DataFrame:
    return read_replica(spark, _follow(spark, sf, TO_LOWER), TO_LOWER)


def stream_apply_reverse(spark: SparkSession, sf: str) -> DataFrame:
    return read_replica(spark, _follow(spark, sf, TO_UPPER), TO_UPPER)


def stream_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    dead = read_dead_letters(spark, _follow(spark, sf, TO_LOWER))
    return dead.select("topic", "partition", "offset", "key", "value", "op", "outcome", "reason")


def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    base = workspace(spark, "stream")
    write_log(_log(spark, sf), f"{base}/log")
    log = stream_log(spark, f"{base}/log", TO_LOWER.topic, max_bytes=BATCH_BYTES)
    create_store(spark, f"{base}/latest", TO_LOWER)
    _run(latest_stream(log, TO_LOWER, f"{base}/latest", f"{base}/checkpoint"))
    latest = read_latest(spark, f"{base}/latest", TO_LOWER)
    change = [F.col(f"{CHANGE}.{c}") for c in ("offset", "outcome")]
    return latest.select(*change, *named(TO_LOWER.targets))


def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """The log arrives in three parts, by operation time; each run resumes at the last one.

    Which batch a change was stored with shows that no run read a part again.
    """
    base = workspace(spark, "stream")
    create_replica(_customers(spark, sf, TO_LOWER), f"{base}/replica", TO_LOWER)
    events = _table(spark, sf, "events")
    second, third = [
        F.to_timestamp_ntz(F.lit(start)) for start in ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
    ]
    ts = F.col("ts").cast("timestamp_ntz")
    parts = [ts < second, (ts >= second) & (ts < third), (ts >= third) | ts.isNull()]
    for part in parts:
        write_log(derive_log(events.where(part)), f"{base}/log", mode="append")
        log = stream_log(spark, f"{base}/log", TO_LOWER.topic, max_bytes=BATCH_BYTES)
        _run(apply_stream(log, TO_LOWER, f"{base}/replica", f"{base}/checkpoint"))
    changes = read_changes(spark, f"{base}/replica", TO_LOWER)
    place = [F.col(f"{CHANGE}.{c}") for c in ("batch_id", "offset", "outcome")]
    return changes.select(*place, *named(TO_LOWER.targets))


def bootstrap_then_stream(spark: SparkSession, sf: str) -> DataFrame:
    """An empty replica gets the snapshot first and then follows the live changes."""
    base = workspace(spark, "stream")
    customers = _customers(spark, sf, TO_LOWER)
    create_replica(spark.createDataFrame([], TO_LOWER.replica_schema), f"{base}/replica", TO_LOWER)
    events = snapshot_events(customers, TO_LOWER, CAPTURED_AT)
    snapshot = with_position(events, F.lit(BEFORE_ALL))
    for records in (snapshot, _log(spark, sf)):
        write_log(records, f"{base}/log", mode="append")
        log = stream_log(spark, f"{base}/log", TO_LOWER.topic, max_bytes=BATCH_BYTES)
        _run(apply_stream(log, TO_LOWER, f"{base}/replica", f"{base}/checkpoint"))
    return read_replica(spark, f"{base}/replica", TO_LOWER)


def snapshot_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot in chunks of the key, each read at another time while the table changes.

    The table is the customers with its feed applied so far; each chunk is read between two
    marks that have changes between them, before and after the reading.
    """
    base = workspace(spark, "chunks")
    log = _log(spark, sf).where(F.col("topic") == TO_LOWER.topic)
    live = written(change_rows(decode(log, TO_LOWER), TO_LOWER), f"{base}/live")
    customers = _customers(spark, sf, TO_LOWER)
    offset = F.col(f"{CHANGE}.offset")
    create_replica(spark.createDataFrame([], TO_LOWER.replica_schema), f"{base}/replica", TO_LOWER)
    last = max(end_marks(log).values(), default=0)
    times = [last * i // (2 * CHUNKS + 1) for i in range(1, 2 * CHUNKS + 2)]
    seen = -1
    for i, chunk in enumerate(key_ranges(customers, TO_LOWER, CHUNKS)):
        low, read_at, high = times[2 * i : 2 * i + 3]
        now = latest_per_key(live.where(offset <= read_at), TO_LOWER.keys)
        rows = merge.apply_batch(customers, now, TO_LOWER).where(in_range(TO_LOWER, chunk))
        marks = [end_marks(log.where(F.col("offset") <= mark)) for mark in (low, high)]
        # The partition that has the changes of a key is the log's own rule.
        partition = F.pmod(F.floor(F.col("id") / ID_STEP), F.lit(PARTITIONS))
        events = chunk_events(rows, live, TO_LOWER, *marks, CAPTURED_AT, partition)
        # The records of a chunk come late or early among those of the log.
        upto = high if i % 2 else low
        write_log(log.where(F.col("offset").between(seen + 1, upto)), f"{base}/log", mode="append")
        write_log(events, f"{base}/log", mode="append")
        seen = upto
    write_log(log.where(F.col("offset") > seen), f"{base}/log", mode="append")
    feed = stream_log(spark, f"{base}/log", TO_LOWER.topic, max_bytes=BATCH_BYTES)
    _run(apply_stream(feed, TO_LOWER, f"{base}/replica", f"{base}/checkpoint"))
    return read_replica(spark, f"{base}/replica", TO_LOWER)


def repeated_batch(spark: SparkSession, sf: str) -> DataFrame:
    """What readers see while a batch dies between its writes, is repeated and dies once more."""
    path = workspace(spark, "repeated")
    create_replica(_customers(spark, sf, TO_LOWER), path, TO_LOWER)
    log = _log(spark, sf)
    middle = _table(spark, sf, "events").agg(F.floor(F.avg("event_id"))).first()[0] or 0
    halves = [slim(decode(log.where(p), TO_LOWER)) for p in (F.col("offset") <= middle, F.col("offset") > middle)]
    seen = None

    def look(name: str) -> None:
        nonlocal seen
        # A reader keeps the files of its snapshot, so all of them can be read at the end.
        rows = read_replica(spark, path, TO_LOWER).withColumn("seen", F.lit(name))
        seen = rows if seen is None else seen.unionByName(rows)

    write_batch(halves[0], path, TO_LOWER, 0)
    stage_changes(halves[1], path, TO_LOWER, 1)
    look("after the first died")
    write_batch(halves[1], path, TO_LOWER, 1)
    stage_changes(halves[1], path, TO_LOWER, 1)
    look("after the repetition")
    fold_replica(spark, path, TO_LOWER)
    clean_replica(spark, path, TO_LOWER)
    look("after folding")
    return seen


def fold_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The log in parts, folded after each, into a base of several files."""
    path = workspace(spark, "parts")
    create_replica(_customers(spark, sf, TO_LOWER), path, TO_LOWER, files=BASE_FILES)
    log = _log(spark, sf)
    for i in range(CHUNKS):
        part = log.where(F.col("offset") % CHUNKS == i)
        write_batch(slim(decode(part, TO_LOWER)), path, TO_LOWER, i)
        fold_replica(spark, path, TO_LOWER, files=BASE_FILES)
    return read_replica(spark, path, TO_LOWER)


def sync_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds in many batches, with state and sides folded meanwhile."""
    base = workspace(spark, "sync-batches")
    lower, upper = (_customers(spark, sf, m) for m in (TO_LOWER, TO_UPPER))
    create_sync(lower, upper, f"{base}/sides", TO_LOWER, TO_UPPER)
    log = _log(spark, sf)
    for i in range(PARTS):
        write_log(log.where(F.col("offset") % PARTS == i).coalesce(1), f"{base}/log", mode="append")
    feeds = [stream_log(spark, f"{base}/log", m.topic, max_files=2) for m in (TO_LOWER, TO_UPPER)]
    both = feeds[0].unionByName(feeds[1])
    _run(sync_stream(both, TO_LOWER, TO_UPPER, f"{base}/sides", f"{base}/checkpoint", fold_every=FOLD_AFTER))
    sides = [
        read_side(spark, f"{base}/sides", side, mapping).withColumn("side", F.lit(side))
        for side, mapping in ((sync.LOWER, TO_LOWER), (sync.UPPER, TO_UPPER))
    ]
    return sides[0].union(sides[1])


def many_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Four tables from one stream, chosen by a pattern; one of them cannot be written at first."""
    base = workspace(spark, "feeds")
    feeds = registry([TO_LOWER, TO_UPPER, ORDERS_FEED, NATION_FEED])
    tables = {
        TO_LOWER.topic: _customers(spark, sf, TO_LOWER),
        TO_UPPER.topic: _customers(spark, sf, TO_UPPER),
        ORDERS_FEED.topic: spark.createDataFrame([], ORDERS_FEED.replica_schema),
    }
    healthy = {t: m for t, m in feeds.items() if t != NATION_FEED.topic}
    create_feeds(tables, f"{base}/feeds", healthy)
    orders = snapshot_events(_orders(spark, sf), ORDERS_FEED, CAPTURED_AT)
    nation = snapshot_events(_table(spark, sf, "nation"), NATION_FEED, CAPTURED_AT)
    region = snapshot_events(_table(spark, sf, "region"), REGION_FEED, CAPTURED_AT)
    log = _log(spark, sf)
    for events in (orders, nation, region):
        log = log.unionByName(with_position(events, F.lit(0)))
    write_log(log, f"{base}/log")
    # The nations have no replica yet, so their records cannot be written.
    blocked = replica_path(f"{base}/feeds", NATION_FEED.topic)
    stream = stream_topics(spark, f"{base}/log", r"(oracle|postgres)\..*", max_bytes=BATCH_BYTES)
    _run(apply_feeds(stream, feeds, f"{base}/feeds", f"{base}/checkpoint"))
    waiting = read_parked(spark, f"{base}/feeds", feeds).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    waiting = written(waiting, f"{base}/waiting")
    create_replica(spark.createDataFrame([], NATION_FEED.replica_schema), blocked, NATION_FEED)
    replay_parked(spark, f"{base}/feeds", NATION_FEED)
    out = waiting.select("topic", F.lit(None).cast("bigint").alias("key"), F.concat(F.lit("parked "), "n").alias("value"))
    for topic, mapping in feeds.items():
        rows = read_replica(spark, replica_path(f"{base}/feeds", topic), mapping)
        key, *payload = named(mapping.targets)
        # The second column stands for the row; it is text or a whole number in all four tables.
        value = F.coalesce(payload[0].cast("string"), F.lit("-"))
        out = out.unionByName(rows.select(F.lit(topic).alias("topic"), key.alias("key"), value.alias("value")))
    return out


def log_range(spark: SparkSession, sf: str) -> DataFrame:
    """A log in several files, read from a time to an offset; the index grows between two writes."""
    base = workspace(spark, "range")
    log = _log(spark, sf)
    for part in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 1):
        write_log(log.where(part).repartitionByRange(PARTS, "offset"), f"{base}/log", mode="append")
        index_log(spark, f"{base}/log", f"{base}/index")
    middle = _table(spark, sf, "events").agg(F.floor(F.avg("event_id"))).first()[0] or 0
    start = at_time(spark, f"{base}/log", f"{base}/index", F.to_timestamp(F.lit("2024-01-05 00:00:00")))
    end = {partition: middle for partition in latest(spark, f"{base}/index")}
    records = read_between(spark, f"{base}/log", f"{base}/index", start, end)
    return records.select("topic", "partition", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "change_log": change_log,
    "include_list": include_list,
    "topic_route": topic_route,
    "snapshot_events": snapshot_of_customers,
    "capture_diff": capture_diff,
    "replica_scan": replica_scan,
    "point_lookup": point_lookup,
    "decode_envelope": decode_envelope,
    "classify_events": classify_events,
    "project_rows": project_rows,
    "coerce_key": coerce_keys,
    "typed_columns": typed_columns,
    "dead_letters": dead_letters,
    "op_labels": op_labels,
    "constraint_check": constraint_check,
    "latest_per_key": both_latest,
    "merge_upsert": merge_upsert,
    "merge_delete": merge_delete,
    "effective_changes": effective_changes,
    "apply_batch": apply_batch,
    "apply_staged": apply_staged,
    "apply_to_lower": apply_to_lower,
    "apply_to_upper": apply_to_upper,
    "publish_roundtrip": publish_roundtrip,
    "bidirectional_sync": bidirectional_sync,
    "replica_counts": replica_counts,
    "reconcile": reconcile,
    "outcome_stats": outcome_stats,
    "sync_health": sync_health,
    "stream_apply": stream_apply,
    "stream_apply_reverse": stream_apply_reverse,
    "stream_latest": stream_latest,
    "stream_resume": stream_resume,
    "stream_dead_letters": stream_dead_letters,
    "bootstrap_then_stream": bootstrap_then_stream,
    "mirror_documents": mirror_documents,
    "mirror_events": mirror_events,
    "mirror_conversations": mirror_conversations,
    "text_keys": text_keys,
    "effective_echo": effective_echo,
    "sync_split": sync_split,
    "sync_writes": sync_writes,
    "sync_unequal_limits": sync_unequal_limits,
    "stream_sync": stream_sync,
    "torn_lines": torn_lines,
    "stream_counters": stream_counters,
    "compact_then_follow": compact_then_follow,
    "snapshot_chunks": snapshot_chunks,
    "repeated_batch": repeated_batch,
    "fold_parts": fold_parts,
    "sync_batches": sync_batches,
    "many_feeds": many_feeds,
    "log_range": log_range,
}
