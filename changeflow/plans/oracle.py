"""The same results as SQL over the given tables.

Outcomes are worked out from the columns of ``events``; the JSON of the log is written here
only where the text itself is the result, and never read.
"""

from __future__ import annotations

UPPER_TOPIC = "oracle.DBZUSER.CUSTOMERS"
LOWER_TOPIC = "postgres.public.customers"
DOTTED_TOPIC = "oracle.site-2.west.GEO.REGION"
CAPTURED_AT = 1704067200000

# One row per event: what its record says and what must become of it.
FEED = f"""
numbered AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(value < 35, FALSE) AS is_upper,
         user_id * 12 AS id FROM events),
feed AS (
  SELECT event_id AS "offset", ts, epoch_us(ts) // 1000 AS ts_ms, event_type AS kind, k, is_upper, id,
    CAST(user_id % 4 AS INTEGER) AS part,
    CASE WHEN is_upper THEN '{UPPER_TOPIC}' ELSE '{LOWER_TOPIC}' END AS topic,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN
      CASE WHEN k < 45 THEN 'd' WHEN k < 85 THEN NULL ELSE 't' END ELSE 'u' END AS op,
    CASE WHEN event_type = 'view' AND k < 5 THEN 'error_missing_column'
         WHEN event_type = 'click' AND k < 5 THEN 'skip_no_after'
         WHEN event_type = 'purchase' AND k < 5 THEN 'error_constraint'
         WHEN event_type <> 'error' THEN 'upsert'
         WHEN k < 35 THEN 'delete'
         WHEN k < 45 THEN 'skip_no_before_key'
         WHEN k < 55 THEN 'error_tombstone'
         WHEN k < 70 THEN 'error_malformed'
         WHEN k < 85 THEN 'skip_no_op'
         ELSE 'skip_unknown_op' END AS outcome,
    event_type AS first_name,
    CASE WHEN k >= 55 OR (k >= 50 AND is_upper) THEN 'L' || k
         WHEN k >= 50 THEN '' END AS last_name,
    'u' || user_id || '.' || k || '@example.com' AS email
  FROM numbered),
valid AS (
  SELECT "offset", ts_ms, topic, is_upper, op, outcome, id,
    CASE WHEN outcome = 'upsert' THEN first_name END AS first_name,
    CASE WHEN outcome = 'upsert' THEN last_name END AS last_name,
    CASE WHEN outcome = 'upsert' THEN email END AS email
  FROM feed WHERE outcome IN ('upsert', 'delete')),
numbered_valid AS (
  SELECT *, row_number() OVER (PARTITION BY topic, id ORDER BY "offset" DESC) AS place
  FROM valid),
last_own AS (SELECT * FROM numbered_valid WHERE place = 1),
latest AS (
  SELECT * REPLACE (CASE WHEN is_upper THEN last_name ELSE nullif(last_name, '') END AS last_name)
  FROM last_own),
customers AS (
  SELECT c_custkey AS id, c_mktsegment AS first_name, c_name AS last_name,
         CAST(NULL AS VARCHAR) AS email FROM customer)"""


def _merged(changes: str) -> str:
    """Rows of the customers with the changes of one row per id applied."""
    return f"""
  SELECT id, first_name, last_name, email FROM customers
  WHERE id NOT IN (SELECT id FROM {changes})
  UNION ALL
  SELECT id, first_name, last_name, email FROM {changes} WHERE outcome = 'upsert'"""


STATES = f"""{FEED},
to_lower AS (SELECT * FROM latest WHERE is_upper),
to_upper AS (SELECT * FROM latest WHERE NOT is_upper),
lower_after AS ({_merged("to_lower")}),
upper_after AS ({_merged("to_upper")})"""

# The text of the log.
_NAMES = ("ID", "FIRST_NAME", "LAST_NAME", "EMAIL")


def _text(column: str) -> str:
    return f"""coalesce('"' || {column} || '"', 'null')"""


def _image(prefix: str = "", upper: bool = True, email: str | None = None) -> str:
    names = _NAMES if upper else [n.lower() for n in _NAMES]
    mail = _text(f"{prefix}email") if email is None else email
    return (
        f"""'{{"{names[0]}":' || {prefix}id || ',"{names[1]}":' || {_text(prefix + "first_name")}"""
        f""" || ',"{names[2]}":' || {_text(prefix + "last_name")}"""
        f""" || ',"{names[3]}":' || {mail} || '}}'"""
    )


def _record(upper: bool) -> str:
    schema, table = ("DBZUSER", "CUSTOMERS") if upper else ("public", "customers")
    id_name = "ID" if upper else "id"
    mail_name = "EMAIL" if upper else "email"
    tail = f"""',"source":{{"schema":"{schema}","table":"{table}"}},"ts_ms":' || ts_ms || '}}'"""
    full = _image(upper=upper)
    padded = _image(upper=upper, email="""'"' || rpad(email, 300, 'x') || '"'""")

    def envelope(op: str | None, before: str, after: str) -> str:
        start = f'{{"op":"{op}","before":' if op else '{"before":'
        return f"""'{start}' || {before} || ',"after":' || {after} || {tail}"""

    update = envelope("u", "'null'", full)
    no_mail = f"""regexp_replace({full}, ',"{mail_name}":.*$', '}}')"""
    return f"""CASE
      WHEN kind = 'signup' THEN {envelope("c", "'null'", full)}
      WHEN kind = 'view' AND k < 5 THEN {envelope("r", "'null'", no_mail)}
      WHEN kind = 'view' THEN {envelope("r", "'null'", full)}
      WHEN kind = 'click' AND k < 5 THEN {envelope("u", "'null'", "'null'")}
      WHEN kind = 'purchase' AND k < 5 THEN {envelope("u", "'null'", padded)}
      WHEN kind = 'purchase' AND k < 10
        THEN replace({update}, '"{id_name}":' || id || ',', '"{id_name}":' || id || '.0,')
      WHEN kind <> 'error' THEN {update}
      WHEN k < 35 THEN {envelope("d", full, "'null'")}
      WHEN k < 45 THEN {envelope("d", "'{}'", "'null'")}
      WHEN k < 55 THEN NULL
      WHEN k < 70 THEN left({update}, 40)
      WHEN k < 85 THEN {envelope(None, "'null'", "'null'")}
      ELSE {envelope("t", "'null'", "'null'")} END"""


LOG = f"""{FEED},
log AS (
  SELECT topic, part AS "partition", "offset", ts_ms AS timestamp_ms, op, outcome,
    CASE WHEN is_upper THEN '{{"ID":' ELSE '{{"id":' END || id || '}}' AS key,
    CASE WHEN is_upper THEN {_record(True)} ELSE {_record(False)} END AS value,
    CASE outcome WHEN 'error_missing_column' THEN CASE WHEN is_upper THEN 'EMAIL' ELSE 'email' END
                 WHEN 'error_constraint' THEN CASE WHEN is_upper THEN 'EMAIL' ELSE 'email' END
                 WHEN 'skip_unknown_op' THEN 't' END AS reason
  FROM feed)"""


def _captured(topic: str, op: str, before: str, after: str) -> str:
    _, schema, table = topic.rsplit(".", 2)
    return (
        f"""'{{"op":"' || {op} || '","before":' || {before} || ',"after":' || {after} || """
        f"""',"source":{{"schema":"{schema}","table":"{table}"}},"ts_ms":{CAPTURED_AT}}}'"""
    )


_ALL_TOPICS = f"""
all_topics AS (
  SELECT topic FROM feed
  UNION ALL SELECT 'postgres.public.orders' FROM orders
  UNION ALL SELECT 'oracle.DBZUSER.NATION' FROM nation
  UNION ALL SELECT 'oracle.SYS.REGION' FROM region
  UNION ALL SELECT 'oracle.site-2.west.GEO.REGION' FROM region
  UNION ALL SELECT 'ddl-journal.upper' FROM region)"""

_APPLIED_LOWER = f"WITH {STATES} SELECT * FROM lower_after"
_APPLIED_HALF = _APPLIED_LOWER.replace(
    "FROM events)", "FROM events WHERE event_id <= (SELECT floor(avg(event_id)) FROM events))"
)
_APPLIED_UPPER = f"""WITH {STATES} SELECT id AS "ID", first_name AS "FIRST_NAME",
  last_name AS "LAST_NAME", email AS "EMAIL" FROM upper_after"""
_WINNERS = """
winners AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, is_upper DESC) AS rank
    FROM last_own) WHERE rank = 1)"""
_SYNCED = f"""WITH {FEED}, {_WINNERS},
merged AS ({_merged("winners")})
SELECT 'lower' AS side, id, first_name, last_name, email FROM merged
UNION ALL SELECT 'upper', id, first_name, nullif(last_name, ''), email FROM merged"""
_DEAD = 'topic, "partition", "offset", key, value, op, outcome, reason'
_NOT_VALID = "outcome NOT IN ('upsert', 'delete')"


def _lengths(checked: str, table: str, key: str, column: str, measure: str) -> str:
    return f"""SELECT '{checked}' AS checked, 'length' AS rule, '{column}' AS column_name,
    CAST({key} AS VARCHAR) AS key, CAST({measure}({column}) AS BIGINT) AS detail
  FROM {table} WHERE {measure}({column}) > 255"""


def _uniqueness(checked: str, table: str, key: str) -> str:
    return f"""SELECT '{checked}', 'unique', '{key}', CAST({key} AS VARCHAR), count(*)
  FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1
  UNION ALL
  SELECT '{checked}', 'not_null', '{key}', NULL, 1 FROM {table} WHERE {key} IS NULL"""


def _documents(unit: str, measure: str) -> str:
    checked = f"documents, {unit}"
    return f"""{_lengths(checked, "documents", "doc_id", "source", measure)}
  UNION ALL {_lengths(checked, "documents", "doc_id", "text", measure)}
  UNION ALL {_uniqueness(checked, "documents", "doc_id")}"""


ORACLE_SQL: dict[str, str] = {
    "change_log": f"""WITH {LOG}
SELECT topic, "partition", "offset", timestamp_ms, key, value FROM log""",
    "include_list": f"""WITH {LOG} SELECT topic, key, value FROM log
UNION ALL SELECT '{DOTTED_TOPIC}', '{{"R_REGIONKEY":' || r_regionkey || '}}',
  {_captured(
      DOTTED_TOPIC,
      "'r'",
      "'null'",
      """'{"R_REGIONKEY":' || r_regionkey || ',"R_NAME":"' || r_name || '"}'""",
  )} FROM region""",
    "topic_route": f"""WITH {FEED}, {_ALL_TOPICS}
SELECT topic, CASE WHEN topic LIKE '%.GEO.REGION' THEN 'oracle.site-2.west'
    ELSE split_part(topic, '.', 1) END AS origin,
  CASE WHEN topic LIKE '%.GEO.REGION' THEN 'GEO' ELSE split_part(topic, '.', 2) END AS schema_name,
  CASE WHEN topic LIKE '%.GEO.REGION' THEN 'REGION'
    ELSE nullif(split_part(topic, '.', 3), '') END AS table_name,
  topic LIKE 'oracle.%' OR topic LIKE 'postgres.%' AS is_feed, count(*) AS records
FROM all_topics GROUP BY ALL""",
    "snapshot_events": f"""WITH {FEED}
SELECT '{UPPER_TOPIC}' AS topic, '{{"ID":' || id || '}}' AS key,
  {_captured(UPPER_TOPIC, "'r'", "'null'", _image())} AS value FROM customers""",
    "capture_diff": f"""WITH {STATES},
both_states AS (
  SELECT a.id AS old_id, a.first_name AS old_first_name, a.last_name AS old_last_name,
    a.email AS old_email, b.id AS new_id, b.first_name AS new_first_name,
    b.last_name AS new_last_name, b.email AS new_email
  FROM customers a FULL JOIN lower_after b ON a.id = b.id)
SELECT '{UPPER_TOPIC}' AS topic, '{{"ID":' || coalesce(old_id, new_id) || '}}' AS key,
  {_captured(
      UPPER_TOPIC,
      "CASE WHEN old_id IS NULL THEN 'c' WHEN new_id IS NULL THEN 'd' ELSE 'u' END",
      f"CASE WHEN old_id IS NULL THEN 'null' ELSE {_image('old_')} END",
      f"CASE WHEN new_id IS NULL THEN 'null' ELSE {_image('new_')} END",
  )} AS value
FROM both_states
WHERE (old_id, old_first_name, old_last_name, old_email)
  IS DISTINCT FROM (new_id, new_first_name, new_last_name, new_email)""",
    "replica_scan": """SELECT c_custkey AS "ID", c_mktsegment AS "FIRST_NAME",
  c_name AS "LAST_NAME" FROM customer""",
    "point_lookup": f"""WITH {FEED}
SELECT *, 'lower' AS side FROM customers WHERE id = 100
UNION ALL SELECT *, 'upper' FROM customers WHERE id = 200""",
    "decode_envelope": f"""WITH {FEED}
SELECT topic, "offset", CAST(id AS VARCHAR) AS message_key, op,
  CASE WHEN outcome NOT IN ('error_tombstone', 'error_malformed') THEN ts_ms END AS ts_ms,
  CASE WHEN outcome NOT IN ('error_tombstone', 'error_malformed')
    THEN ts_ms * 1000 END AS event_micros,
  CASE WHEN outcome IN ('error_tombstone', 'error_malformed') THEN NULL
    WHEN is_upper THEN '{{"schema":"DBZUSER","table":"CUSTOMERS"}}'
    ELSE '{{"schema":"public","table":"customers"}}' END AS source,
  coalesce(op = 'd', FALSE) AS has_before,
  coalesce(op IN ('c', 'u', 'r') AND outcome <> 'skip_no_after', FALSE) AS has_after
FROM feed""",
    "classify_events": f"""WITH {LOG} SELECT topic, "offset", op, outcome, reason FROM log""",
    "project_rows": f"""WITH {FEED}
SELECT topic, "offset", id, first_name,
  CASE WHEN is_upper THEN last_name ELSE nullif(last_name, '') END AS last_name, email
FROM valid""",
    "coerce_key": """
SELECT event_id,
  CASE event_type WHEN 'signup' THEN CAST(event_id AS VARCHAR) WHEN 'view' THEN event_id || '.0'
    WHEN 'click' THEN event_id || '.7' WHEN 'purchase' THEN 'key ' || event_id
    ELSE CASE WHEN value < 10 THEN 'true' WHEN value < 20
      THEN '99999999999999' || event_id || '00000' WHEN value < 30 THEN '1e30' END
  END AS key_text,
  CASE WHEN event_type IN ('signup', 'view', 'click') THEN event_id
    WHEN event_type = 'purchase' THEN 0 WHEN value >= 30 THEN 0 END AS reference_key,
  CASE WHEN event_type IN ('signup', 'view') THEN event_id END AS strict_key
FROM events""",
    "typed_columns": """
SELECT 'upsert' AS outcome, NULL AS reason, o_orderkey AS key, o_orderkey, o_custkey,
  o_orderstatus, o_totalprice, o_orderdate, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_day
FROM orders
UNION ALL
SELECT 'error_constraint', 'O_CUSTKEY', o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL FROM orders""",
    "dead_letters": f"""WITH {LOG} SELECT {_DEAD} FROM log WHERE {_NOT_VALID}""",
    "op_labels": f"""WITH {FEED}
SELECT topic, "offset", op, CASE op WHEN 'c' THEN 'create' WHEN 'u' THEN 'update'
  WHEN 'd' THEN 'delete' WHEN 'r' THEN 'read' END AS operation FROM feed""",
    "constraint_check": f"""
{_documents("characters", "length")}
  UNION ALL {_documents("bytes", "strlen")}
  UNION ALL {_lengths("conversations", "conversations", "conv_id", "role", "length")}
  UNION ALL {_lengths("conversations", "conversations", "conv_id", "text", "length")}
  UNION ALL {_uniqueness("conversations", "conversations", "conv_id")}""",
    "latest_per_key": f"""WITH {FEED}
SELECT topic, "offset", outcome, id, first_name, last_name, email FROM latest""",
    "merge_upsert": f"""WITH {STATES}
SELECT * FROM customers WHERE id NOT IN (SELECT id FROM to_lower WHERE outcome = 'upsert')
UNION ALL SELECT id, first_name, last_name, email FROM to_lower WHERE outcome = 'upsert'""",
    "merge_delete": f"""WITH {STATES}
SELECT * FROM customers WHERE id NOT IN (SELECT id FROM to_lower WHERE outcome = 'delete')""",
    "effective_changes": f"""WITH {STATES}
SELECT CASE WHEN n.outcome = 'delete' THEN 'delete' WHEN o.id IS NULL THEN 'insert'
  ELSE 'update' END AS action, n.id, n.first_name, n.last_name, n.email
FROM to_lower n LEFT JOIN customers o ON o.id = n.id
WHERE CASE WHEN n.outcome = 'delete' THEN o.id IS NOT NULL
  ELSE (n.id, n.first_name, n.last_name, n.email)
    IS DISTINCT FROM (o.id, o.first_name, o.last_name, o.email) END""",
    "apply_batch": _APPLIED_LOWER,
    "apply_staged": _APPLIED_LOWER,
    "apply_to_lower": _APPLIED_LOWER,
    "apply_to_upper": _APPLIED_UPPER,
    "publish_roundtrip": _APPLIED_LOWER,
    "bidirectional_sync": _SYNCED,
    "sync_split": _SYNCED,
    "stream_sync": _SYNCED,
    "sync_writes": f"""WITH {STATES}, {_WINNERS},
own_lower AS (SELECT * FROM last_own WHERE NOT is_upper),
own_upper AS (SELECT * REPLACE (nullif(last_name, '') AS last_name) FROM last_own WHERE is_upper),
held_lower AS ({_merged("own_lower")}),
held_upper AS ({_merged("own_upper")}),
sent AS (
  SELECT CASE WHEN is_upper THEN 'lower' ELSE 'upper' END AS side, outcome, id, first_name,
    CASE WHEN is_upper THEN last_name ELSE nullif(last_name, '') END AS last_name, email FROM winners),
held AS (SELECT 'lower' AS side, * FROM held_lower UNION ALL SELECT 'upper', * FROM held_upper)
SELECT s.side, CASE WHEN s.outcome = 'delete' THEN 'delete' WHEN h.id IS NULL THEN 'insert'
  ELSE 'update' END AS action, s.id, s.first_name, s.last_name, s.email
FROM sent s LEFT JOIN held h ON s.side = h.side AND s.id = h.id
WHERE CASE WHEN s.outcome = 'delete' THEN h.id IS NOT NULL ELSE
  (s.id, s.first_name, s.last_name, s.email)
    IS DISTINCT FROM (h.id, h.first_name, h.last_name, h.email) END""",
    "sync_unequal_limits": f"""WITH {FEED},
wide AS (
  SELECT * EXCLUDE (last_name, place), CASE WHEN outcome = 'upsert' AND NOT is_upper AND "offset" % 3 = 0
    THEN repeat('é', 200) ELSE last_name END AS last_name FROM numbered_valid WHERE place = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, is_upper DESC) AS rank,
    strlen(last_name) > 255 AS too_wide FROM wide),
winner AS (SELECT * FROM ranked WHERE rank = 1),
for_upper AS (
  SELECT * FROM winner WHERE is_upper OR NOT coalesce(too_wide, FALSE)
  UNION ALL SELECT r.* FROM ranked r JOIN winner w ON r.id = w.id
  WHERE r.is_upper AND r.rank = 2 AND w.too_wide),
lower_side AS ({_merged("winner")}),
upper_side AS ({_merged("for_upper")})
SELECT 'lower' AS side, 'held' AS outcome, * FROM lower_side
UNION ALL SELECT 'upper', 'held', id, first_name, nullif(last_name, ''), email FROM upper_side
UNION ALL SELECT 'upper', 'error_constraint', id, first_name, last_name, email FROM winner
WHERE NOT is_upper AND too_wide""",
    "effective_echo": f"""WITH {STATES}
SELECT 'update' AS action, id, first_name, last_name, email || '.new' AS email
FROM to_lower WHERE outcome = 'upsert' AND id % 7 = 0""",
    "text_keys": """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events)
SELECT CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS outcome,
  'u' || user_id AS user_name, CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
  nullif(event_type, 'error') AS event_type
FROM ranked WHERE place = 1""",
    "mirror_documents": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "mirror_events": """
SELECT event_id, user_id AS "offset", event_type AS outcome, value, props AS "a $.b" FROM events""",
    "mirror_conversations": "SELECT conv_id, turn, role, text FROM conversations",
    "torn_lines": f"""WITH {LOG},
letters AS (
  SELECT topic, CASE WHEN torn THEN NULL ELSE "offset" END AS "offset",
    CASE WHEN torn THEN 'error_torn' ELSE outcome END AS outcome,
    CASE WHEN torn THEN left('{{"partition":' || "partition" || ',"offset":' || "offset" || ',"timestamp":', 25)
      END AS line
  FROM (SELECT *, "offset" % 10 = 3 AS torn FROM log) WHERE torn OR {_NOT_VALID})
SELECT 'batch' AS read, * FROM letters UNION ALL SELECT 'stream', * FROM letters""",
    "stream_counters": f"""WITH {FEED}
SELECT topic, op, outcome, count(*) AS records FROM feed WHERE is_upper GROUP BY topic, op, outcome""",
    "compact_then_follow": _APPLIED_LOWER,
    "replica_counts": f"""WITH {STATES},
counts AS (
  SELECT 'customers' AS replica, count(*) AS row_count FROM customers
  UNION ALL SELECT 'lower', count(*) FROM lower_after
  UNION ALL SELECT 'upper', count(*) FROM upper_after)
SELECT replica, row_count, 'rows held: ' || row_count AS label FROM counts""",
    "reconcile": f"""WITH {STATES}
SELECT coalesce(a.id, b.id) AS key,
  CASE WHEN b.id IS NULL THEN 'only_lower' WHEN a.id IS NULL THEN 'only_upper'
    WHEN (a.first_name, a.last_name, a.email) IS NOT DISTINCT FROM
      (b.first_name, b.last_name, b.email) THEN 'match' ELSE 'differ' END AS status
FROM lower_after a FULL JOIN upper_after b ON a.id = b.id""",
    "outcome_stats": f"""WITH {FEED}
SELECT topic, op, outcome, count(*) AS records FROM feed GROUP BY topic, op, outcome""",
    "sync_health": f"""WITH {STATES},
n AS (SELECT (SELECT count(*) FROM lower_after) AS l, (SELECT count(*) FROM upper_after) AS u,
  (SELECT count(*) FROM feed) AS r, (SELECT count(*) FROM feed WHERE {_NOT_VALID}) AS d),
checks AS (
  SELECT 'lower_non_empty' AS check_name, l > 0 AS ok, CAST(least(l, 1) AS VARCHAR) AS detail FROM n
  UNION ALL SELECT 'upper_non_empty', u > 0, CAST(least(u, 1) AS VARCHAR) FROM n
  UNION ALL SELECT 'counts_agree', l = u, least(l, u) || ' / ' || greatest(l, u) FROM n
  UNION ALL SELECT 'dead_letter_rate', d <= r * 0.25, d || ' / ' || r FROM n)
SELECT * FROM checks UNION ALL SELECT 'all', bool_and(ok), NULL FROM checks""",
    "stream_apply": _APPLIED_LOWER,
    "stream_apply_reverse": _APPLIED_UPPER,
    "stream_latest": f"""WITH {FEED}
SELECT "offset", outcome, id, first_name, last_name, email FROM latest WHERE is_upper""",
    "stream_resume": f"""WITH {FEED},
parted AS (
  SELECT v.*, CASE WHEN f.ts < TIMESTAMP '2024-01-11' THEN 0 WHEN f.ts < TIMESTAMP '2024-01-21' THEN 1
    ELSE 2 END AS part
  FROM valid v JOIN feed f ON v."offset" = f."offset" WHERE v.is_upper),
runs AS (SELECT part, dense_rank() OVER (ORDER BY part) - 1 AS batch_id FROM
  (SELECT DISTINCT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1
    ELSE 2 END AS part FROM feed WHERE is_upper)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY part, id ORDER BY "offset" DESC) AS place FROM parted)
SELECT CAST(batch_id AS BIGINT) AS batch_id, "offset", outcome, id, first_name, last_name, email
FROM ranked JOIN runs USING (part) WHERE place = 1""",
    "stream_dead_letters": f"""WITH {LOG}
SELECT {_DEAD} FROM log WHERE {_NOT_VALID} AND topic = '{UPPER_TOPIC}'""",
    "bootstrap_then_stream": _APPLIED_LOWER,
    "snapshot_chunks": _APPLIED_LOWER,
    "repeated_batch": f"""
SELECT *, 'after the first died' AS seen FROM ({_APPLIED_HALF})
UNION ALL SELECT *, 'after the repetition' FROM ({_APPLIED_LOWER})
UNION ALL SELECT *, 'after folding' FROM ({_APPLIED_LOWER})""",
    "fold_parts": _APPLIED_LOWER,
    "sync_batches": _SYNCED,
    "log_range": f"""WITH {FEED},
placed AS (
  SELECT topic, part, "offset",
    min(CASE WHEN ts >= TIMESTAMP '2024-01-05' THEN "offset" END) OVER (PARTITION BY topic, part) AS first
  FROM feed)
SELECT topic, part AS "partition", "offset" FROM placed
WHERE "offset" >= first AND "offset" < (SELECT floor(avg(event_id)) FROM events)""",
    "many_feeds": f"""WITH {STATES}
SELECT '{UPPER_TOPIC}' AS topic, id AS key, coalesce(first_name, '-') AS value FROM lower_after
UNION ALL SELECT '{LOWER_TOPIC}', id, coalesce(first_name, '-') FROM upper_after
UNION ALL SELECT 'postgres.public.orders', o_orderkey, coalesce(o_custkey::VARCHAR, '-') FROM orders
UNION ALL SELECT 'oracle.DBZUSER.NATION', n_nationkey, coalesce(n_name, '-') FROM nation
UNION ALL SELECT 'oracle.DBZUSER.NATION', NULL, 'parked ' || count(*) FROM nation""",
}
