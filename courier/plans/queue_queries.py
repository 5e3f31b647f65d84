"""Registered queries over the packet queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.config import Prioritizer, QueueConfig
from courier.functions import packets as P
from courier.operators import drain as D
from courier.operators import queue as Q
from courier.plans.inputs import (
    NOW_MS,
    event_queue,
    partly_in_flight,
    table,
    user_transactions,
)
from courier.plans.registry import ORACLES, query

BATCH_COUNT = 100
BATCH_BYTES = 4096
MAX_ROWS = 4000
MAX_BYTES = 200_000

#: The queue of ``event_queue`` in SQL.
QUEUE_SQL = """
q AS (
  SELECT packet_id, attributes, content,
         CAST(strlen(attributes) + strlen(content) AS BIGINT) AS estimated_size,
         created, created + ttl_days * 86400000 AS expires, priority,
         CAST(NULL AS VARCHAR) AS transaction_id, event_type, user_id
  FROM (
    SELECT event_id AS packet_id,
           '{"event_type":"' || event_type || '","user_id":"' || CAST(user_id AS VARCHAR) || '"}'
             AS attributes,
           props AS content, event_type, user_id,
           CAST(epoch_us(ts) // 1000 - 978307200000 AS BIGINT) AS created,
           CAST(CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1
             WHEN 'signup' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS BIGINT) AS priority,
           CAST(CASE event_type WHEN 'error' THEN 20 WHEN 'purchase' THEN 15
             WHEN 'signup' THEN 10 WHEN 'click' THEN 5 ELSE 2 END AS BIGINT) AS ttl_days
    FROM events)
)"""
#: Adds send-order position and the bytes queued before each row.
ORDER = "priority ASC NULLS FIRST, created ASC NULLS FIRST, packet_id ASC"
RANKED = """
SELECT *, row_number() OVER w AS rn,
       coalesce(sum(estimated_size) OVER
         (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM {source} WINDOW w AS (ORDER BY {order})"""
COLUMNS = (
    "packet_id, attributes, content, estimated_size, created, expires, priority, transaction_id"
)
FLIGHT_SQL = """
f AS (SELECT * REPLACE (CASE WHEN event_type IN ('purchase', 'signup')
                        THEN 'tx-' || event_type END AS transaction_id) FROM q)"""


def ranked(source: str) -> str:
    return RANKED.format(order=ORDER, source=source)


def shown(queue: DataFrame) -> DataFrame:
    """Queue rows with the content as text."""
    return queue.withColumn("content", F.decode("content", "UTF-8"))


# --- rows ----------------------------------------------------------------------


@query("queue_rows", f"WITH {QUEUE_SQL} SELECT {COLUMNS} FROM q")
def queue_rows(spark, sf_dir):
    return shown(event_queue(spark, sf_dir))


@query(
    "default_priority_rows",
    f"""WITH {QUEUE_SQL} SELECT packet_id, estimated_size, created, created + 1000 AS expires,
        CAST(0 AS BIGINT) AS priority FROM q""",
)
def default_priority_rows(spark, sf_dir):
    rows = event_queue(spark, sf_dir, Prioritizer())
    return rows.select("packet_id", "estimated_size", "created", "expires", "priority")


@query(
    "content_prioritizer",
    f"""WITH {QUEUE_SQL} SELECT packet_id,
        CAST(json_extract(content, '$.k') AS BIGINT) % 3 AS priority,
        created + CAST(json_extract(content, '$.k') AS BIGINT) * 60000 AS expires FROM q""",
)
def content_prioritizer(spark, sf_dir):
    k = "CAST(get_json_object(decode(content, 'UTF-8'), '$.k') AS BIGINT)"
    rows = event_queue(spark, sf_dir, Prioritizer(f"{k} % 3", f"{k} * 60000"))
    return rows.select("packet_id", "priority", "expires")


@query(
    "text_packets",
    """SELECT doc_id, CAST(0 AS BIGINT) AS attribute_count, text AS content,
       CAST(strlen(text) AS BIGINT) AS declared_length FROM documents""",
)
def text_packets(spark, sf_dir):
    rows = P.from_text(table(spark, sf_dir, "documents"), F.col("text"), keep=("doc_id",))
    return rows.select(
        "doc_id",
        F.size("attributes").cast("bigint").alias("attribute_count"),
        F.decode("content", "UTF-8").alias("content"),
        "declared_length",
    )


@query(
    "declared_lengths",
    """SELECT doc_id, CAST(n_chars AS BIGINT) AS declared_length,
       CAST(strlen(text) AS BIGINT) AS actual_length, strlen(text) <> n_chars AS length_mismatch
       FROM documents""",
)
def declared_lengths(spark, sf_dir):
    rows = P.from_declared(
        table(spark, sf_dir, "documents"),
        P.empty_attributes(),
        F.encode("text", "UTF-8"),
        F.col("n_chars"),
        keep=("doc_id",),
    )
    return rows.select(
        "doc_id",
        "declared_length",
        P.content_length(F.col("content")).alias("actual_length"),
        "length_mismatch",
    )


@query(
    "packets_from_queue",
    f"""WITH {QUEUE_SQL} SELECT packet_id, event_type, 'seen' AS stage,
        CAST(2 AS BIGINT) AS attribute_count, content,
        CAST(strlen(content) AS BIGINT) AS declared_length FROM q""",
)
def packets_from_queue(spark, sf_dir):
    rows = P.to_packets(event_queue(spark, sf_dir))
    changed = P.set_attribute(P.set_attribute(F.col("attributes"), "stage", "seen"), "user_id", None)
    return rows.withColumn("attributes", changed).select(
        "packet_id",
        F.col("attributes")["event_type"].alias("event_type"),
        F.col("attributes")["stage"].alias("stage"),
        F.size("attributes").cast("bigint").alias("attribute_count"),
        F.decode("content", "UTF-8").alias("content"),
        "declared_length",
    )


@query(
    "device_packets",
    """WITH d AS (
      SELECT event_id, 'device-' || CAST(user_id AS VARCHAR) AS device_id,
        coalesce(c_name, '') AS user_name,
        CAST(year(ts) AS VARCHAR) || '-' || month(ts) || '-' || day(ts) || ' ' || hour(ts) || ':'
          || minute(ts) || ':' || second(ts) AS event_time,
        event_type AS click, CAST(event_id AS VARCHAR) AS packet_number,
        CAST(c_nationkey AS VARCHAR) AS latitude, CAST(c_custkey AS VARCHAR) AS longitude,
        coalesce(c_mktsegment || ', ', '') || coalesce(n_name || ', ', '')
          || coalesce(r_name || ', ', '') || coalesce(CAST(c_custkey AS VARCHAR) || ' ', '')
          AS address
      FROM events LEFT JOIN customer ON user_id = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
    SELECT event_id, event_time, address, '{"deviceId":"' || device_id || '","userName":"' || user_name
      || '","evenTime":"' || event_time || '","clickEvent":"' || click || '","packetNumber":"'
      || packet_number || '","latitude":' || coalesce('"' || latitude || '"', 'null')
      || ',"longitude":' || coalesce('"' || longitude || '"', 'null')
      || ',"address":"' || address || '"}' AS content FROM d""",
)
def device_packets(spark, sf_dir):
    people = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    rows = table(spark, sf_dir, "events").join(
        people, F.col("user_id") == F.col("c_custkey"), "left"
    )
    packets = P.device_packets(
        rows,
        {
            "deviceId": F.concat(F.lit("device-"), F.col("user_id").cast("string")),
            "userName": F.coalesce("c_name", F.lit("")),
            "evenTime": P.event_time_text(F.col("ts")),
            "clickEvent": F.col("event_type"),
            "packetNumber": F.col("event_id"),
            "latitude": F.col("c_nationkey"),
            "longitude": F.col("c_custkey"),
            "address": P.address_line(
                F.col("c_mktsegment"), F.col("n_name"), F.lit(None).cast("string"),
                F.col("r_name"), F.col("c_custkey").cast("string"),
            ),
        },
        keep=("event_id",),
    )
    return packets.select(
        "event_id",
        F.col("attributes")["evenTime"].alias("event_time"),
        F.col("attributes")["address"].alias("address"),
        F.decode("content", "UTF-8").alias("content"),
    )


# --- filters and batches ---------------------------------------------------------


@query(
    "unassigned",
    f"WITH {QUEUE_SQL}, {FLIGHT_SQL} SELECT {COLUMNS} FROM f WHERE transaction_id IS NULL",
)
def unassigned(spark, sf_dir):
    return shown(Q.unassigned(partly_in_flight(spark, sf_dir)))


@query(
    "transaction_packets",
    f"""WITH {QUEUE_SQL}, {FLIGHT_SQL} SELECT {COLUMNS} FROM f
        WHERE transaction_id = 'tx-signup' ORDER BY {ORDER}""",
)
def transaction_packets(spark, sf_dir):
    return shown(Q.transaction_packets(partly_in_flight(spark, sf_dir), "tx-signup"))


@query(
    "batch_count",
    f"WITH {QUEUE_SQL} SELECT {COLUMNS} FROM q ORDER BY {ORDER} LIMIT {BATCH_COUNT}",
)
def batch_count(spark, sf_dir):
    return shown(Q.in_send_order(Q.batch(event_queue(spark, sf_dir), BATCH_COUNT, 0)))


@query(
    "batch_bytes",
    f"""WITH {QUEUE_SQL}, r AS ({ranked('q')})
        SELECT {COLUMNS} FROM r WHERE before < {BATCH_BYTES} ORDER BY {ORDER}""",
)
def batch_bytes(spark, sf_dir):
    return shown(Q.in_send_order(Q.batch(event_queue(spark, sf_dir), 0, BATCH_BYTES)))


@query(
    "batch_count_and_bytes",
    f"""WITH {QUEUE_SQL}, r AS ({ranked('q')}) SELECT {COLUMNS} FROM r
        WHERE rn <= {BATCH_COUNT} AND before < {BATCH_BYTES} ORDER BY {ORDER}""",
)
def batch_count_and_bytes(spark, sf_dir):
    return shown(Q.in_send_order(Q.batch(event_queue(spark, sf_dir), BATCH_COUNT, BATCH_BYTES)))


@query("batch_unlimited", f"WITH {QUEUE_SQL}, {FLIGHT_SQL} SELECT {COLUMNS} FROM f WHERE transaction_id IS NULL")
def batch_unlimited(spark, sf_dir):
    return shown(Q.batch(partly_in_flight(spark, sf_dir), 0, 0))


# --- age-off and trims -------------------------------------------------------------


@query("age_off", f"WITH {QUEUE_SQL} SELECT {COLUMNS} FROM q WHERE expires >= {NOW_MS}")
def age_off(spark, sf_dir):
    return shown(Q.age_off(event_queue(spark, sf_dir), NOW_MS))


@query(
    "trim_rows",
    f"WITH {QUEUE_SQL}, r AS ({ranked('q')}) SELECT {COLUMNS} FROM r WHERE rn <= {MAX_ROWS}",
)
def trim_rows(spark, sf_dir):
    return shown(Q.trim_rows(event_queue(spark, sf_dir), MAX_ROWS))


@query(
    "trim_bytes",
    f"""WITH {QUEUE_SQL}, r AS ({ranked('q')}) SELECT {COLUMNS} FROM r
        WHERE (SELECT sum(estimated_size) FROM q) <= {MAX_BYTES} OR before < {MAX_BYTES}""",
)
def trim_bytes(spark, sf_dir):
    return shown(Q.trim_bytes(event_queue(spark, sf_dir), MAX_BYTES))


@query(
    "trim_removed",
    f"WITH {QUEUE_SQL}, r AS ({ranked('q')}) SELECT {COLUMNS} FROM r WHERE rn > {MAX_ROWS}",
)
def trim_removed(spark, sf_dir):
    rows = event_queue(spark, sf_dir)
    return shown(Q.removed(rows, Q.trim_rows(rows, MAX_ROWS))).select(
        *[c.strip() for c in COLUMNS.split(",")]
    )


CLEAN_SQL = f"""
live AS (SELECT * FROM q WHERE expires >= {NOW_MS}),
few AS (SELECT * EXCLUDE (rn, before) FROM ({ranked('live')}) WHERE rn <= {MAX_ROWS}),
clean AS (SELECT * EXCLUDE (rn, before) FROM ({ranked('few')})
          WHERE (SELECT sum(estimated_size) FROM few) <= {MAX_BYTES} OR before < {MAX_BYTES})"""
LIMITS = QueueConfig(
    max_packets=MAX_ROWS, max_bytes=MAX_BYTES, batch_packets=BATCH_COUNT, batch_bytes=BATCH_BYTES
)


@query("clean_up", f"WITH {QUEUE_SQL}, {CLEAN_SQL} SELECT {COLUMNS} FROM clean")
def clean_up(spark, sf_dir):
    return shown(Q.clean_up(event_queue(spark, sf_dir), LIMITS, NOW_MS))


# --- state changes -------------------------------------------------------------------

ASSIGNED_SQL = f"""
r AS ({ranked('q')}),
a AS (SELECT * REPLACE (CASE WHEN rn <= {BATCH_COUNT} AND before < {BATCH_BYTES}
                        THEN 'tx-1' END AS transaction_id) FROM r)"""


@query("assign", f"WITH {QUEUE_SQL}, {ASSIGNED_SQL} SELECT {COLUMNS} FROM a")
def assign(spark, sf_dir):
    return shown(Q.assign(event_queue(spark, sf_dir), "tx-1", BATCH_COUNT, BATCH_BYTES))


@query("assign_by_id", f"WITH {QUEUE_SQL}, {ASSIGNED_SQL} SELECT {COLUMNS} FROM a")
def assign_by_id(spark, sf_dir):
    rows = event_queue(spark, sf_dir)
    chosen = Q.batch(rows, BATCH_COUNT, BATCH_BYTES).withColumn("transaction_id", F.lit("tx-1"))
    return shown(Q.assign_ids(rows, chosen))


@query(
    "acknowledge",
    f"""WITH {QUEUE_SQL}, {FLIGHT_SQL} SELECT {COLUMNS} FROM f
        WHERE transaction_id IS DISTINCT FROM 'tx-purchase'""",
)
def acknowledge(spark, sf_dir):
    return shown(Q.acknowledge(partly_in_flight(spark, sf_dir), "tx-purchase"))


@query(
    "release",
    f"""WITH {QUEUE_SQL}, {FLIGHT_SQL}
        SELECT {COLUMNS} FROM (SELECT * REPLACE (nullif(transaction_id, 'tx-purchase')
                               AS transaction_id) FROM f)""",
)
def release(spark, sf_dir):
    return shown(Q.release(partly_in_flight(spark, sf_dir), "tx-purchase"))


@query(
    "changed_rows",
    f"""WITH {QUEUE_SQL}, {FLIGHT_SQL} SELECT
        count(*) FILTER (transaction_id = 'tx-purchase') AS removed,
        CAST(0 AS BIGINT) AS added,
        count(*) FILTER (transaction_id = 'tx-signup') AS updated FROM f""",
)
def changed_rows(spark, sf_dir):
    before = partly_in_flight(spark, sf_dir)
    after = Q.release(Q.acknowledge(before, "tx-purchase"), "tx-signup")
    return Q.changed_rows(before, after)


# --- status ----------------------------------------------------------------------------


def status_sql(source: str) -> str:
    return f"""SELECT queued_packets, queued_bytes, average_bytes,
      queued_packets / CAST({MAX_ROWS} AS DOUBLE) AS capacity_fraction,
      queued_packets >= {MAX_ROWS} OR queued_bytes >= {MAX_BYTES} - average_bytes AS is_full
    FROM (SELECT count(*) AS queued_packets,
                 CAST(coalesce(sum(estimated_size), 0) AS BIGINT) AS queued_bytes,
                 CAST(coalesce(floor(avg(estimated_size)), 0) AS BIGINT) AS average_bytes
          FROM {source})"""


@query("queue_status", f"WITH {QUEUE_SQL} {status_sql('q')}")
def queue_status(spark, sf_dir):
    return Q.queue_status(event_queue(spark, sf_dir), LIMITS)


@query("cleaned_status", f"WITH {QUEUE_SQL}, {CLEAN_SQL} {status_sql('clean')}")
def cleaned_status(spark, sf_dir):
    return Q.queue_status(Q.clean_up(event_queue(spark, sf_dir), LIMITS, NOW_MS), LIMITS)


@query(
    "transaction_totals",
    f"""WITH {QUEUE_SQL}, t AS (SELECT 'tx-' || CAST(user_id AS VARCHAR) AS transaction_id, content FROM q)
        SELECT transaction_id, count(*) AS packets,
               CAST(sum(strlen(content)) AS BIGINT) AS content_bytes FROM t GROUP BY 1""",
)
def transaction_totals(spark, sf_dir):
    return Q.transaction_totals(user_transactions(spark, sf_dir))


# --- draining ---------------------------------------------------------------------------

@query(
    "drain_by_count",
    f"""WITH {QUEUE_SQL}, r AS ({ranked('q')})
        SELECT packet_id, rn AS send_position, (rn - 1) // {BATCH_COUNT} + 1 AS batch FROM r""",
)
def drain_by_count(spark, sf_dir):
    return D.drain_plan(event_queue(spark, sf_dir), BATCH_COUNT, 0).select(
        "packet_id", "send_position", "batch"
    )


@query(
    "drain_plan",
    f"""WITH RECURSIVE {QUEUE_SQL},
      r AS (SELECT *, before + estimated_size AS upto FROM ({ranked('q')})),
      walk AS (
        SELECT 1 AS batch, CAST(1 AS BIGINT) AS first_rn,
          (SELECT least(min(CASE WHEN upto >= {BATCH_BYTES} THEN rn END), {BATCH_COUNT}, max(rn))
           FROM r) AS last_rn
        UNION ALL
        SELECT batch + 1, last_rn + 1,
          (SELECT least(min(CASE WHEN upto >= {BATCH_BYTES}
                     + (SELECT before FROM r AS s WHERE s.rn = walk.last_rn + 1) THEN rn END),
                   walk.last_rn + {BATCH_COUNT}, max(rn)) FROM r)
        FROM walk WHERE last_rn < (SELECT max(rn) FROM r))
    SELECT packet_id, rn AS send_position, CAST(batch AS BIGINT) AS batch
    FROM r JOIN walk ON rn BETWEEN first_rn AND last_rn""",
)
def drain_plan(spark, sf_dir):
    return D.drain_plan(event_queue(spark, sf_dir), BATCH_COUNT, BATCH_BYTES).select(
        "packet_id", "send_position", "batch"
    )


# --- the same results by the branches meant for large queues --------------------------------

#: Search settings that make every step of a search take place on small tables.
STEPS = {"finish_rows": 50, "take_rows": 0, "bins": 16}


@query("stepwise_batch_bytes", ORACLES["batch_bytes"])
def stepwise_batch_bytes(spark, sf_dir):
    return shown(Q.batch(event_queue(spark, sf_dir), 0, BATCH_BYTES, **STEPS))


@query("stepwise_batch_count_and_bytes", ORACLES["batch_count_and_bytes"])
def stepwise_batch_count_and_bytes(spark, sf_dir):
    return shown(Q.batch(event_queue(spark, sf_dir), BATCH_COUNT, BATCH_BYTES, **STEPS))


@query("stepwise_trim_rows", ORACLES["trim_rows"])
def stepwise_trim_rows(spark, sf_dir):
    return shown(Q.trim_rows(event_queue(spark, sf_dir), MAX_ROWS, **STEPS))


@query("stepwise_trim_bytes", ORACLES["trim_bytes"])
def stepwise_trim_bytes(spark, sf_dir):
    return shown(Q.trim_bytes(event_queue(spark, sf_dir), MAX_BYTES, **STEPS))


@query("drain_plan_in_levels", ORACLES["drain_plan"])
def drain_plan_in_levels(spark, sf_dir):
    """Several chunks, their reports combined two by two."""
    plan = D.drain_plan(
        event_queue(spark, sf_dir), BATCH_COUNT, BATCH_BYTES, chunk_rows=2_000, fan=2
    )
    return plan.select("packet_id", "send_position", "batch")


@query(
    "trim_protecting_flight",
    f"""WITH {QUEUE_SQL}, f AS (SELECT * REPLACE (CASE WHEN event_type IN ('purchase', 'signup')
          THEN 'tx-' || event_type END AS transaction_id) FROM q), r AS ({ranked('f')})
        SELECT {COLUMNS} FROM r WHERE rn <= {MAX_ROWS} OR transaction_id IS NOT NULL""",
)
def trim_protecting_flight(spark, sf_dir):
    return shown(Q.trim_rows(partly_in_flight(spark, sf_dir), MAX_ROWS, True))


NULLED = """CASE WHEN packet_id % 3 = 0 THEN NULL ELSE priority END"""


@query(
    "batch_with_null_keys",
    f"""WITH {QUEUE_SQL}, z AS (SELECT * REPLACE ({NULLED} AS priority,
          CASE WHEN packet_id % 2 = 0 THEN NULL ELSE created END AS created) FROM q)
        SELECT packet_id FROM z
        ORDER BY priority NULLS FIRST, created NULLS FIRST, packet_id LIMIT {BATCH_COUNT * 3}""",
)
def batch_with_null_keys(spark, sf_dir):
    queue = (
        event_queue(spark, sf_dir)
        .withColumn("priority", F.expr(NULLED))
        .withColumn("created", F.expr("CASE WHEN packet_id % 2 = 0 THEN NULL ELSE created END"))
    )
    return Q.batch(queue, BATCH_COUNT * 3, None, **STEPS).select("packet_id")


@query(
    "trim_to_nothing",
    f"""WITH {QUEUE_SQL}, r AS ({ranked('q')})
        SELECT 'rows' AS "limit", packet_id FROM r WHERE FALSE
        UNION ALL SELECT 'bytes', packet_id FROM r WHERE rn = 1
        UNION ALL SELECT 'none', packet_id FROM r""",
)
def trim_to_nothing(spark, sf_dir):
    """A limit of 0 keeps no rows, or the first row; without a limit all rows stay."""
    queue = event_queue(spark, sf_dir)
    kept = {
        "rows": Q.trim_rows(queue, 0),
        "bytes": Q.trim_bytes(queue, 0),
        "none": Q.trim_rows(queue, None),
    }
    parts = [df.select(F.lit(name).alias("limit"), "packet_id") for name, df in kept.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
