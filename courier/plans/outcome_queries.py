"""Registered queries over delivery replies and outcomes.

Replies and outcomes are derived from orders, transaction events from line items.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from courier.functions import urls as U
from courier.functions.packets import utc_wall_clock
from courier.operators import outcomes as O
from courier.plans.inputs import table, user_transactions
from courier.plans.queue_queries import COLUMNS, QUEUE_SQL, shown
from courier.plans.registry import query
from courier.plans.routing_queries import SEQ_SQL

TTL_HEADER = "X-Peer-Server-Transaction-TTL"
CODE_SQL = "CASE o_orderstatus WHEN 'F' THEN 13 WHEN 'P' THEN 14 ELSE 19 END"


def creation_replies(spark, sf_dir):
    """A creation reply per order: some refused, some without intent, some with a bad body."""
    key = F.col("o_orderkey").cast("string")
    intent = F.when(F.col("o_orderpriority") == "5-LOW", "other").otherwise("transaction-url")
    body = F.format_string(
        '{"flowFileSent":0,"responseCode":1,"message":"created:%d"}', F.col("o_orderkey")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.expr("CASE o_orderstatus WHEN 'O' THEN 201 WHEN 'P' THEN 200 ELSE 503 END").alias("status"),
        F.create_map(
            F.lit("Location"), F.concat(F.lit("http://peer:8080/api/transactions/"), key),
            F.lit("x-location-uri-intent"), intent,
            F.lit(TTL_HEADER), F.lit("30"),
            F.lit("other-server-transaction-ttl"), F.lit("99"),
        ).alias("headers"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "not json").otherwise(body).alias("body"),
    )


@query(
    "creation_replies",
    """WITH r AS (SELECT o_orderkey AS request_id, o_orderpriority AS p,
        CASE o_orderstatus WHEN 'O' THEN 201 WHEN 'P' THEN 200 ELSE 503 END AS status FROM orders),
      m AS (SELECT *, status < 300 AND p <> '5-LOW' AS made,
              status < 300 AND p NOT IN ('5-LOW', '1-URGENT') AS told FROM r)
      SELECT request_id, CASE WHEN made THEN CAST(request_id AS VARCHAR) END AS transaction_id,
        CASE WHEN made THEN 'http://peer:8080/api/transactions/' || request_id END AS transaction_url,
        CASE WHEN made THEN CAST(30 AS BIGINT) END AS server_ttl,
        CASE WHEN told THEN CAST(0 AS BIGINT) END AS packets_sent,
        CASE WHEN told THEN CAST(1 AS INTEGER) END AS response_code,
        CASE WHEN told THEN 'created:' || request_id END AS message,
        CASE WHEN made THEN p = '1-URGENT' END AS body_error,
        CASE WHEN status = 503 THEN CAST(1503 AS INTEGER) END AS error_code FROM m""",
)
def parse_creation_replies(spark, sf_dir):
    return O.parse_creation_replies(creation_replies(spark, sf_dir), TTL_HEADER.lower())


def completions(spark, sf_dir):
    """A completion reply per order."""
    body = F.format_string(
        '{"flowFileSent":%d,"responseCode":%d,"message":"%s"}',
        F.col("o_custkey"),
        F.expr(CODE_SQL),
        F.col("o_orderpriority"),
    )
    return O.parse_completion_replies(
        table(spark, sf_dir, "orders").select(
            F.concat(F.lit("tx-"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
            body.alias("body"),
        )
    )


COMPLETIONS_SQL = f"""
done AS (SELECT 'tx-' || o_orderkey AS transaction_id, o_custkey AS packets_transferred,
         CAST({CODE_SQL} AS INTEGER) AS response_code, o_orderpriority AS message,
         TRUE AS readable FROM orders)"""


@query(
    "completion_replies",
    f"""WITH {COMPLETIONS_SQL} SELECT *, response_code = 14 AS back_off FROM done""",
)
def completion_replies(spark, sf_dir):
    return completions(spark, sf_dir).withColumn(
        "back_off", O.should_back_off(F.col("response_code"))
    )


#: Replies with a message, with none, cut short, with other letters, missing, and with odd bytes.
SOCKET_BODIES = (
    "concat(encode('RC', 'UTF-8'), unhex('0D'), unhex('000B'), encode('café ' || mark, 'UTF-8'))",
    "concat(encode('RC', 'UTF-8'), unhex('FA'))",
    "concat(encode('RC', 'UTF-8'), unhex('0E'), unhex('0100'), encode(mark, 'UTF-8'))",
    "encode('CR' || mark, 'UTF-8')",
    "CAST(NULL AS binary)",
    "encode('RC', 'UTF-8')",
)


@query(
    "socket_replies",
    """WITH r AS (SELECT o_orderkey AS k, o_orderkey % 6 AS n,
                  lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS mark FROM orders)
       SELECT 'tx-' || k AS transaction_id, n < 3 AS readable,
         CAST(CASE n WHEN 0 THEN 13 WHEN 1 THEN 250 WHEN 2 THEN 14 END AS INTEGER) AS response_code,
         CASE n WHEN 0 THEN 'café ' || mark WHEN 2 THEN mark END AS message FROM r""",
)
def socket_replies(spark, sf_dir):
    """A socket reply per order."""
    kinds = " ".join(f"WHEN {n} THEN {body}" for n, body in enumerate(SOCKET_BODIES))
    mark = F.lpad((F.col("o_orderkey") % 100000).cast("string"), 5, "0")
    replies = table(spark, sf_dir, "orders").withColumn("mark", mark).select(
        F.concat(F.lit("tx-"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.expr(f"CASE o_orderkey % 6 {kinds} END").alias("body"),
    )
    return O.parse_socket_replies(replies)


@query(
    "described_outcomes",
    f"""WITH {COMPLETIONS_SQL} SELECT *,
        CASE response_code WHEN 13 THEN 'TRANSACTION_FINISHED' WHEN 19 THEN 'BAD_CHECKSUM'
          ELSE 'TRANSACTION_FINISHED_BUT_DESTINATION_FULL' END AS code_name,
        CASE response_code WHEN 13 THEN 'Transaction Finished' WHEN 19 THEN 'Bad Checksum'
          ELSE 'Transaction Finished But Destination is Full' END AS code_description,
        FALSE AS has_message FROM done""",
)
def described_outcomes(spark, sf_dir):
    return O.describe_codes(completions(spark, sf_dir))


@query(
    "total_sent",
    "SELECT CAST(sum(o_custkey) AS BIGINT) AS packets_transferred FROM orders",
)
def total_sent(spark, sf_dir):
    return O.total_sent(completions(spark, sf_dir))


@query(
    "request_statuses",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, status,
        status IN (200, 201) AS created, status IN (200, 202) AS sent,
        status BETWEEN 200 AND 299 AS extended, status = 200 AS was_read,
        1000 + status AS error_code
      FROM (SELECT *, CAST(199 + l_linenumber AS INTEGER) AS status FROM lineitem)""",
)
def request_statuses(spark, sf_dir):
    status = F.col("status")
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("status", (F.col("l_linenumber") + 199).cast("int"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "status",
            U.succeeded("create", status).alias("created"),
            U.succeeded("send", status).alias("sent"),
            U.succeeded("extend", status).alias("extended"),
            U.succeeded("read", status).alias("was_read"),
            U.status_error(status).alias("error_code"),
        )
    )


@query(
    "transfer_durations",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate > o_orderdate AS later,
       (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0::DOUBLE AS duration_seconds
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def transfer_durations(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            (F.col("l_shipdate") > F.col("o_orderdate")).alias("later"),
            U.duration_seconds(
                utc_wall_clock(F.col("o_orderdate")), utc_wall_clock(F.col("l_shipdate"))
            ).alias("duration_seconds"),
        )
    )


STATE_SQL = """CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 3
  WHEN l_returnflag = 'A' THEN 2 WHEN l_returnflag = 'N' THEN 1
  WHEN l_linestatus = 'F' THEN 5 ELSE 0 END"""
STATE_NAME_SQL = f"""CASE {STATE_SQL} WHEN 0 THEN 'TRANSACTION_STARTED' WHEN 1 THEN 'DATA_EXCHANGED'
  WHEN 2 THEN 'TRANSACTION_CONFIRMED' WHEN 3 THEN 'TRANSACTION_COMPLETED'
  WHEN 4 THEN 'TRANSACTION_CANCELED' ELSE 'TRANSACTION_ERROR' END"""


def transaction_events(spark, sf_dir):
    events = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("tx-"), F.col("l_orderkey").cast("string")).alias("transaction_id"),
        F.expr(SEQ_SQL).alias("seq"),
        F.expr(STATE_SQL).alias("state_code"),
    )
    return O.name_states(events)


@query(
    "state_names",
    f"""SELECT 'tx-' || l_orderkey AS transaction_id, {SEQ_SQL} AS seq,
        {STATE_NAME_SQL} AS state FROM lineitem""",
)
def state_names(spark, sf_dir):
    return transaction_events(spark, sf_dir).select("transaction_id", "seq", "state")


@query(
    "latest_states",
    f"""SELECT 'tx-' || l_orderkey AS transaction_id, arg_max({STATE_NAME_SQL}, {SEQ_SQL}) AS state,
        max({SEQ_SQL}) AS seq FROM lineitem GROUP BY l_orderkey""",
)
def latest_states(spark, sf_dir):
    return O.latest_states(transaction_events(spark, sf_dir))


@query(
    "apply_outcomes",
    f"""WITH {QUEUE_SQL},
      last AS (SELECT l_orderkey AS k, arg_max({STATE_NAME_SQL}, {SEQ_SQL}) AS state
               FROM lineitem GROUP BY 1)
      SELECT {COLUMNS} FROM (
        SELECT * REPLACE (CASE WHEN last.state IS NULL THEN 'tx-' || user_id END AS transaction_id)
        FROM q LEFT JOIN last ON user_id = k
        WHERE last.state IS DISTINCT FROM 'TRANSACTION_COMPLETED')""",
)
def apply_outcomes(spark, sf_dir):
    queue = user_transactions(spark, sf_dir)
    return shown(O.apply_outcomes(queue, O.latest_states(transaction_events(spark, sf_dir))))


@query(
    "failure_events",
    f"""SELECT 'http://peer-' || l_orderkey AS url, max(l_extendedprice) AS failed_at
        FROM lineitem GROUP BY l_orderkey
        HAVING arg_max({STATE_NAME_SQL}, {SEQ_SQL}) <> 'TRANSACTION_COMPLETED' """,
)
def failure_events(spark, sf_dir):
    """A failure of its peer for each order whose last state is no completion."""
    prices = table(spark, sf_dir, "lineitem").groupBy(
        F.concat(F.lit("tx-"), F.col("l_orderkey").cast("string")).alias("transaction_id")
    ).agg(F.max("l_extendedprice").alias("failed_at"))
    ended = O.latest_states(transaction_events(spark, sf_dir)).join(prices, "transaction_id")
    return O.failure_events(
        ended.withColumn("url", F.regexp_replace("transaction_id", "^tx-", "http://peer-"))
    )
