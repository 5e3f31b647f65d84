"""Registered queries over transfer frames and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from courier.functions.frames import frame, frame_length
from courier.operators import outcomes as O
from courier.operators import transfer as T
from courier.plans.inputs import event_packets, user_transactions
from courier.plans.queue_queries import ORDER, QUEUE_SQL
from courier.plans.registry import query
from courier.sources.scratch import materialise

FRAME_SQL = f"""{QUEUE_SQL},
fr AS (
  SELECT packet_id, 'tx-' || CAST(user_id AS VARCHAR) AS transaction_id, priority, created,
    '00000002' || printf('%08X', strlen('event_type')) || hex('event_type')
    || printf('%08X', strlen(event_type)) || hex(event_type)
    || printf('%08X', strlen('user_id')) || hex('user_id')
    || printf('%08X', strlen(CAST(user_id AS VARCHAR))) || hex(CAST(user_id AS VARCHAR))
    || printf('%016X', strlen(content)) || hex(content) AS frame_hex
  FROM q)"""

#: Table-driven CRC-32 of a hex text, in SQL.
CRC_SQL = """
crc_bits AS (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_bits)"""


def crc_sql(hex_text: str) -> str:
    """Expression over ``crc_table`` for the CRC-32 of the bytes that ``hex_text`` spells."""
    return f"""xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT),
        [CAST(('0x' || substr({hex_text}, CAST(2 * k + 1 AS INTEGER), 2)) AS BIGINT)
         FOR k IN range(length({hex_text}) // 2)]),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])))"""


@query("frames", f"WITH {FRAME_SQL} SELECT packet_id, frame_hex FROM fr")
def frames(spark, sf_dir):
    rows = T.frames(user_transactions(spark, sf_dir))
    return rows.select("packet_id", F.hex("frame").alias("frame_hex"))


@query(
    "direct_send_frames",
    f"""WITH {FRAME_SQL} SELECT packet_id AS event_id, length(frame_hex) // 2 AS frame_bytes,
        frame_hex FROM fr""",
)
def direct_send_frames(spark, sf_dir):
    rows = event_packets(spark, sf_dir)
    return rows.select(
        "event_id",
        frame_length(F.col("attributes"), F.col("content")).alias("frame_bytes"),
        F.hex(frame(F.col("attributes"), F.col("content"))).alias("frame_hex"),
    )


SOCKET_SQL = f"""{FRAME_SQL},
so AS (SELECT transaction_id, packet_id, priority, created,
         CASE WHEN row_number() OVER (PARTITION BY transaction_id ORDER BY {ORDER}) > 1
              THEN '52430A' ELSE '' END || frame_hex AS frame_hex FROM fr)"""


@query("socket_frames", f"WITH {SOCKET_SQL} SELECT packet_id, frame_hex FROM so")
def socket_frames(spark, sf_dir):
    rows = T.socket_frames(user_transactions(spark, sf_dir))
    return rows.select("packet_id", F.hex("frame").alias("frame_hex"))


def manifest_sql(source: str) -> str:
    return f"""tx AS (SELECT transaction_id, count(*) AS packets,
        string_agg(frame_hex, '' ORDER BY {ORDER}) AS payload FROM {source} GROUP BY 1),
    m AS (SELECT transaction_id, packets, length(payload) // 2 AS bytes,
        {crc_sql('payload')} AS checksum FROM tx, crc_table)"""


@query(
    "transfer_manifest",
    f"""WITH {FRAME_SQL}, {CRC_SQL}, {manifest_sql('fr')}
        SELECT transaction_id, packets, bytes, checksum FROM m""",
)
def transfer_manifest(spark, sf_dir):
    return T.manifest(user_transactions(spark, sf_dir))


@query(
    "socket_manifest",
    f"""WITH {SOCKET_SQL}, {CRC_SQL}, {manifest_sql('so')}
        SELECT transaction_id, packets, bytes, checksum FROM m""",
)
def socket_manifest(spark, sf_dir):
    return T.manifest(user_transactions(spark, sf_dir), socket=True)


@query(
    "check_checksums",
    f"""WITH {FRAME_SQL}, {CRC_SQL}, {manifest_sql('fr')}
        SELECT transaction_id, checksum, server_checksum,
          CASE WHEN checksum = server_checksum THEN 12 ELSE 19 END AS response_code
        FROM (SELECT *, CASE WHEN packets % 7 = 0 THEN -1 WHEN packets % 7 = 1 THEN NULL
                WHEN packets % 5 = 0 THEN xor(checksum, 1) ELSE checksum END
                AS server_checksum FROM m)""",
)
def check_checksums(spark, sf_dir):
    sent = T.manifest(user_transactions(spark, sf_dir))
    return T.check_checksums(sent, O.parse_send_replies(send_replies(sent))).select(
        "transaction_id", "checksum", "server_checksum", "response_code"
    )


def send_replies(sent):
    """A reply per transaction: some with a wrong bit, some refused, and some not there."""
    packets = F.col("packets")
    answer = F.when(packets % 5 == 0, F.col("checksum").bitwiseXOR(F.lit(1))).otherwise(
        F.col("checksum")
    )
    return sent.where(packets % 7 != 1).select(
        "transaction_id",
        F.when(packets % 7 == 0, 503).when(packets % 2 == 0, 200).otherwise(202).alias("status"),
        F.concat(answer.cast("string"), F.lit(" ok")).alias("body"),
    )


REPLIES_SQL = """
replies AS (SELECT *, CASE WHEN packets % 7 = 0 THEN -1 WHEN packets % 5 = 0
    THEN xor(checksum, 1) ELSE checksum END AS server_checksum FROM m WHERE packets % 7 <> 1)"""


@query(
    "send_replies",
    f"""WITH {FRAME_SQL}, {CRC_SQL}, {manifest_sql('fr')}, {REPLIES_SQL}
        SELECT transaction_id, server_checksum,
          CASE WHEN packets % 7 = 0 THEN 1503 END::INTEGER AS error_code FROM replies""",
)
def parse_send_replies(spark, sf_dir):
    return O.parse_send_replies(send_replies(T.manifest(user_transactions(spark, sf_dir))))


RESULTS_SQL = f"""{REPLIES_SQL},
results AS (
  SELECT transaction_id,
    CASE WHEN good AND packets % 11 <> 0 THEN 'TRANSACTION_COMPLETED' ELSE 'TRANSACTION_ERROR' END
      AS state,
    CAST(CASE WHEN NOT good THEN 19 WHEN packets % 11 <> 0 AND packets % 4 <> 1 THEN 13 END
      AS INTEGER) AS response_code,
    CASE WHEN good AND packets % 11 <> 0 AND packets % 4 <> 2 THEN packets ELSE 0 END
      AS packets_transferred,
    CASE WHEN good AND packets % 11 <> 0 AND packets % 4 <> 3 THEN 'done' END AS message
  FROM (SELECT m.*, coalesce(r.server_checksum = m.checksum, FALSE) AS good
        FROM m LEFT JOIN replies r USING (transaction_id)))"""


def results(spark, sf_dir):
    """Manifests, the replies to them, and completion replies: broken ones, and without a field."""
    sent = T.manifest(user_transactions(spark, sf_dir))
    checked = T.check_checksums(sent, O.parse_send_replies(send_replies(sent)))
    lacks = F.col("packets") % 4
    fields = F.struct(
        F.when(lacks != 2, F.col("packets")).alias("flowFileSent"),
        F.when(lacks != 1, F.lit(13)).alias("responseCode"),
        F.when(lacks != 3, F.lit("done")).alias("message"),
    )
    body = F.when(F.col("packets") % 11 == 0, F.lit("{")).otherwise(F.to_json(fields))
    ended = O.parse_completion_replies(sent.select("transaction_id", body.alias("body")))
    return O.transaction_results(checked, ended)


@query(
    "transaction_results",
    f"WITH {FRAME_SQL}, {CRC_SQL}, {manifest_sql('fr')}, {RESULTS_SQL} SELECT * FROM results",
)
def transaction_results(spark, sf_dir):
    return results(spark, sf_dir)


@query(
    "results_to_queue",
    f"""WITH {FRAME_SQL}, {CRC_SQL}, {manifest_sql('fr')}, {RESULTS_SQL}
        SELECT packet_id, CAST(NULL AS VARCHAR) AS transaction_id FROM fr JOIN results USING (transaction_id)
        WHERE state <> 'TRANSACTION_COMPLETED'""",
)
def results_to_queue(spark, sf_dir):
    """Replies to results to the queue: what did not complete is free again."""
    after = O.apply_outcomes(user_transactions(spark, sf_dir), results(spark, sf_dir))
    return after.select("packet_id", "transaction_id")


DAMAGED_SQL = f"""{FRAME_SQL},
bad AS (
  SELECT packet_id, transaction_id, priority, created, packet_id % 4 = 1 AS unreadable,
    CASE WHEN packet_id % 4 = 3 THEN frame_hex
      ELSE '00000000' || substr(frame_hex, length(frame_hex) - 2 * n - 15) END AS frame_hex
  FROM fr JOIN (SELECT packet_id, strlen(content) AS n FROM q) USING (packet_id))"""


def damaged(spark, sf_dir):
    """Packets in flight whose attributes are missing, no JSON, empty, or sound."""
    number = F.col("packet_id") % 4
    attributes = (
        F.when(number == 1, F.lit("no json"))
        .when(number == 2, F.lit("{}"))
        .when(number == 3, F.col("attributes"))
    )
    return user_transactions(spark, sf_dir).withColumn("attributes", attributes)


@query("damaged_frames", f"WITH {DAMAGED_SQL} SELECT packet_id, unreadable, frame_hex FROM bad")
def damaged_frames(spark, sf_dir):
    rows = damaged(spark, sf_dir)
    marks = rows.select("packet_id", T.unreadable(F.col("attributes")).alias("unreadable"))
    return T.frames(rows).join(marks, "packet_id").select(
        "packet_id", "unreadable", F.hex("frame").alias("frame_hex")
    )


@query(
    "socket_results",
    f"""WITH {SOCKET_SQL}, {CRC_SQL}, {manifest_sql('so')},
        r AS (SELECT *, CASE WHEN packets % 5 = 0 THEN 19 WHEN packets % 5 = 1 THEN NULL ELSE 12 END
                AS first, packets % 7 <> 0 AS second FROM m)
        SELECT transaction_id,
          CASE WHEN first = 12 AND second THEN 'TRANSACTION_COMPLETED' ELSE 'TRANSACTION_ERROR' END
            AS state,
          CAST(CASE WHEN first <> 12 THEN first WHEN first = 12 AND second THEN 14 END AS INTEGER)
            AS response_code,
          CASE WHEN first = 12 AND second THEN packets ELSE 0 END AS packets_transferred,
          CASE WHEN first = 12 AND second THEN 'ok' END AS message FROM r""",
)
def socket_results(spark, sf_dir):
    """Confirmations with other codes, or that cannot be read, and answers to them."""
    sent = materialise(T.manifest(user_transactions(spark, sf_dir), socket=True), "socket-manifest")
    first = F.expr(
        """CASE packets % 5 WHEN 0 THEN unhex('524313') WHEN 1 THEN unhex('524B0C')
           ELSE concat(unhex('52430C000A'), encode(lpad(checksum, 10, '0'), 'UTF-8')) END"""
    )
    second = F.expr("CASE WHEN packets % 7 <> 0 THEN unhex('52430E00026F6B') ELSE unhex('5243') END")
    replies = [
        O.parse_socket_replies(sent.select("transaction_id", body.alias("body")))
        for body in (first, second)
    ]
    return O.socket_results(sent, *replies)


@query(
    "damaged_manifest",
    f"""WITH {DAMAGED_SQL}, {CRC_SQL}, {manifest_sql('bad')}
        SELECT transaction_id, packets, bytes, checksum FROM m""",
)
def damaged_manifest(spark, sf_dir):
    return T.manifest(damaged(spark, sf_dir))


@query(
    "small_chunk_manifest",
    f"""WITH {FRAME_SQL}, {CRC_SQL}, {manifest_sql('fr')}
        SELECT transaction_id, packets, bytes, checksum FROM m""",
)
def small_chunk_manifest(spark, sf_dir):
    """Transactions that span several range partitions."""
    return T.manifest(user_transactions(spark, sf_dir), partitions=16)
