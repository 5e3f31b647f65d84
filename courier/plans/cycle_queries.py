"""Registered queries that run whole cycles on a stored queue."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from courier.config import Prioritizer
from courier.functions import packets as P
from courier.plans.inputs import DAY_MS, NOW_MS, PRIORITY, TTL_MILLIS, event_packets, event_queue, table
from courier.plans.queue_queries import (
    BATCH_BYTES,
    BATCH_COUNT,
    CLEAN_SQL,
    LIMITS,

    QUEUE_SQL,
    ranked,
    shown,
    status_sql,
)
from courier.plans.registry import query
from courier.plans.service import QueueService, folder_delivery
from courier.plans.transfer_queries import CRC_SQL, FRAME_SQL, manifest_sql
from courier.sources.files import file_packets
from courier.sources.scratch import scratch_path
from courier.sources.store import QueueStore, first_id
from courier.streaming.queue_stream import (
    enqueue_stream,
    expired_packets,
    live_packets,
    process_stream,
)

CONFIG = replace(LIMITS, prioritizer=Prioritizer(PRIORITY, TTL_MILLIS))
STATE = "attributes, content, estimated_size, created, expires, priority, transaction_id"
#: A stored queue gives its own ids: those of a batch follow the order of the events.
NUMBERED_SQL = f"""{QUEUE_SQL},
numbered AS (SELECT packet_id, row_number() OVER (ORDER BY packet_id) AS nth FROM q)"""


def stored_sql(source: str, batch: int, writer: int = 0, state: str = STATE) -> str:
    return f"""SELECT CAST({first_id(writer, batch)} + nth AS BIGINT) AS packet_id, {state}
        FROM {source} JOIN numbered USING (packet_id)"""


#: The writer number of the streams below.
STREAM = 1
BATCH_SQL_TAIL = f"""
b AS (SELECT *, rn <= {BATCH_COUNT} AND before < {BATCH_BYTES} AS taken FROM ({ranked('clean')}))"""
BATCH_SQL = f"{CLEAN_SQL}, {BATCH_SQL_TAIL}"


def _created():
    return P.reference_millis(P.utc_wall_clock(F.col("ts")))


def _service(spark) -> QueueService:
    return QueueService(QueueStore(spark, scratch_path(spark, "queue"), buckets=8).create(), CONFIG)


def _filled(spark, sf_dir) -> QueueService:
    service = _service(spark)
    service.enqueue(
        event_packets(spark, sf_dir), NOW_MS, created=_created(), order_by=["event_id"]
    )
    return service


@query("enqueue_cycle", f"WITH {NUMBERED_SQL}, {CLEAN_SQL} {stored_sql('clean', 0)}")
def enqueue_cycle(spark, sf_dir):
    return shown(_filled(spark, sf_dir).store.queue())


@query("clean_up_cycle", f"WITH {QUEUE_SQL}, {CLEAN_SQL} {status_sql('clean')}")
def clean_up_cycle(spark, sf_dir):
    store = QueueStore(spark, scratch_path(spark, "queue"), buckets=8).create()
    store.append(event_queue(spark, sf_dir), order_by=["packet_id"])
    return QueueService(store, CONFIG).clean_up(NOW_MS)


@query(
    "process_cycle",
    f"WITH {NUMBERED_SQL}, {BATCH_SQL} {stored_sql('b', 0)} WHERE NOT taken",
)
def process_cycle(spark, sf_dir):
    service = _filled(spark, sf_dir)
    service.process(NOW_MS, "tx-1", folder_delivery(scratch_path(spark, "delivered")))
    return shown(service.store.queue())


@query(
    "delivered_manifest",
    f"""WITH {FRAME_SQL}, {CLEAN_SQL}, {BATCH_SQL_TAIL},
        sent AS (SELECT 'tx-1' AS transaction_id, fr.* EXCLUDE (transaction_id)
                 FROM fr JOIN b USING (packet_id) WHERE taken),
        {CRC_SQL}, {manifest_sql('sent')}
        SELECT transaction_id, packets, bytes, checksum FROM m""",
)
def delivered_manifest(spark, sf_dir):
    service = _filled(spark, sf_dir)
    path = scratch_path(spark, "delivered")
    service.process(NOW_MS, "tx-1", folder_delivery(path))
    return spark.read.parquet(f"{path}/manifests").drop("sent_as")


@query(
    "stored_states",
    f"""WITH {NUMBERED_SQL}, a AS (
          SELECT *, rn <= {BATCH_COUNT} AND before < {BATCH_BYTES} AS taken FROM ({ranked('q')})),
        rest AS (SELECT * EXCLUDE (rn, before, taken) FROM a WHERE NOT taken),
        z AS ({ranked('rest')})
        {stored_sql('z', 0, state=STATE.replace(
            'transaction_id', "CASE WHEN rn <= 250 THEN 'tx-3' END AS transaction_id"))}""",
)
def stored_states(spark, sf_dir):
    """Append, assign, release, assign again, acknowledge, compact, assign once more."""
    store = QueueStore(spark, scratch_path(spark, "queue"), buckets=8).create()
    store.append(event_queue(spark, sf_dir), order_by=["packet_id"])
    store.assign("tx-1", BATCH_COUNT, BATCH_BYTES)
    store.release("tx-1")
    store.assign("tx-2", BATCH_COUNT, BATCH_BYTES)
    store.acknowledge("tx-2")
    store.compact()
    store.assign("tx-3", 250, None)
    return shown(store.queue())


# --- streams -----------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return P.from_attributes(
        events,
        F.create_map(
            F.lit("event_type"), F.col("event_type"),
            F.lit("user_id"), F.col("user_id").cast("string"),
        ),
        F.encode("props", "UTF-8"),
        keep=("event_id", "ts", "user_id", "event_type"),
    )


def _drained(writer) -> None:
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()


def _streamed(spark, sf_dir, **options) -> QueueService:
    service = _service(spark)
    _drained(
        enqueue_stream(
            _event_stream(spark, sf_dir),
            service,
            writer=STREAM,
            now=lambda: NOW_MS,
            checkpoint=scratch_path(spark, "stream"),
            created=_created(),
            **options,
        )
    )
    return service


@query("stream_enqueue", f"WITH {NUMBERED_SQL}, {CLEAN_SQL} {stored_sql('clean', 0, STREAM)}")
def stream_enqueue(spark, sf_dir):
    return shown(_streamed(spark, sf_dir).store.queue())


@query("stream_status", f"WITH {QUEUE_SQL}, {CLEAN_SQL}, s AS ({status_sql('clean')}) "
                        "SELECT CAST(0 AS BIGINT) AS batch, * FROM s")
def stream_status(spark, sf_dir):
    path = scratch_path(spark, "status")
    _streamed(spark, sf_dir, status_path=path)
    return spark.read.parquet(path).withColumn("batch", F.col("batch").cast("bigint"))


@query(
    "stream_process",
    f"WITH {NUMBERED_SQL}, {BATCH_SQL} {stored_sql('b', 0, STREAM)} WHERE NOT taken",
)
def stream_process(spark, sf_dir):
    service = _streamed(spark, sf_dir)
    _drained(
        process_stream(
            _event_stream(spark, sf_dir),
            service,
            folder_delivery(scratch_path(spark, "delivered")),
            transaction_id=lambda number: f"tx-{number}",
            now=lambda: NOW_MS,
            checkpoint=scratch_path(spark, "stream"),
        )
    )
    return shown(service.store.queue())


def _stream_rows(spark, sf_dir):
    return P.to_queue_rows(
        _event_stream(spark, sf_dir),
        created=_created(),
        packet_id="event_id",
        prioritizer=CONFIG.prioritizer,
    )


def _written(spark, rows):
    """A stream run to its end into a folder, read back."""
    path = scratch_path(spark, "out")
    _drained(
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "stream"))
    )
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "stream_age_off",
    f"WITH {QUEUE_SQL} SELECT packet_id, {STATE} FROM q WHERE expires >= {NOW_MS}",
)
def stream_age_off(spark, sf_dir):
    return shown(_written(spark, live_packets(_stream_rows(spark, sf_dir), NOW_MS)))


@query(
    "stream_expired",
    f"""WITH {QUEUE_SQL} SELECT packet_id, priority, expires FROM q
        WHERE expires < (SELECT max(created) FROM q)""",
)
def stream_expired(spark, sf_dir):
    rows = _stream_rows(spark, sf_dir)
    return _written(spark, expired_packets(rows, bucket_millis=DAY_MS, shards=4))


#: Lives of zero and less, and some without an end.
SHORT_LIVES = """CASE packet_id % 5 WHEN 0 THEN created WHEN 1 THEN created - 3600000
  WHEN 2 THEN NULL ELSE expires END"""


@query(
    "stream_expired_out_of_order",
    f"""WITH {QUEUE_SQL}, s AS (SELECT * REPLACE ({SHORT_LIVES} AS expires) FROM q)
        SELECT packet_id, priority, expires FROM s WHERE expires < (SELECT max(created) FROM s)""",
)
def stream_expired_out_of_order(spark, sf_dir):
    """A quarter of the packets after the other, the latest first: most rows arrive late."""
    path = scratch_path(spark, "source")
    rows = event_queue(spark, sf_dir).withColumn("expires", F.expr(SHORT_LIVES))
    slim = rows.select("packet_id", "priority", "created", "expires")
    cuts = slim.agg(F.percentile_approx("created", [0.25, 0.5, 0.75])).first()[0] or []
    # The source takes the quarters' files, one a micro-batch, in the order of their writing.
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("created")))
    for number in reversed(range(len(cuts) + 1)):
        slim.where(part == number).write.mode("append").parquet(path)
    stream = (
        spark.readStream.schema(slim.schema).option("maxFilesPerTrigger", 1).parquet(path)
    )
    return _written(spark, expired_packets(stream, bucket_millis=DAY_MS, shards=4))


# --- files ---------------------------------------------------------------------------


@query(
    "file_packets",
    """SELECT CAST(n_nationkey AS BIGINT) AS key, CAST(strlen(n_name) + 1 AS BIGINT) AS declared_length,
         CAST(0 AS INTEGER) AS attribute_count, n_name || chr(10) AS content FROM nation""",
)
def files(spark, sf_dir):
    """A packet per file, from one text file for each nation."""
    path = scratch_path(spark, "files")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    nations.write.partitionBy("n_nationkey").text(path)
    return file_packets(spark, path, "*.txt").select(
        F.regexp_extract("path", "n_nationkey=([0-9]+)", 1).cast("bigint").alias("key"),
        "declared_length",
        F.size("attributes").alias("attribute_count"),
        F.decode("content", "UTF-8").alias("content"),
    )
