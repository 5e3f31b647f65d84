"""The stored queue, its cycles, and the streams that drive them."""

import pytest
from pyspark.sql import functions as F

from courier.config import Prioritizer, QueueConfig
from courier.functions import packets as P
from courier.operators import queue as Q
from courier.plans.service import DeliveryFailed, QueueService, folder_delivery
from courier.sources.store import PACKETS, QueueStore, first_id
from courier.streaming.queue_stream import (
    enqueue_stream,
    expired_packets,
    live_packets,
    process_stream,
)

NOW = 700_000_000_000
CONFIG = QueueConfig(
    max_packets=50, max_bytes=None, batch_packets=4, batch_bytes=None,
    prioritizer=Prioritizer("n % 3", "60000"),
)


@pytest.fixture()
def store(spark, tmp_path):
    return QueueStore(spark, str(tmp_path / "queue"), buckets=2).create()


def packets(spark, low, high):
    return spark.range(low, high).select(
        F.col("id").alias("n"),
        F.create_map(F.lit("n"), F.col("id").cast("string")).alias("attributes"),
        F.encode(F.lit("Test Data"), "UTF-8").alias("content"),
    )


def rows(spark, low, high):
    return P.to_queue_rows(packets(spark, low, high), created=NOW, packet_id=F.lit(0))


def numbers(df):
    """The ``n`` attribute of queue rows, in send order."""
    return [int(r["attributes"][6:-2]) for r in df.orderBy("priority", "created", "packet_id").collect()]


def test_append_keeps_order_across_appends_and_handles(spark, store):
    assert store.queue().isEmpty()
    store.append(rows(spark, 0, 10).repartition(4), order_by=["attributes"])
    other = QueueStore(spark, store.path).create()
    other.append(rows(spark, 10, 20), order_by=["attributes"])
    assert numbers(store.queue()) == list(range(20))
    ids = [r["packet_id"] for r in store.queue().orderBy("packet_id").collect()]
    assert ids == [first_id(0, batch) + row for batch in (0, 1) for row in range(1, 11)]


def test_overlapping_handles_give_no_id_twice(spark, store):
    import threading

    def write(n):
        other = QueueStore(spark, store.path)
        for i in range(2):
            other.append(rows(spark, 10 * n + 5 * i, 10 * n + 5 * i + 5))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    ids = sorted(r["packet_id"] for r in store.queue().collect())
    assert ids == [first_id(0, batch) + row for batch in range(6) for row in range(1, 6)]
    assert sorted(numbers(store.queue())) == list(range(30))


def test_writers_of_two_drivers_share_no_counter(spark, store):
    # Both have looked before either writes, as drivers that know nothing of each other may.
    one, two = (QueueStore(spark, store.path, writer=w) for w in (3, 4))
    states = {s.writer: s._state() for s in (one, two)}
    for handle in (one, two):
        handle._state = lambda writer=None, s=states[handle.writer]: s
        handle.append(rows(spark, handle.writer * 10, handle.writer * 10 + 5))
    ids = [r["packet_id"] for r in store.queue().collect()]
    assert len(ids) == len(set(ids)) == 10
    assert sorted(ids) == [first_id(w, 0) + row for w in (3, 4) for row in range(1, 6)]
    for writer, batch in ((-1, 0), (32, 0), (0, 1 << 26)):
        with pytest.raises(ValueError):
            first_id(writer, batch)


def test_the_latest_event_is_joined_without_a_shuffle(spark, store):
    store.append(rows(spark, 0, 40))
    store.assign("t1", 5, None)
    store.acknowledge("t1")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = store.queue()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in text and "Exchange" not in text and "Bucketed: true" in text


def test_status_and_idle_clean_ups_read_only_summaries(spark, store, monkeypatch):
    store.append(rows(spark, 0, 40))
    store.assign("t1", 5, None)
    store.acknowledge("t1")
    expected = Q.queue_status(store.queue(), CONFIG).first()
    monkeypatch.setattr(store, "_table", None)  # neither table can be opened
    assert store.status(CONFIG).first() == expected
    assert store.clean_up(CONFIG, NOW - 3_600_000) == 0
    with pytest.raises(TypeError):
        store.clean_up(CONFIG, NOW + 10**9)


def test_a_batch_that_was_cut_off_is_completed(spark, store):
    state = store._state()
    there = rows(spark, 0, 2).coalesce(1)
    there = there.withColumn("packet_id", F.monotonically_increasing_id() + first_id(2, 7) + 1)
    store._insert(there, "packets", PACKETS, state)  # without its totals
    assert store.append(rows(spark, 0, 6).coalesce(1), writer=2, batch=7)
    assert numbers(store.queue()) == list(range(6))
    assert store.status(CONFIG).first()["queued_packets"] == 6


def test_null_sizes_and_packets_without_expiry(spark, store):
    odd = rows(spark, 0, 6).withColumn("expires", F.lit(None).cast("bigint"))
    odd = odd.withColumn("estimated_size", F.lit(None).cast("bigint")).withColumn("path", F.lit("x"))
    store.append(odd)
    assert store.clean_up(CONFIG, NOW + 10**12) == 0
    assert store.clean_up(QueueConfig(max_packets=2, max_bytes=None), NOW) == 4
    status = store.status(CONFIG).first()
    assert (status["queued_packets"], status["queued_bytes"], status["average_bytes"]) == (2, 0, 0)
    assert store.acknowledge("nobody") == 0 and store.transaction_kind("nobody") is None


def test_a_replayed_transaction_takes_no_second_batch(spark, store, tmp_path):
    service = QueueService(store, CONFIG)
    service.enqueue(packets(spark, 0, 10), NOW, order_by=["n"])
    deliver = folder_delivery(str(tmp_path / "out"))
    store.assign("t0", 4, None)  # as after a crash before the acknowledgement
    for _ in range(2):
        service.process(NOW, "t0", deliver)
    sent = spark.read.parquet(str(tmp_path / "out/manifests")).collect()
    assert [(r["transaction_id"], r["packets"]) for r in sent] == [("t0", 4)]
    assert store.queue().count() == 6
    with pytest.raises(DeliveryFailed):
        service.process(NOW, "t1", lambda batch, _: "TRANSACTION_ERROR")
    service.process(NOW, "t1", deliver)  # a failed one may be tried again
    assert store.queue().count() == 2


def test_missing_queue(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        QueueStore(spark, str(tmp_path / "none")).queue()


def test_states(spark, store):
    store.append(rows(spark, 0, 10))
    assert store.assign("t1", 5, None) == 5
    assert numbers(store.packets("t1")) == [0, 1, 2, 3, 4]
    assert store.assign("t2", 10, None) == 5
    assert store.assign("t3", 10, None) == 0
    assert store.acknowledge("t1") == 5 and store.queue().count() == 5
    assert store.release("t2") == 5 and store.release("t2") == 0
    store.compact()
    assert store.assign("t4", 2, None) == 2
    assert numbers(store.packets("t4")) == [5, 6]
    assert numbers(Q.unassigned(store.queue())) == [7, 8, 9]
    store.append(rows(spark, 10, 12))
    assert numbers(store.queue()) == [5, 6, 7, 8, 9, 10, 11]


def test_a_failed_write_changes_nothing(spark, store):
    store.append(rows(spark, 0, 3))
    state = store._state()
    bad = rows(spark, 3, 6).withColumn("content", F.raise_error(F.lit("broken")).cast("binary"))
    with pytest.raises(Exception, match="broken"):
        store.append(bad)
    assert store._state() == state and numbers(store.queue()) == [0, 1, 2]


def test_a_batch_is_appended_once(spark, store):
    assert store.append(rows(spark, 0, 3), writer=1, batch=0)
    assert not store.append(rows(spark, 0, 3), writer=1, batch=0)
    store.compact()
    assert not store.append(rows(spark, 0, 3), writer=1, batch=0)
    assert store.append(rows(spark, 3, 4), writer=1, batch=2)
    assert store.queue().count() == 4


def test_what_compaction_keeps(spark, store):
    store.append(rows(spark, 0, 6))
    store.assign("done", 2, None)
    store.acknowledge("done")
    store.assign("open", 2, None)
    before = store.queue().orderBy("packet_id").collect()
    store.compact()
    assert store.queue().orderBy("packet_id").collect() == before
    assert [store.transaction_kind(t) for t in ("done", "open", "new")] == ["ended", "open", None]
    assert numbers(store.packets("open")) == [2, 3]
    assert store.status(CONFIG).first()["queued_packets"] == 4
    assert store.acknowledge("open") == 2 and numbers(store.queue()) == [4, 5]


def test_clean_up(spark, store):
    store.append(rows(spark, 0, 10))
    assert store.clean_up(QueueConfig(max_packets=4), NOW) == 6
    assert numbers(store.queue()) == [0, 1, 2, 3]
    assert store.clean_up(QueueConfig(), NOW + 1001) == 4


def test_a_clean_up_holds_for_earlier_packets_only(spark, store):
    store.append(rows(spark, 0, 10))
    assert store.clean_up(QueueConfig(max_packets=4), NOW) == 6
    store.append(rows(spark, 10, 15))  # behind the cut, but added after it
    assert numbers(store.queue()) == [0, 1, 2, 3, 10, 11, 12, 13, 14]
    assert store.clean_up(QueueConfig(max_packets=8), NOW) == 1
    assert store.clean_up(QueueConfig(max_packets=8), NOW) == 0
    assert numbers(store.queue()) == [0, 1, 2, 3, 10, 11, 12, 13]
    store.assign("t", 2, None)
    protected = QueueConfig(max_packets=0, protect_in_flight=True)
    assert store.clean_up(protected, NOW + 2000) == 6
    assert numbers(store.queue()) == [0, 1]
    store.append(rows(spark, 20, 22))
    store.compact()
    store.append(rows(spark, 30, 31))
    assert numbers(store.queue()) == [0, 1, 20, 21, 30]
    assert store.clean_up(QueueConfig(), NOW + 5000) == 5
    assert store.queue().isEmpty()


def test_cycles(spark, store, tmp_path):
    service = QueueService(store, CONFIG)
    status = service.enqueue(packets(spark, 0, 60), NOW, order_by=["n"]).first()
    assert status["queued_packets"] == 50 and status["is_full"]
    assert numbers(store.queue())[:3] == [0, 3, 6]
    status = service.process(NOW, "t1", folder_delivery(str(tmp_path / "out"))).first()
    assert status["queued_packets"] == 46
    assert spark.read.parquet(str(tmp_path / "out/manifests")).first()["packets"] == 4
    assert numbers(store.queue())[:2] == [12, 15]

    with pytest.raises(DeliveryFailed):
        service.process(NOW, "t2", lambda batch, _: "TRANSACTION_ERROR")
    assert Q.unassigned(store.queue()).count() == 46

    def broken(batch, _):
        raise OSError("unreachable")

    with pytest.raises(OSError):
        service.process(NOW, "t3", broken)
    assert Q.unassigned(store.queue()).count() == 46

    never = []
    status = service.process(NOW + 60_001, "t4", lambda batch, _: never.append(1)).first()
    assert status["queued_packets"] == 0 and not never


def drained(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def stream(spark, folder):
    schema = packets(spark, 0, 1).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_streams(spark, store, tmp_path):
    source, status = str(tmp_path / "in"), str(tmp_path / "status")
    for low in (0, 20, 40):
        packets(spark, low, low + 20).coalesce(1).write.mode("append").parquet(source)
    service = QueueService(store, CONFIG)

    def fill(checkpoint):
        drained(
            enqueue_stream(
                stream(spark, source), service, writer=1, now=lambda: NOW,
                checkpoint=str(tmp_path / checkpoint), status_path=status,
            )
        )

    fill("a")
    first = numbers(store.queue())
    assert len(first) == 50
    fill("b")  # a lost checkpoint replays the batches under their old numbers
    assert numbers(store.queue()) == first
    counts = [r["queued_packets"] for r in spark.read.parquet(status).orderBy("batch").collect()]
    assert counts == [50, 50, 50]  # a replay's status takes the place of the first

    drained(
        process_stream(
            stream(spark, source), service, folder_delivery(str(tmp_path / "out")),
            transaction_id=lambda n: f"t{n}", now=lambda: NOW, checkpoint=str(tmp_path / "c"),
        )
    )
    assert store.queue().count() == 50 - 3 * 4
    sent = spark.read.parquet(str(tmp_path / "out/manifests")).collect()
    assert sorted(r["transaction_id"] for r in sent) == ["t0", "t1", "t2"]


def test_live_packets(queue_rows):
    queue = queue_rows([(1, 1, 0, 0, 0, None), (2, 1, 0, None, 0, None), (3, 1, 0, 2**60, 0, None)])
    assert sorted(r["packet_id"] for r in live_packets(queue).collect()) == [2, 3]


def queue_stream_rows(spark, folder, table):
    """Queue rows (packet_id, priority, created, expires) as a stream, a micro-batch a list."""
    schema = "packet_id bigint, priority bigint, created bigint, expires bigint"
    for batch in table:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("bucket_millis", [10, 100_000])
def test_expired_packets_come_out_once(spark, tmp_path, bucket_millis):
    first = [(i, None if i % 3 else 2**60 + i, 1000, 1000 + 7 * i) for i in range(40)]
    table = [
        first,
        [(100, 1, 1100, 5000), (101, 1, 10, 20), (102, 1, 1100, None), (103, 1, 1100, 1100)],
        [(3, 1, 1200, 1150), (104, None, 500, 1250), (105, 1, None, 1199), (0, 1, 1190, 1190)],
        [(106, 1, 1250, 1300)],
    ]
    out = str(tmp_path / "out")
    expired = expired_packets(
        queue_stream_rows(spark, str(tmp_path / "in"), table), bucket_millis=bucket_millis, shards=2
    )
    drained(
        expired.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
    )
    got = sorted(map(tuple, spark.read.parquet(out).collect()), key=repr)
    every = [r for batch in table for r in batch]
    assert got == sorted(((i, p, e) for i, p, c, e in every if e is not None and e < 1250), key=repr)
