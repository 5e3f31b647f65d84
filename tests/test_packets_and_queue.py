"""Packets, queue rows, states and status."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from courier.config import Prioritizer, QueueConfig
from courier.functions import packets as P
from courier.operators import queue as Q
from courier.schema import QUEUE_COLUMNS
from courier.sources.files import file_packets

NOW = 500_000_000_000


def one(df):
    (row,) = df.collect()
    return row


def ids(df):
    return sorted(r["packet_id"] for r in df.collect())


@pytest.fixture(scope="module")
def seed(spark):
    return spark.createDataFrame(
        [(1, {"key1": "value1", "a": "b"}, bytearray(b"Test"))],
        "n int, attributes map<string,string>, content binary",
    ).cache()


def equal_packets(spark, n, content=b"Test Data", ttl="60000"):
    """``n`` equal packets as queue rows, enqueued at NOW."""
    rows = spark.range(1, n + 1).select(
        F.col("id"),
        F.create_map(F.lit("key"), F.lit("value")).alias("attributes"),
        F.lit(bytearray(content)).alias("content"),
    )
    return P.to_queue_rows(rows, created=NOW, packet_id="id", prioritizer=Prioritizer("0", ttl))


# --- packets -------------------------------------------------------------------------


def test_packet_without_content(seed):
    row = one(P.from_attributes(seed, F.col("attributes")))
    assert row["attributes"] == {"key1": "value1", "a": "b"}
    assert row["content"] is None and row["declared_length"] == 0


def test_packet_with_bytes(seed):
    row = one(P.from_attributes(seed, F.col("attributes"), F.col("content")))
    assert bytes(row["content"]) == b"Test" and row["declared_length"] == 4


def test_packet_from_text(seed):
    row = one(P.from_text(seed, F.lit("Tést")))
    assert row["attributes"] == {} and bytes(row["content"]) == "Tést".encode()
    assert row["declared_length"] == 5


def test_declared_length_is_checked(seed):
    right = one(P.from_declared(seed, F.col("attributes"), F.col("content"), F.lit(4)))
    wrong = one(P.from_declared(seed, F.col("attributes"), F.col("content"), F.lit(9)))
    none = one(P.from_declared(seed, F.col("attributes"), F.col("content"), F.lit(0)))
    assert not right["length_mismatch"] and wrong["length_mismatch"]
    assert none["content"] is None and not none["length_mismatch"]


def test_packets_from_files(spark, tmp_path):
    (tmp_path / "full.bin").write_bytes(b"\x00\x01\x02\x03")
    (tmp_path / "empty.bin").write_bytes(b"")
    row = one(file_packets(spark, str(tmp_path)))
    assert row["path"].endswith("full.bin") and row["attributes"] == {}
    assert bytes(row["content"]) == b"\x00\x01\x02\x03" and row["declared_length"] == 4


def test_set_attribute(seed):
    def after(key, value):
        return one(seed.select(P.set_attribute(F.col("attributes"), key, value).alias("m")))["m"]

    assert after("new", "x") == {"key1": "value1", "a": "b", "new": "x"}
    assert after("a", "c") == {"key1": "value1", "a": "c"}
    assert after("a", None) == {"key1": "value1"}
    assert after("a", F.lit(None).cast("string")) == {"key1": "value1"}


def test_device_packet_escapes_its_payload(seed):
    fields = {name: F.lit(f"{name} value") for name in P.DEVICE_FIELDS}
    fields["userName"] = F.lit('Jo "the phone" X')
    row = one(P.device_packets(seed, fields))
    payload = json.loads(bytes(row["content"]))
    assert list(payload) == list(P.DEVICE_FIELDS) and payload == row["attributes"]


def test_event_time_and_address(seed):
    ts = F.lit(datetime.datetime(2024, 3, 5, 4, 6, 7)).cast("timestamp_ntz")
    null = F.lit(None).cast("string")
    row = one(
        seed.select(
            P.event_time_text(ts).alias("t"),
            P.address_line(null, F.lit("Main St"), F.lit("X"), null, F.lit("123")).alias("a"),
            P.address_line(null, null, null, null, null).alias("none"),
        )
    )
    assert (row["t"], row["a"], row["none"]) == ("2024-3-5 4:6:7", "Main St, X, 123 ", "")


# --- queue rows ----------------------------------------------------------------------


def test_queue_row_round_trip(spark):
    packets = spark.createDataFrame(
        [({"key1": "value1"}, bytearray(b"Test Data"), 7)],
        "attributes map<string,string>, content binary, id int",
    )
    queue = P.to_queue_rows(
        packets, created=NOW, packet_id="id", prioritizer=Prioritizer("id * 2", "600")
    )
    row = one(queue)
    assert list(row.asDict()) == QUEUE_COLUMNS
    assert row["attributes"] == '{"key1":"value1"}'
    assert row["estimated_size"] == len('{"key1":"value1"}') + 9
    assert (row["created"], row["expires"], row["priority"]) == (NOW, NOW + 600, 14)
    assert row["transaction_id"] is None
    back = one(P.to_packets(queue))
    assert back["attributes"] == {"key1": "value1"} and bytes(back["content"]) == b"Test Data"


def test_attributes_are_written_in_key_order(spark):
    maps = spark.createDataFrame([({"b": "2", "a": "1"},), ({"a": "1", "b": "2"},)], "m map<string,string>")
    texts = {r[0] for r in maps.select(P.attributes_json(F.col("m"))).collect()}
    assert texts == {'{"a":"1","b":"2"}'}


def test_unreadable_attributes_give_no_packet_map(spark):
    rows = spark.createDataFrame([(None,), ("{bad",), ('{"a":"b"}',)], "j string")
    maps = [r[0] for r in rows.select(P.parse_attributes(F.col("j"))).collect()]
    assert maps == [{}, None, {"a": "b"}]


def test_default_prioritizer(spark, seed):
    row = one(P.to_queue_rows(seed, created=NOW, packet_id="n"))
    assert (row["priority"], row["expires"]) == (0, NOW + 1000)
    row = one(P.to_queue_rows(seed, created=NOW, packet_id="n", prioritizer=Prioritizer.fixed_ttl(0)))
    assert row["expires"] == NOW
    assert Prioritizer.fixed_ttl(1.9999).ttl_millis == "1999"


def test_clock_does_not_depend_on_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.sql("SELECT TIMESTAMP_NTZ'2001-01-01 00:00:01.2345' AS ts")
            got = one(df.select(P.reference_millis(P.utc_wall_clock(F.col("ts"))).alias("m")))
            assert got["m"] == 1234
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- states --------------------------------------------------------------------------


def test_age_off_is_strict(queue_rows):
    queue = queue_rows([(1, 5, 0, 99, 0, None), (2, 5, 0, 100, 0, None), (3, 5, 0, None, 0, None)])
    assert ids(Q.age_off(queue, 100)) == [2, 3]


def test_trim_two_packets(spark):
    queue = equal_packets(spark, 2)
    size = one(queue.limit(1))["estimated_size"]
    assert Q.trim_rows(queue, 3).count() == 2
    assert Q.trim_rows(queue, 1).count() == 1
    assert Q.trim_bytes(queue, size).count() == 1


def test_batches_by_count(spark):
    queue = Q.assign(equal_packets(spark, 10), "t1", 5, 0)
    assert Q.transaction_packets(queue, "t1").count() == 5
    queue = Q.assign(Q.acknowledge(queue, "t1"), "t2", 10, 0)
    assert queue.count() == 5 and Q.transaction_packets(queue, "t2").count() == 5
    assert Q.unassigned(queue).isEmpty()
    queue = Q.assign(Q.release(queue, "t2"), "t3", 100, 0)
    assert ids(Q.transaction_packets(queue, "t3")) == [6, 7, 8, 9, 10]
    assert Q.acknowledge(queue, "t3").isEmpty()


def test_batches_by_bytes(spark):
    queue = equal_packets(spark, 10)
    size = one(queue.limit(1))["estimated_size"]
    assert Q.batch(queue, 0, 5 * size).count() == 5
    assert Q.batch(queue, 0, 5 * size + 1).count() == 6
    assert Q.batch(queue, 0, 2**63 - 1).count() == 10


def test_ten_thousand_packets_in_one_batch(spark):
    queue = Q.assign(equal_packets(spark, 10_000), "t", 0, 0)
    assert Q.transaction_packets(queue, "t").count() == 10_000


def test_send_order_has_nulls_first(queue_rows):
    queue = queue_rows(
        [(1, 1, 5, 0, 1, None), (2, 1, 5, 0, None, None), (3, 1, None, 0, 1, None), (4, 1, 5, 0, 0, None)]
    )
    assert [r["packet_id"] for r in Q.in_send_order(queue).collect()] == [2, 4, 3, 1]


def test_clean_up_order_and_protection(queue_rows):
    rows = [(i, 10, i, 200, i % 3, None) for i in range(1, 10)] + [(10, 10, 0, 50, 0, None)]
    queue = queue_rows(rows + [(11, 10, 0, 50, 9, "t")])
    config = QueueConfig(max_packets=6, max_bytes=35)
    # 10 and 11 expire; of the rest 3, 6, 9 (priority 0) and 1 reach 35 bytes
    assert ids(Q.clean_up(queue, config, 100)) == [1, 3, 6, 9]
    assert ids(Q.cleaned_away(queue, config, 100)) == [2, 4, 5, 7, 8, 10, 11]
    kept = ids(Q.clean_up(queue, QueueConfig(max_packets=6, max_bytes=35, protect_in_flight=True), 100))
    assert 11 in kept and 10 not in kept
    assert ids(Q.clean_up(queue, QueueConfig(max_packets=None, max_bytes=None), 0)) == list(range(1, 12))
    assert ids(Q.clean_up(queue, QueueConfig(max_packets=0), 0)) == []


def test_removed_kept_and_changed(queue_rows):
    before = queue_rows([(i, 1, 0, 0, 0, "t" if i < 3 else None) for i in range(5)])
    after = Q.assign(Q.acknowledge(before, "t"), "u", 1, 0)
    assert ids(Q.removed(before, after)) == [0, 1, 2]
    assert ids(Q.kept(before, after)) == [3, 4]
    assert one(Q.changed_rows(before, after)).asDict() == {"removed": 3, "added": 0, "updated": 1}


def test_assign_by_id(spark, queue_rows):
    queue = queue_rows([(1, 1, 0, 0, 0, None), (2, 1, 0, 0, 0, "old")])
    chosen = spark.createDataFrame([(1, "new")], "packet_id bigint, transaction_id string")
    got = {r["packet_id"]: r["transaction_id"] for r in Q.assign_ids(queue, chosen).collect()}
    assert got == {1: "new", 2: "old"}


@pytest.mark.parametrize(
    "limits, full",
    [
        ((3, None), True),   # count reached
        ((4, None), False),
        ((None, 40), True),  # 30 >= 40 - 10
        ((None, 41), False),
        ((0, 0), False),     # both off
        ((None, 5), True),   # the average is above the limit
        ((100, 40), True),
    ],
)
def test_is_full(queue_rows, limits, full):
    queue = queue_rows([(i, 10, 0, 0, 0, None) for i in range(3)])
    config = QueueConfig(max_packets=limits[0], max_bytes=limits[1])
    assert one(Q.queue_status(queue, config))["is_full"] is full


def test_status_numbers(queue_rows):
    queue = queue_rows([(1, 10, 0, 0, 0, None), (2, 5, 0, 0, 0, "t"), (3, None, 0, 0, 0, None)])
    row = one(Q.queue_status(queue, QueueConfig(max_packets=6)))
    assert (row["queued_packets"], row["queued_bytes"], row["average_bytes"]) == (3, 15, 7)
    assert row["capacity_fraction"] == 0.5
    empty = one(Q.queue_status(queue_rows([]), QueueConfig()))
    assert (empty["queued_packets"], empty["queued_bytes"], empty["average_bytes"]) == (0, 0, 0)
    assert not empty["is_full"]


def test_transaction_totals(queue_rows):
    queue = queue_rows([(1, 1, 0, 0, 0, "t"), (2, 1, 0, 0, 0, "t"), (3, 1, 0, 0, 0, None)])
    assert one(Q.transaction_totals(queue)).asDict() == {
        "transaction_id": "t", "packets": 2, "content_bytes": 2,
    }
