"""Frames and manifests against struct and zlib."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from courier.functions.frames import shift_checksums
from courier.operators import transfer as T
from courier.schema import QUEUE_SCHEMA
from courier.sources.files import deliver_to_folder


def framed(attributes, content):
    out = struct.pack(">i", len(attributes))
    for key in sorted(attributes):
        for text in (key.encode(), attributes[key].encode()):
            out += struct.pack(">i", len(text)) + text
    return out + struct.pack(">q", len(content or b"")) + (content or b"")


def text_of(attributes):
    return "{" + ",".join(f'"{k}":"{v}"' for k, v in sorted(attributes.items())) + "}"


@pytest.fixture(scope="module")
def packets():
    r = random.Random(3)
    found = []
    for i in range(240):
        attributes = {r.choice(["k", "ключ", "z"]) + str(j): "ü" * r.randrange(4) for j in range(r.randrange(4))}
        content = r.choice([None, b"", bytes(r.randrange(256) for _ in range(r.randrange(60)))])
        transaction = "hot" if i % 3 else r.choice(["a", "b", "c", None])
        found.append((i, attributes, content, r.randrange(3), r.randrange(4), transaction))
    return found


@pytest.fixture(scope="module")
def queue(spark, packets):
    rows = [
        (i, text_of(a), c, 0, created, 0, priority, t) for i, a, c, created, priority, t in packets
    ]
    return spark.createDataFrame(rows, QUEUE_SCHEMA).repartition(4).cache()


def payloads(packets, marker=b""):
    found = {}
    for p in sorted((p for p in packets if p[5]), key=lambda p: (p[4], p[3], p[0])):
        earlier = found.get(p[5])
        body = framed(p[1], p[2])
        found[p[5]] = body if earlier is None else earlier + marker + body
    return found


def test_frames(queue, packets):
    expected = {p[0]: framed(p[1], p[2]) for p in packets if p[5]}
    assert {r["packet_id"]: bytes(r["frame"]) for r in T.frames(queue).collect()} == expected


@pytest.mark.parametrize("partitions", [7, None])
@pytest.mark.parametrize("socket", [False, True])
def test_manifest(queue, packets, socket, partitions):
    expected = {
        t: (sum(1 for p in packets if p[5] == t), len(body), zlib.crc32(body))
        for t, body in payloads(packets, b"RC\n" if socket else b"").items()
    }
    found = T.manifest(queue, socket=socket, partitions=partitions).collect()
    assert {r["transaction_id"]: (r["packets"], r["bytes"], r["checksum"]) for r in found} == expected


def test_socket_frames(queue, packets):
    rows = T.socket_frames(queue).orderBy("priority", "created", "packet_id").collect()
    found = {}
    for r in rows:
        found[r["transaction_id"]] = found.get(r["transaction_id"], b"") + bytes(r["frame"])
    assert found == payloads(packets, b"RC\n")


def test_shift_of_long_lengths():
    lengths = np.array([0, 1, 7, 1000, 2**20 + 3])
    crc = np.array([zlib.crc32(b"abc")] * len(lengths))
    moved = shift_checksums(crc, lengths)
    for n, value in zip(lengths, moved):
        zeros = b"\0" * int(n)
        assert int(value) ^ zlib.crc32(zeros) == zlib.crc32(b"abc" + zeros)


def test_checksum_check(spark):
    sent = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "transaction_id string, checksum bigint")
    answers = spark.createDataFrame([("a", 1), ("b", 9)], "transaction_id string, server_checksum bigint")
    found = {r["transaction_id"]: r["response_code"] for r in T.check_checksums(sent, answers).collect()}
    assert found == {"a": 12, "b": 19, "c": 19}


def test_unreadable_attributes_do_not_lose_the_packet(spark):
    queue = spark.createDataFrame(
        [(1, None, b"x"), (2, "no json", b"yz"), (3, "{}", None)],
        "packet_id long, attributes string, content binary",
    ).selectExpr("*", "0L AS priority", "0L AS created", "'t' AS transaction_id")
    head = b"\0\0\0\0"
    bodies = {n: head + len(c).to_bytes(8, "big") + c for n, c in ((1, b"x"), (2, b"yz"), (3, b""))}
    assert {r["packet_id"]: bytes(r["frame"]) for r in T.frames(queue).collect()} == bodies
    whole = b"".join(bodies[n] for n in (1, 2, 3))
    row = T.manifest(queue).first()
    assert (row["packets"], row["bytes"], row["checksum"]) == (3, len(whole), zlib.crc32(whole))


def test_delivery_to_a_folder(spark, queue, packets, tmp_path):
    summary = deliver_to_folder(queue, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/frames").count() == sum(1 for p in packets if p[5])
    one = spark.read.parquet(f"{tmp_path}/frames").where(F.col("transaction_id") == "a")
    body = b"".join(bytes(r["frame"]) for r in one.orderBy("priority", "created", "packet_id").collect())
    assert body == payloads(packets)["a"]
    deliver_to_folder(queue, str(tmp_path))  # a resend replaces
    written = spark.read.parquet(f"{tmp_path}/manifests").select(*summary.columns).collect()
    assert sorted(written) == sorted(summary.collect())
