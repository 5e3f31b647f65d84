"""Replies, states and what they do to the queue."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from courier.functions import urls as U
from courier.operators import outcomes as O
from courier.schema import RESPONSE_CODES, response_codes


def test_creation_reply(spark):
    url = "http://testhostname:8080/api/transactions/8966b23c"
    headers = {
        "Content-Type": "application/json",
        "Location": url,
        "x-location-uri-intent": "transaction-url",
        "other-server-transaction-ttl": "99",
        "X-Peer-Server-Transaction-TTL": "30",
    }
    body = json.dumps({"flowFileSent": 0, "responseCode": 1, "message": "created"})
    without = {k: v for k, v in headers.items() if k != "x-location-uri-intent"}
    replies = spark.createDataFrame(
        [
            (1, 201, headers, body),
            (2, 200, headers, "no json"),
            (3, 201, without, body),
            (4, 503, headers, body),
            (5, 201, {k: v for k, v in headers.items() if k != "Location"}, body),
        ],
        "request_id int, status int, headers map<string,string>, body string",
    )
    parsed = O.parse_creation_replies(replies, "x-peer-server-transaction-ttl")
    found = {r["request_id"]: r for r in parsed.collect()}
    good = found[1]
    assert (good["transaction_id"], good["transaction_url"], good["server_ttl"]) == ("8966b23c", url, 30)
    assert (good["packets_sent"], good["response_code"], good["message"]) == (0, 1, "created")
    assert good["body_error"] is False and good["error_code"] is None
    assert found[2]["transaction_id"] == "8966b23c" and found[2]["body_error"] is True
    assert found[2]["response_code"] is None
    assert [found[i]["transaction_id"] for i in (3, 4, 5)] == [None] * 3
    assert found[4]["error_code"] == 1503


def test_send_replies(spark):
    replies = spark.createDataFrame(
        [("a", 200, "123 x"), ("b", 202, "7"), ("c", 503, "9"), ("d", 200, None), ("e", None, "1")],
        "transaction_id string, status int, body string",
    )
    rows = O.parse_send_replies(replies).orderBy("transaction_id").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 123, None), ("b", 7, None), ("c", -1, 1503), ("d", 0, None), ("e", -1, None),
    ]


def test_transaction_results(spark):
    checked = spark.createDataFrame(
        [("a", 12, 0.0), ("b", 19, 0.0), ("c", 12, 0.0), ("d", 12, 0.0), ("e", 12, 0.0),
         ("f", 12, 0.0), ("g", None, 0.0), ("h", 12, 0.0)],
        "transaction_id string, response_code int, t double",
    ).withColumn("started_at", F.timestamp_seconds("t"))
    replies = spark.createDataFrame(
        [("a", '{"flowFileSent":1,"responseCode":13,"message":"ok"}'),
         ("b", '{"flowFileSent":1,"responseCode":13,"message":"ok"}'), ("c", "{"),
         ("e", '{"flowFileSent":3}'), ("f", "{}"), ("g", "{}"), ("h", None)],
        "transaction_id string, body string",
    )
    ended = O.parse_completion_replies(replies).withColumn("ended_at", F.timestamp_seconds(F.lit(2.5)))
    rows = O.transaction_results(checked, ended).orderBy("transaction_id").collect()
    assert [tuple(r) for r in rows] == [
        ("a", "TRANSACTION_COMPLETED", 13, 1, "ok", 2.5),
        ("b", "TRANSACTION_ERROR", 19, 0, None, None),
        ("c", "TRANSACTION_ERROR", None, 0, None, None),
        ("d", "TRANSACTION_ERROR", None, 0, None, None),
        ("e", "TRANSACTION_COMPLETED", None, 3, None, 2.5),
        ("f", "TRANSACTION_COMPLETED", None, 0, None, 2.5),
        ("g", "TRANSACTION_ERROR", None, 0, None, None),
        ("h", "TRANSACTION_ERROR", None, 0, None, None),
    ]


def test_socket_replies(spark):
    bodies = {
        "a": b"RC\x0c\x00\x0242", "b": b"RC\x0d", "c": b"RC", "d": b"XC\x0c", "e": None,
        "f": b"", "g": b"RC\x13\x01\x05" + b"m" * 261, "h": b"RC\x0e\x00\x09cut",
        "i": b"RC\x0c\x00\x00", "j": b"RC\x0c\x00\x02\xff\xfe", "k": b"RC\x0c\x00",
    }
    replies = spark.createDataFrame(list(bodies.items()), "transaction_id string, body binary")
    found = {r[0]: tuple(r)[1:] for r in O.parse_socket_replies(replies).collect()}
    none = (None, None, False)
    assert found == {
        "a": (12, "42", True), "b": (13, None, True), "c": none, "d": none, "e": none, "f": none,
        "g": (19, "m" * 261, True), "h": (14, "cut", True), "i": (12, "", True),
        "j": (12, "\ufffd\ufffd", True), "k": (12, "", True),
    }


def test_socket_results(spark):
    names = "abcdef"
    sent = spark.createDataFrame([(n, 5) for n in names], "transaction_id string, packets bigint")
    first = {"a": b"RC\x0c", "b": b"RC\x13", "c": b"?", "d": b"RC\x0c", "f": b"RC\x0c"}
    second = {n: b"RC\x0e\x00\x02ok" for n in "abce"} | {"d": b"RC"}
    replies = [
        O.parse_socket_replies(spark.createDataFrame(list(r.items()), "transaction_id string, body binary"))
        for r in (first, second)
    ]
    rows = O.socket_results(sent, *replies).orderBy("transaction_id").collect()
    error = "TRANSACTION_ERROR"
    assert [tuple(r) for r in rows] == [
        ("a", "TRANSACTION_COMPLETED", 14, 5, "ok"), ("b", error, 19, 0, None),
        ("c", error, None, 0, None), ("d", error, None, 0, None), ("e", error, None, 0, None),
        ("f", error, None, 0, None),
    ]


def test_completion_reply(spark):
    replies = spark.createDataFrame(
        [("a", '{"flowFileSent":3,"responseCode":14,"message":"full"}'), ("b", "x"),
         ("c", '{"flowFileSent":"12","responseCode":"13"}')],
        "transaction_id string, body string",
    )
    df = O.parse_completion_replies(replies).withColumn("back_off", O.should_back_off(F.col("response_code")))
    assert [tuple(r) for r in df.orderBy("transaction_id").collect()] == [
        ("a", 3, 14, "full", True, True), ("b", None, None, None, False, False),
        ("c", 12, 13, None, True, False),
    ]
    assert O.total_sent(df).first()[0] == 15


def test_response_codes(spark):
    assert response_codes(spark).count() == len(RESPONSE_CODES) == 21
    df = spark.createDataFrame([(19,), (77,)], "response_code int")
    named = {r["response_code"]: r["code_name"] for r in O.describe_codes(df).collect()}
    assert named == {19: "BAD_CHECKSUM", 77: None}


def test_states(spark):
    events = spark.createDataFrame(
        [("t", 1, 0), ("t", 2, 1), ("t", 3, 3), ("u", 5, 5), ("u", 4, 2)],
        "transaction_id string, seq int, state_code int",
    )
    latest = O.latest_states(O.name_states(events)).collect()
    assert {r["transaction_id"]: r["state"] for r in latest} == {
        "t": "TRANSACTION_COMPLETED", "u": "TRANSACTION_ERROR",
    }
    unknown = spark.createDataFrame([("t", 1, 6)], "transaction_id string, seq int, state_code int")
    with pytest.raises(PySparkException, match="unknown transaction state 6"):
        O.name_states(unknown).collect()


def test_outcomes_move_the_queue(spark, queue_rows):
    queue = queue_rows([(i, 1, 0, 0, 0, t) for i, t in enumerate(["done", "bad", "open", None, "off"])])
    outcomes = spark.createDataFrame(
        [("done", "TRANSACTION_COMPLETED"), ("bad", "TRANSACTION_ERROR"), ("off", "TRANSACTION_CANCELED")],
        "transaction_id string, state string",
    )
    after = {r["packet_id"]: r["transaction_id"] for r in O.apply_outcomes(queue, outcomes).collect()}
    assert after == {1: None, 2: "open", 3: None, 4: None}


def test_every_outcome_but_completion_is_a_failure(spark):
    df = spark.createDataFrame(
        [("u", 1.0, "TRANSACTION_COMPLETED"), ("v", 2.0, "TRANSACTION_CONFIRMED"), ("w", 3.0, None)],
        "url string, failed_at double, state string",
    )
    assert [tuple(r) for r in O.failure_events(df).collect()] == [("v", 2.0), ("w", 3.0)]


def test_statuses(spark):
    df = spark.createDataFrame([(s,) for s in (200, 201, 202, 204, 299, 300, 404)], "s int")

    def good(kind):
        return [r["s"] for r in df.where(U.succeeded(kind, F.col("s"))).collect()]

    assert good("create") == [200, 201] and good("send") == [200, 202] and good("read") == [200]
    assert good("extend") == [200, 201, 202, 204, 299]
    assert df.select(U.status_error(F.col("s"))).collect()[-1][0] == 1404


def test_leading_integer(spark):
    df = spark.createDataFrame([("12",), (" -7x",), ("x",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(U.leading_integer(F.col("t"))).collect()] == [12, -7, 0, None, 0]
