"""Delivery replies, transaction states and what they mean for the queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.functions.urls import (
    duration_seconds,
    last_segment,
    leading_integer,
    status_error,
    succeeded,
)
from courier.operators.queue import unassigned
from courier.schema import (
    CONFIRM_TRANSACTION,
    DESTINATION_FULL,
    response_codes,
    transaction_states,
)

_REPLY_JSON = "flowFileSent string, responseCode string, message string"

# Headers of a creation reply, and the value that announces a transaction.
INTENT_HEADER = "x-location-uri-intent"
INTENT_VALUE = "transaction-url"
LOCATION_HEADER = "location"
#: The body's parser puts text that is no JSON here.
_BROKEN = "_broken"


def _header(name: str) -> Column:
    """Value of the first header of that lower-cased name; headers are folded once."""
    found = F.filter("_headers", lambda e: e["key"] == name)
    return F.get(found, F.lit(0))["value"]


def parse_creation_replies(replies: DataFrame, ttl_header: str) -> DataFrame:
    """Transactions created by ``replies (request_id, status, headers, body)``.

    One row per reply.  ``ttl_header`` names the header with the transaction's time to
    live.  ``transaction_id`` is null when none was created: a status other than 200 or
    201, no transaction intent, or no location.  A body that is not JSON still leaves a
    transaction, with ``body_error`` set.
    """
    folded = F.transform(
        F.map_entries("headers"),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    wanted = (INTENT_HEADER, LOCATION_HEADER, ttl_header.lower())
    body = F.from_json(
        "body",
        f"{_REPLY_JSON}, {_BROKEN} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN},
    )
    read = replies.select(
        "request_id",
        "status",
        F.filter(folded, lambda e: e["key"].isin(*wanted)).alias("_headers"),
        body.alias("_read"),
    ).select(
        "request_id",
        "status",
        (
            succeeded("create", F.col("status")) & _header(INTENT_HEADER).eqNullSafe(INTENT_VALUE)
        ).alias("_intended"),
        _header(LOCATION_HEADER).alias("_location"),
        _header(ttl_header.lower()).alias("_ttl"),
        "_read",
    )
    created = F.col("_intended") & F.col("_location").isNotNull()
    broken = F.col("_read").isNull() | F.col(f"_read.{_BROKEN}").isNotNull()
    parsed = read.select(
        "request_id",
        "status",
        F.when(created, F.col("_location")).alias("transaction_url"),
        F.when(created, leading_integer(F.col("_ttl"))).alias("server_ttl"),
        F.when(created, F.col("_read")).alias("_body"),
        F.when(created, broken).alias("body_error"),
    )
    return parsed.select(
        "request_id",
        last_segment(F.col("transaction_url")).alias("transaction_id"),
        "transaction_url",
        "server_ttl",
        leading_integer(F.col("_body.flowFileSent")).alias("packets_sent"),
        leading_integer(F.col("_body.responseCode")).cast("int").alias("response_code"),
        F.col("_body.message").alias("message"),
        "body_error",
        F.when(~succeeded("create", F.col("status")), status_error(F.col("status"))).alias(
            "error_code"
        ),
    )


def parse_completion_replies(replies: DataFrame) -> DataFrame:
    """Results of ``replies (transaction_id, body)``.

    ``readable`` tells whether the body is a JSON object.  One that lacks a field leaves
    that column null; one that cannot be read, or is missing, leaves all of them null.
    """
    body = F.from_json(
        "body",
        f"{_REPLY_JSON}, {_BROKEN} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN},
    )
    readable = F.col("_body").isNotNull() & F.col(f"_body.{_BROKEN}").isNull()
    return replies.select("transaction_id", body.alias("_body")).select(
        "transaction_id",
        leading_integer(F.col("_body.flowFileSent")).alias("packets_transferred"),
        leading_integer(F.col("_body.responseCode")).cast("int").alias("response_code"),
        F.col("_body.message").alias("message"),
        readable.alias("readable"),
    )


# Fixed value: the letters that every reply of a socket transfer begins with.
SOCKET_REPLY = "RC"


def _number(data: Column) -> Column:
    return F.conv(F.hex(data), 16, 10).cast("int")


def parse_socket_replies(replies: DataFrame) -> DataFrame:
    """Codes and messages of ``replies (transaction_id, body)`` with a binary body.

    A reply is ``RC``, a byte with the response code, and perhaps a message: its length in two
    bytes, big-endian, and its UTF-8 bytes.  ``readable`` is false, and the other columns null,
    for a missing body, one of under three bytes, or one that begins otherwise.  A message
    cut short gives what is there.
    """
    body = F.col("body")
    readable = (F.octet_length(body) >= 3) & (F.substring(body, 1, 2) == F.encode(F.lit(SOCKET_REPLY), "UTF-8"))
    readable = F.coalesce(readable, F.lit(False))
    text = F.substring(body, F.lit(6), _number(F.substring(body, 4, 2))).cast("string")
    return replies.select(
        "transaction_id",
        F.when(readable, _number(F.substring(body, 3, 1))).alias("response_code"),
        F.when(readable & (F.octet_length(body) > 3), F.make_valid_utf8(text)).alias("message"),
        readable.alias("readable"),
    )


def socket_results(manifests: DataFrame, confirmations: DataFrame, endings: DataFrame) -> DataFrame:
    """How each socket transfer ended, from its two parsed replies, at most one row of each.

    The first must say that the checksum is confirmed; the second, to the confirmation sent
    back, only has to be readable.  All packets of a completed transaction count as sent.
    """
    first = confirmations.select("transaction_id", "response_code")
    checked = manifests.select("transaction_id").join(first, "transaction_id", "left")
    counts = manifests.select("transaction_id", F.col("packets").alias("packets_transferred"))
    return transaction_results(checked, endings.join(counts, "transaction_id"))


def parse_send_replies(replies: DataFrame) -> DataFrame:
    """Checksums of ``replies (transaction_id, status, body)`` to sent packets.

    ``server_checksum`` is the number that the body of a success begins with, 0 if there is
    none; for any other status it is -1, and ``error_code`` stands for the status.
    """
    sent = succeeded("send", F.col("status"))
    return replies.select(
        "transaction_id",
        F.when(sent, F.coalesce(leading_integer(F.col("body")), F.lit(0)))
        .otherwise(F.lit(-1))
        .cast("bigint")
        .alias("server_checksum"),
        F.when(sent.isNull() | ~sent, status_error(F.col("status"))).alias("error_code"),
    )


def transaction_results(checked: DataFrame, completions: DataFrame) -> DataFrame:
    """How each transaction ended, from its checksum check and its completion reply.

    ``checked`` has the response code to end each transaction with, ``completions`` at most
    one parsed reply for each.  A transaction completes if its checksum was confirmed and
    the reply could be read, whatever fields it has: no code stays null, no count is 0.  All
    others are errors that transferred nothing; their response code is the one of the check, or
    null where that was confirmed.  With ``started_at`` in ``checked`` and ``ended_at`` in
    ``completions`` the duration in seconds is added.
    """
    confirmed = F.col("response_code") == F.lit(CONFIRM_TRANSACTION)
    replies = completions.withColumnsRenamed({"response_code": "_reply", "message": "_message"})
    joined = checked.join(replies, "transaction_id", "left")
    done = F.coalesce(confirmed & F.col("readable"), F.lit(False))
    columns = [
        "transaction_id",
        F.when(done, "TRANSACTION_COMPLETED").otherwise("TRANSACTION_ERROR").alias("state"),
        F.when(confirmed, F.col("_reply")).otherwise(F.col("response_code")).alias("response_code"),
        F.when(done, F.coalesce("packets_transferred", F.lit(0)))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("packets_transferred"),
        F.when(done, F.col("_message")).alias("message"),
    ]
    if "started_at" in checked.columns and "ended_at" in completions.columns:
        duration = duration_seconds(F.col("started_at"), F.col("ended_at"))
        columns.append(F.when(done, duration).alias("duration_seconds"))
    return joined.select(*columns)


def should_back_off(response_code: Column) -> Column:
    """The transaction finished, but the destination is full."""
    return response_code.eqNullSafe(F.lit(DESTINATION_FULL))


def describe_codes(outcomes: DataFrame) -> DataFrame:
    """Outcomes with the name and description of their response code."""
    dimension = response_codes(outcomes.sparkSession)  # 21 rows
    return outcomes.join(F.broadcast(dimension), "response_code", "left")


def name_states(events: DataFrame) -> DataFrame:
    """Events with the name of their ``state_code``; an unknown code fails the query."""
    dimension = transaction_states(events.sparkSession)  # 6 rows
    unknown = F.raise_error(
        F.concat(F.lit("unknown transaction state "), F.col("state_code").cast("string"))
    )
    return events.join(F.broadcast(dimension), "state_code", "left").withColumn(
        "state", F.when(F.col("state").isNull(), unknown.cast("string")).otherwise(F.col("state"))
    )


def latest_states(events: DataFrame) -> DataFrame:
    """The last state of each transaction of ``events (transaction_id, seq, state)``."""
    return events.groupBy("transaction_id").agg(
        F.max_by("state", "seq").alias("state"), F.max("seq").alias("seq")
    )


def total_sent(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.coalesce(F.sum("packets_transferred"), F.lit(0)).alias("packets_transferred")
    )


def delivery_action(state: Column) -> Column:
    """Only a completed transaction is acknowledged; every other outcome is released."""
    return F.when(state.eqNullSafe(F.lit("TRANSACTION_COMPLETED")), "acknowledge").otherwise(
        "release"
    )


def apply_outcomes(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The queue after ``outcomes (transaction_id, state)``, one row per transaction.

    Packets of completed transactions go, those of other ended transactions are free
    again, those of transactions without an outcome stay in flight.  Packets that wait
    do not take part in the join.
    """
    actions = outcomes.select("transaction_id", delivery_action(F.col("state")).alias("_action"))
    flying = queue.where(F.col("transaction_id").isNotNull())
    after = (
        flying.join(actions, "transaction_id", "left")
        .where(F.coalesce(F.col("_action"), F.lit("wait")) != F.lit("acknowledge"))
        .withColumn(
            "transaction_id",
            F.when(F.col("_action").isNull(), F.col("transaction_id")),
        )
        .select(*queue.columns)
    )
    return unassigned(queue).unionByName(after)


def failure_events(outcomes: DataFrame) -> DataFrame:
    """A peer failure for every outcome that did not complete: ``url, failed_at``."""
    return outcomes.where(delivery_action(F.col("state")) == F.lit("release")).select(
        "url", "failed_at"
    )
