"""Schemas and small dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PACKET_SCHEMA = T.StructType(
    [
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("content", T.BinaryType()),
        T.StructField("declared_length", T.LongType()),
    ]
)

QUEUE_SCHEMA = T.StructType(
    [
        T.StructField("packet_id", T.LongType(), False),
        T.StructField("attributes", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("estimated_size", T.LongType()),
        T.StructField("created", T.LongType()),
        T.StructField("expires", T.LongType()),
        T.StructField("priority", T.LongType()),
        T.StructField("transaction_id", T.StringType()),
    ]
)
QUEUE_COLUMNS = QUEUE_SCHEMA.fieldNames()

PEER_SCHEMA = T.StructType(
    [
        T.StructField("cluster", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("raw_port", T.IntegerType()),
        T.StructField("raw_is_secure", T.BooleanType()),
        T.StructField("flow_file_count", T.LongType()),
        T.StructField("last_failure", T.DoubleType()),
    ]
)

# Milliseconds from the Unix epoch to 2001-01-01T00:00:00Z, the zero of
# the queue's clock columns.
REFERENCE_EPOCH_MILLIS = 978_307_200_000

# An HTTP status is reported as this base plus the status.
HTTP_STATUS_BASE = 1000

# Other error codes a caller can see.
ERROR_CODES = {
    "unknown": -1,
    "timeout": 100,
    "could_not_create_transaction": 2001,
    "could_not_look_up_site": 2002,
    "could_not_look_up_input_ports": 2003,
    "could_not_look_up_peers": 2004,
    "invalid_server_response": 3001,
    "queue_read_failed": 4001,
    "queue_write_failed": 4002,
    "queue_transaction_failed": 4003,
    "could_not_form_url": 5001,
}

# Transaction states in code order, starting at 0.
TRANSACTION_STATES = (
    "TRANSACTION_STARTED",
    "DATA_EXCHANGED",
    "TRANSACTION_CONFIRMED",
    "TRANSACTION_COMPLETED",
    "TRANSACTION_CANCELED",
    "TRANSACTION_ERROR",
)

# Response code, name, description, whether a message follows.
RESPONSE_CODES = (
    (0, "RESERVED", "Reserved", False),
    (1, "PROPERTIES_OK", "Properties OK", False),
    (10, "CONTINUE_TRANSACTION", "Continue Transaction", False),
    (11, "FINISH_TRANSACTION", "Finish Transaction", False),
    (12, "CONFIRM_TRANSACTION", "Confirm Transaction", True),
    (13, "TRANSACTION_FINISHED", "Transaction Finished", False),
    (
        14,
        "TRANSACTION_FINISHED_BUT_DESTINATION_FULL",
        "Transaction Finished But Destination is Full",
        False,
    ),
    (15, "CANCEL_TRANSACTION", "Cancel Transaction", True),
    (19, "BAD_CHECKSUM", "Bad Checksum", False),
    (20, "MORE_DATA", "More Data Exists", False),
    (21, "NO_MORE_DATA", "No More Data Exists", False),
    (200, "UNKNOWN_PORT", "Unknown Port", False),
    (201, "PORT_NOT_IN_VALID_STATE", "Port Not in a Valid State", True),
    (202, "PORTS_DESTINATION_FULL", "Port's Destination is Full", False),
    (230, "UNKNOWN_PROPERTY_NAME", "Unknown Property Name", True),
    (231, "ILLEGAL_PROPERTY_VALUE", "Illegal Property Value", True),
    (232, "MISSING_PROPERTY", "Missing Property", True),
    (240, "UNAUTHORIZED", "User Not Authorized", True),
    (250, "ABORT", "Abort", True),
    (254, "UNRECOGNIZED_RESPONSE_CODE", "Unrecognized Response Code", False),
    (255, "END_OF_STREAM", "End of Stream", False),
)

CONFIRM_TRANSACTION = 12
DESTINATION_FULL = 14
BAD_CHECKSUM = 19


def response_codes(spark: SparkSession) -> DataFrame:
    """The 21-row response code dimension; its size is fixed, so it may be broadcast."""
    return spark.createDataFrame(
        list(RESPONSE_CODES),
        "response_code int, code_name string, code_description string, has_message boolean",
    )


def transaction_states(spark: SparkSession) -> DataFrame:
    """The 6-row state dimension; its size is fixed, so it may be broadcast."""
    return spark.createDataFrame(
        list(enumerate(TRANSACTION_STATES)), "state_code int, state string"
    )
