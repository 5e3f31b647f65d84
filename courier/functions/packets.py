"""Packets: building them, and turning them into queue rows and back.

All of this is row-local and stays in generated JVM code: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.config import Prioritizer
from courier.schema import QUEUE_COLUMNS, REFERENCE_EPOCH_MILLIS

STRING_MAP = "map<string,string>"


# --- packets -----------------------------------------------------------------


def empty_attributes() -> Column:
    return F.create_map().cast(STRING_MAP)


def from_attributes(
    df: DataFrame, attributes: Column, content: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Packets from an attribute map and optional bytes; missing bytes have length 0."""
    body = F.lit(None).cast("binary") if content is None else content.cast("binary")
    return df.select(
        *keep, attributes.cast(STRING_MAP).alias("attributes"), body.alias("content")
    ).withColumn("declared_length", content_length(F.col("content")))


def from_text(df: DataFrame, text: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Packets from text: no attributes, the text's UTF-8 bytes as content."""
    return from_attributes(df, empty_attributes(), F.encode(text, "UTF-8"), keep)


def from_declared(
    df: DataFrame,
    attributes: Column,
    content: Column,
    declared_length: Column,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Packets whose length was declared apart from the bytes.

    A declared length of 0 yields no content.  ``length_mismatch`` flags rows whose
    bytes do not match the declaration; frames always use the actual length.
    """
    declared = declared_length.cast("bigint")
    return (
        df.select(
            *keep,
            attributes.cast(STRING_MAP).alias("attributes"),
            F.when(declared != 0, content.cast("binary")).alias("content"),
            declared.alias("declared_length"),
        )
        .withColumn("length_mismatch", content_length(F.col("content")) != F.col("declared_length"))
    )


def set_attribute(attributes: Column, key: str, value: Column | str | None) -> Column:
    """Attribute map with ``key`` set; a null value removes the key."""
    rest = F.map_filter(attributes, lambda k, _: k != F.lit(key))
    if value is None:
        return rest
    value = F.lit(value) if isinstance(value, str) else value
    return F.when(value.isNull(), rest).otherwise(F.map_concat(rest, F.create_map(F.lit(key), value)))


def content_length(content: Column) -> Column:
    return F.coalesce(F.octet_length(content), F.lit(0)).cast("bigint")


# --- queue rows --------------------------------------------------------------


def sorted_attributes(attributes: Column) -> Column:
    """Entries in key order, so that JSON text, sizes and checksums are repeatable."""
    return F.array_sort(F.map_entries(attributes))


def attributes_json(attributes: Column) -> Column:
    return F.to_json(F.map_from_entries(sorted_attributes(attributes)))


def parse_attributes(attributes: Column) -> Column:
    """Null text gives an empty map; text that is no JSON object gives null."""
    return F.when(attributes.isNull(), empty_attributes()).otherwise(
        F.from_json(attributes, STRING_MAP)
    )


def estimated_size(attributes: Column, content: Column) -> Column:
    return F.octet_length(attributes).cast("bigint") + content_length(content)


def reference_millis(ts: Column) -> Column:
    """Milliseconds since 2001-01-01T00:00:00Z, truncated, of a time-zoned timestamp."""
    return F.unix_millis(ts) - F.lit(REFERENCE_EPOCH_MILLIS)


def utc_wall_clock(ts: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session time zone is."""
    return F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone())


def to_queue_rows(
    packets: DataFrame,
    *,
    created: Column | int,
    packet_id: Column | str,
    prioritizer: Prioritizer | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Queue rows for packets: JSON attributes, size, clock columns, no transaction.

    ``created`` is the enqueue time in reference milliseconds (a column or one value).
    """
    prioritizer = prioritizer or Prioritizer()
    created = F.lit(created).cast("bigint") if isinstance(created, int) else created.cast("bigint")
    packet_id = F.col(packet_id) if isinstance(packet_id, str) else packet_id
    rows = packets.select(
        *keep,
        packet_id.cast("bigint").alias("packet_id"),
        attributes_json(F.col("attributes")).alias("attributes"),
        "content",
        created.alias("created"),
        (created + prioritizer.ttl_column()).alias("expires"),
        prioritizer.priority_column().alias("priority"),
        F.lit(None).cast("string").alias("transaction_id"),
    )
    return rows.withColumn(
        "estimated_size", estimated_size(F.col("attributes"), F.col("content"))
    ).select(*QUEUE_COLUMNS, *keep)


def to_packets(queue: DataFrame, keep: tuple[str, ...] = ("packet_id",)) -> DataFrame:
    """Packets of queue rows.  Rows whose attributes are not JSON get a null map."""
    return queue.select(
        *keep, parse_attributes(F.col("attributes")).alias("attributes"), "content"
    ).withColumn("declared_length", content_length(F.col("content")))


# --- device telemetry --------------------------------------------------------

# The attribute names of a device packet, in payload order.
DEVICE_FIELDS = (
    "deviceId",
    "userName",
    "evenTime",
    "clickEvent",
    "packetNumber",
    "latitude",
    "longitude",
    "address",
)


def device_packets(df: DataFrame, fields: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """Packets carrying eight device strings as attributes and again as a JSON payload."""
    missing = set(DEVICE_FIELDS) - set(fields)
    if missing:
        raise ValueError(f"missing device fields: {sorted(missing)}")
    values = df.select(*keep, *[fields[n].cast("string").alias(n) for n in DEVICE_FIELDS])
    pairs = [c for n in DEVICE_FIELDS for c in (F.lit(n), F.col(n))]
    payload = F.to_json(F.struct(*DEVICE_FIELDS), {"ignoreNullFields": "false"})
    return from_attributes(values, F.create_map(*pairs), F.encode(payload, "UTF-8"), keep)


def event_time_text(ts: Column) -> Column:
    """Date and time without zero padding, such as ``2024-3-5 4:6:7``."""
    return F.date_format(ts, "y-M-d H:m:s")


def address_line(
    sub_locality: Column, street: Column, locality: Column, country: Column, postal_code: Column
) -> Column:
    """The present parts, each followed by ", ", then the postal code and a blank."""
    parts = [F.coalesce(F.concat(p, F.lit(", ")), F.lit(""))
             for p in (sub_locality, street, locality, country)]
    return F.concat(*parts, F.coalesce(F.concat(postal_code, F.lit(" ")), F.lit("")))
