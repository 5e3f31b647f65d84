"""Transfer frames and checksums.

A frame is: int32 attribute count; per attribute int32 length and key, int32 length and
value; int64 content length; content.  Integers are big-endian, text is UTF-8, lengths
are byte lengths, attributes go in key order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courier.functions.packets import content_length, empty_attributes, sorted_attributes

# The marker before every packet but the first of a socket transfer,
# letters R and C and the code of "continue transaction" (10).
SOCKET_MARKER = b"RC\n"


def _int_hex(value: Column, size: int) -> Column:
    return F.lpad(F.hex(value.cast("bigint")), 2 * size, "0")


def _text_hex(text: Column) -> Column:
    return F.concat(_int_hex(F.octet_length(text), 4), F.hex(text))


def _known(attributes: Column) -> Column:
    """Attributes that cannot be read count as none, so that the content still travels."""
    return F.coalesce(attributes, empty_attributes())


def frame(attributes: Column, content: Column) -> Column:
    """The frame of one packet, as bytes; never null."""
    attributes = _known(attributes)
    pairs = F.transform(
        sorted_attributes(attributes),
        lambda e: F.concat(_text_hex(e["key"]), _text_hex(F.coalesce(e["value"], F.lit("")))),
    )
    head = F.concat(
        _int_hex(F.size(attributes), 4),
        F.array_join(pairs, ""),
        _int_hex(content_length(content), 8),
    )
    return F.concat(F.unhex(head), F.coalesce(content, F.unhex(F.lit(""))))


def frame_length(attributes: Column, content: Column) -> Column:
    """Bytes of the frame, without building it."""
    pairs = F.aggregate(
        F.map_entries(_known(attributes)),
        F.lit(0).cast("bigint"),
        lambda n, e: n
        + F.lit(8)
        + F.octet_length(e["key"])
        + F.coalesce(F.octet_length(e["value"]), F.lit(0)),
    )
    return F.lit(12).cast("bigint") + pairs + content_length(content)


# --- CRC-32 of a concatenation -------------------------------------------------------
#
# With A followed by B, crc(AB) = shift(crc(A), length of B) xor crc(B), where
# shift(c, n) multiplies c, a polynomial over GF(2), by x^(8n) modulo the CRC-32
# polynomial.  So the CRC of many pieces is the xor of each piece's CRC shifted by the
# bytes after it: an aggregate that may be combined in any order.

_POLYNOMIAL = 0xEDB88320  # reflected CRC-32


def _one_zero_byte() -> list[int]:
    """Where each bit of a checksum goes when one zero byte follows."""
    images = []
    for bit in range(32):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (_POLYNOMIAL if value & 1 else 0)
        images.append(value)
    return images


def _apply(images: list[int], value: int) -> int:
    result = 0
    for bit in range(32):
        if value >> bit & 1:
            result ^= images[bit]
    return result


def _shift_tables(powers: int = 48) -> np.ndarray:
    """Lookup per power of two of zero bytes, byte of the checksum and its value."""
    tables = np.zeros((powers, 4, 256), np.uint32)
    images = _one_zero_byte()
    for power in range(powers):
        for part in range(4):
            table = tables[power, part]
            for bit in range(8):
                table[1 << bit : 2 << bit] = table[: 1 << bit] ^ np.uint32(images[8 * part + bit])
        images = [_apply(images, image) for image in images]
    return tables


_TABLES: np.ndarray | None = None


def shift_checksums(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each checksum moved past ``length`` further zero bytes."""
    global _TABLES
    if _TABLES is None:
        _TABLES = _shift_tables()
    crc = crc.astype(np.uint32)
    length = length.astype(np.int64)
    power = 0
    while (length >> power).any():
        at = np.flatnonzero(length >> power & 1)
        c, t = crc[at], _TABLES[power]
        crc[at] = t[0][c & 255] ^ t[1][c >> 8 & 255] ^ t[2][c >> 16 & 255] ^ t[3][c >> 24]
        power += 1
    return crc.astype(np.int64)


@F.pandas_udf(T.LongType())
def shift_checksum(crc: pd.Series, length: pd.Series) -> pd.Series:
    """``shift_checksums`` of columns; null if either is null."""
    known = crc.notna() & length.notna()
    shifted = pd.Series(pd.NA, index=crc.index, dtype="Int64")
    shifted[known] = shift_checksums(
        crc[known].to_numpy().astype(np.int64), length[known].to_numpy().astype(np.int64)
    )
    return shifted


MARKER_CRC = zlib.crc32(SOCKET_MARKER)
