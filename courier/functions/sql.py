"""The SQL side: bound values, typed reads, dates, LIKE, updates and SQL functions.

Statements run through ``spark.sql(text, args)``, with a list for ``?`` and a dictionary
for named parameters: missing values fail, surplus ones are ignored.
"""

from __future__ import annotations

import datetime
import unicodedata
from collections.abc import Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courier.functions.packets import utc_wall_clock

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


# --- binding ---------------------------------------------------------------------------


def bind_value(value: Any, date_format: str | None = None) -> Any:
    """A parameter as the engine stores it.

    Booleans become 0 or 1, integers wrap to 64 bits, dates become Unix seconds or, with
    a ``strftime`` format, UTC text; bytes stay bytes even when empty.
    """
    if value is None or isinstance(value, (str, float)):
        return value
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, int):
        return (value + 2**63) % 2**64 - 2**63
    if isinstance(value, (bytes, bytearray)):
        return bytearray(value)
    if isinstance(value, datetime.datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=datetime.timezone.utc)
        if date_format is None:
            return value.timestamp()
        return value.astimezone(datetime.timezone.utc).strftime(date_format)
    return str(value)


def run(
    spark: SparkSession,
    statement: str,
    params: Sequence | Mapping[str, Any] | None = None,
    *,
    date_format: str | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """A query with ``?`` or ``:name`` parameters over ``{table}`` DataFrames."""
    if params is None:
        bound: Any = None
    elif isinstance(params, Mapping):
        bound = {name: bind_value(v, date_format) for name, v in params.items()}
    else:
        bound = [bind_value(v, date_format) for v in params]
    return spark.sql(statement, args=bound, **tables)


# --- typed reads -----------------------------------------------------------------------


def read_long(value: Column, kind: str = "string") -> Column:
    """An integer read: text gives its leading integer, a real is cut, null gives 0.

    ``kind`` is the type of the column: ``string``, ``double`` or ``bigint``.
    """
    if kind == "string":
        digits = F.coalesce(F.regexp_extract(value, r"^\s*([+-]?\d+)", 1), F.lit(""))
        limit = F.when(digits.startswith("-"), LONG_MIN).otherwise(LONG_MAX)
        number = F.when(digits == "", 0).otherwise(F.coalesce(digits.try_cast("bigint"), limit))
    elif kind == "double":
        real = F.nanvl(value, F.lit(0.0))
        number = (
            F.when(real >= F.lit(float(LONG_MAX)), LONG_MAX)
            .when(real <= F.lit(float(LONG_MIN)), LONG_MIN)
            .otherwise(real.try_cast("bigint"))
        )
    else:
        number = value.cast("bigint")
    return F.coalesce(number, F.lit(0)).cast("bigint")


def read_int(value: Column, kind: str = "string") -> Column:
    """The low 32 bits of ``read_long``, signed."""
    low = read_long(value, kind).bitwiseAND(F.lit(2**32 - 1))
    return F.when(low >= 2**31, low - 2**32).otherwise(low).cast("int")


def read_bool(value: Column, kind: str = "string") -> Column:
    return read_int(value, kind) != 0


def read_double(value: Column, kind: str = "string") -> Column:
    """A real read: text gives its leading number, null gives 0."""
    if kind == "string":
        number = F.regexp_extract(
            value, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1
        ).try_cast("double")
    else:
        number = value.cast("double")
    return F.coalesce(number, F.lit(0.0))


def read_text(value: Column) -> Column:
    return value.cast("string")


def read_bytes(value: Column) -> Column:
    """Bytes; an empty value is not null."""
    return value.cast("binary")


def store_date(ts: Column, date_format: str | None = None) -> Column:
    """A timestamp as Unix seconds, or as UTC text in ``date_format``."""
    if date_format is None:
        return F.unix_micros(ts) / F.lit(1_000_000.0)
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), date_format)


def read_date(value: Column, date_format: str | None = None) -> Column:
    """The timestamp of Unix seconds, or of UTC text in ``date_format``; null stays null."""
    if date_format is None:
        return F.timestamp_micros((value * F.lit(1_000_000.0)).cast("bigint"))
    return utc_wall_clock(F.try_to_timestamp(value, F.lit(date_format)))


# --- predicates and updates --------------------------------------------------------------

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def like(value: Column, pattern: str) -> Column:
    """LIKE that ignores the case of ASCII letters and has no escape character."""
    folded = pattern.translate(str.maketrans(_UPPER, _UPPER.lower())).replace("\\", "\\\\")
    return F.translate(value, _UPPER, _UPPER.lower()).like(folded)


def update(df: DataFrame, values: Mapping[str, Column], where: Column) -> DataFrame:
    """``df`` with columns set in the rows that satisfy ``where``."""
    return df.withColumns(
        {name: F.when(where, value).otherwise(F.col(name)) for name, value in values.items()}
    )


def rows_changed(df: DataFrame, where: Column) -> DataFrame:
    """How many rows an update with this condition touches."""
    return df.agg(F.count_if(where).alias("changed"))


# --- SQL functions ---------------------------------------------------------------------


@F.pandas_udf(T.StringType())
def remove_diacritics(text: pd.Series) -> pd.Series:
    """Text without combining marks; null stays null."""
    return text.map(_fold, na_action="ignore")


def _fold(text: str) -> str:
    if text.isascii():
        return text
    kept = (c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return unicodedata.normalize("NFC", "".join(kept))


def hypotenuse(a: Column, b: Column) -> Column:
    """Length of the hypotenuse; one missing side counts as 0, two are an error."""
    neither = F.raise_error(F.lit("hypotenuse needs a number")).cast("double")
    length = F.hypot(F.coalesce(a.cast("double"), F.lit(0.0)), F.coalesce(b.cast("double"), F.lit(0.0)))
    return F.when(a.isNull() & b.isNull(), neither).otherwise(length)


def set_alternating_bytes(data: Column) -> Column:
    """Bytes 0, 2, 4, … set to 1; null is an error."""
    missing = F.raise_error(F.lit("set_alternating_bytes needs bytes")).cast("binary")
    changed = F.unhex(F.regexp_replace(F.hex(data), "..(..)?", "01$1"))
    return F.when(data.isNull(), missing).otherwise(changed)


def register_functions(spark: SparkSession) -> None:
    """Make the example functions callable from SQL.

    Functions of one's own are registered the same way: as SQL functions where an
    expression will do, otherwise as a vectorised UDF that raises to report an error.
    """
    spark.udf.register("remove_diacritics", remove_diacritics)
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION hypotenuse(a DOUBLE, b DOUBLE) RETURNS DOUBLE
           RETURN CASE WHEN a IS NULL AND b IS NULL THEN CAST(raise_error('hypotenuse needs a number') AS DOUBLE)
           ELSE hypot(coalesce(a, 0.0D), coalesce(b, 0.0D)) END"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION set_alternating_bytes(data BINARY) RETURNS BINARY
           RETURN CASE WHEN data IS NULL THEN CAST(raise_error('set_alternating_bytes needs bytes') AS BINARY)
           ELSE unhex(regexp_replace(hex(data), '..(..)?', '01$1')) END"""
    )
