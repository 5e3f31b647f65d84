"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courier.sources.scratch import materialise

#: The documents columns, in order; pipeline stages return these.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Ids of 8 bytes up to which a list of documents is broadcast.
BROADCAST_IDS = 1_000_000

#: White space of the word rules: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """Runs of characters that are no white space; none of an empty text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def id_fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds


def without_ids(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """``docs`` without the ids of ``ids (doc_id)``; rows with a null id stay."""
    gone = materialise(ids.where("doc_id IS NOT NULL").distinct(), label)
    small = broadcast_if_small(gone, gone.count(), BROADCAST_IDS)
    return docs.join(small, "doc_id", "left_anti")


def broadcast_if_small(side: DataFrame, rows: int, limit: int) -> DataFrame:
    """``side`` with a broadcast hint if its counted rows are within ``limit``.

    Beyond the limit the join is left to Spark, which then shuffles both sides.
    """
    return F.broadcast(side) if rows <= limit else side
