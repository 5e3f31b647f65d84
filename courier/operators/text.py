"""Full-text search over one or more text columns.

A search reads each text once and decides row by row in generated code; nothing is
shuffled.  The index is a flat token table, clustered by token, for repeated searches: a
frequent token spreads over as many files as it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courier.functions.words import Tokenizer, word_spans

PLAIN = Tokenizer()
#: Folders of an index; a search for whole terms reads one per term.
BUCKETS = 64


def tokens(df: DataFrame, key: str, column: str, tokenizer: Tokenizer = PLAIN) -> DataFrame:
    """``key, position, token`` of every kept token; positions count kept tokens from 0."""
    return df.select(
        key, F.posexplode(tokenizer.tokens(F.col(column))).alias("position", "token")
    )


def remove_stop_words(token_rows: DataFrame, words: DataFrame) -> DataFrame:
    """Token rows without those in ``words (word)``; for lists of any size."""
    listed = words.select(F.col("word").alias("token")).distinct()
    return token_rows.join(listed, "token", "left_anti").select(*token_rows.columns)


def token_table(
    df: DataFrame, key: str, columns: Sequence[str], tokenizer: Tokenizer = PLAIN
) -> DataFrame:
    """The searchable form of ``columns``: one row per token with its place in the text.

    ``key, column, position, token, byte_offset, byte_length``; columns count from 0.
    """
    parts = []
    for number, column in enumerate(columns):
        text = F.col(column)
        spans = _token_spans(text, tokenizer)
        parts.append(
            df.select(key, F.lit(number).alias("column"), F.posexplode(spans).alias("position", "s"))
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.select(
        key, "column", "position", F.col("s.token").alias("token"),
        F.col("s.byte_offset").alias("byte_offset"), F.col("s.byte_length").alias("byte_length"),
    )


def _token_spans(text: Column, tokenizer: Tokenizer) -> Column:
    spans = F.transform(
        word_spans(text),
        lambda s: F.struct(
            tokenizer.token(s["word"]).alias("token"),
            s["byte_offset"].alias("byte_offset"),
            s["byte_length"].alias("byte_length"),
        ),
    )
    return F.filter(spans, lambda s: tokenizer.kept(s["token"], text))


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.hash(token), F.lit(buckets))


def write_index(table: DataFrame, key: str, path: str, buckets: int = BUCKETS) -> None:
    """Write a token table in folders by token bucket, sorted by token.

    Spark evens out the partitions as it writes: a bucket that holds a frequent token is
    split over several files.
    """
    (
        table.withColumn("bucket", _bucket(F.col("token"), buckets))
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "token", key)
        .write.mode("errorifexists")
        .partitionBy("bucket")
        .parquet(path)
    )
    # The dictionary, sorted by token: which folders hold the tokens of a prefix.
    (
        table.select("token", _bucket(F.col("token"), buckets).alias("bucket"))
        .distinct()
        .repartitionByRange("token")
        .sortWithinPartitions("token")
        .write.mode("errorifexists")
        .parquet(terms_path(path))
    )


def terms_path(path: str) -> str:
    """Where the dictionary of the index at ``path`` lies."""
    return f"{path.rstrip('/')}-terms"


# --- searching -----------------------------------------------------------------------


@dataclass(frozen=True)
class Term:
    text: str
    prefix: bool
    bucket: int

    def hits(self, token: Column) -> Column:
        return F.startswith(token, F.lit(self.text)) if self.prefix else token == F.lit(self.text)


def query_terms(
    spark: SparkSession, query: str, tokenizer: Tokenizer = PLAIN, buckets: int = BUCKETS
) -> list[Term]:
    """The query's tokens, from the tokenizer of the searched columns.

    A final ``*`` makes the last term a prefix.  The tokenizer is made of column
    expressions, so Spark evaluates it once here; searches then compare with constants.
    """
    tokens = tokenizer.tokens(F.lit(query))
    row = spark.range(1).select(
        tokens.alias("tokens"),
        F.transform(tokens, lambda t: _bucket(t, buckets)).alias("buckets"),
    ).first()
    last = len(row["tokens"]) - 1
    begun = query.rstrip().endswith("*")
    return [
        Term(text, begun and i == last, bucket)
        for i, (text, bucket) in enumerate(zip(row["tokens"], row["buckets"]))
    ]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _terms_hit(token: Column, terms: list[Term]) -> Column:
    """The numbers of the terms that a token hits."""
    return F.array_compact(
        F.array(*[F.when(term.hits(token), F.lit(i)) for i, term in enumerate(terms)])
    )


def match(
    df: DataFrame, columns: Sequence[str], query: str, tokenizer: Tokenizer = PLAIN
) -> DataFrame:
    """Rows in which every term of the query occurs, in whichever of the columns."""
    return _match(df, columns, query_terms(df.sparkSession, query, tokenizer), tokenizer)


def _match(
    df: DataFrame, columns: Sequence[str], terms: list[Term], tokenizer: Tokenizer
) -> DataFrame:
    if not terms:
        return df.where(F.lit(False))
    words = [tokenizer.tokens(F.coalesce(F.col(c), F.lit(""))) for c in columns]
    words = words[0] if len(words) == 1 else F.concat(*words)
    whole = sorted({t.text for t in terms if not t.prefix})
    found = F.lit(True)
    if len(whole) == 1:
        found = F.array_contains(words, F.lit(whole[0]))
    elif whole:
        wanted = F.array(*map(F.lit, whole))
        found = F.size(F.array_intersect(words, wanted)) == len(whole)
    for term in terms:
        if term.prefix:
            found = found & F.exists(words, term.hits)
    return df.where(found)


def match_offsets(
    df: DataFrame, key: str, columns: Sequence[str], query: str, tokenizer: Tokenizer = PLAIN
) -> DataFrame:
    """Every hit in the matching rows: column, term number, byte offset, byte length.

    Byte offsets are measured for matching rows only.
    """
    terms = query_terms(df.sparkSession, query, tokenizer)
    matching = _match(df, columns, terms, tokenizer).select(key, *columns)
    placed = token_table(matching, key, columns, tokenizer)
    hits = placed.where(_any([t.hits(F.col("token")) for t in terms]))
    return hits.select(
        key,
        "column",
        F.explode(_terms_hit(F.col("token"), terms)).alias("term"),
        "byte_offset",
        "byte_length",
    )


def search_index(
    index: DataFrame,
    key: str,
    query: str,
    tokenizer: Tokenizer = PLAIN,
    buckets: int = BUCKETS,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Keys of documents that hold every term of the query, from a written index.

    Only the folders that can hold the terms are read.  For a prefix these are looked up in
    the ``dictionary`` at ``terms_path``, whose sorted files skip all other tokens; without it
    a prefix needs all folders.
    """
    terms = query_terms(index.sparkSession, query, tokenizer, buckets)
    if not terms:
        return index.where(F.lit(False)).select(key)
    token = F.col("token")
    hits = index.where(_any([t.hits(token) for t in terms]))
    begun = [t for t in terms if t.prefix]
    if not begun or dictionary is not None:
        folders = {t.bucket for t in terms if not t.prefix}
        if begun:
            found = dictionary.where(_any([t.hits(token) for t in begun]))
            folders |= {r["bucket"] for r in found.select("bucket").distinct().collect()}
        hits = hits.where(F.col("bucket").isin(*sorted(folders)))
    held = hits.select(key, F.explode(_terms_hit(token, terms)).alias("term")).groupBy(key).agg(
        F.collect_set("term").alias("held")  # at most one entry per term
    )
    return held.where(F.size("held") == len(terms)).select(key)
