"""Registered queries over full text: documents, pages and benchmark items."""

from __future__ import annotations

from pyspark.sql import functions as F

from courier.functions.words import Tokenizer, strip_plural
from courier.operators import text as X
from courier.plans.inputs import table
from courier.plans.registry import query
from courier.sources.scratch import scratch_path

WORD_SQL = r"'[\p{L}\p{N}]+'"
STOP = ("the", "and", "of", "de", "la", "le", "les", "der", "die", "und", "el")
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)


def words_sql(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, {WORD_SQL}), lambda w: lower(w))"


def placed_sql(source: str, key: str, text: str) -> str:
    """Tokens with position and byte offset, from the gaps between them."""
    return f"""
    SELECT {key}, pos AS position, lower(word) AS token, strlen(word) AS byte_length,
      sum(strlen(gap) + strlen(word)) OVER (PARTITION BY {key} ORDER BY pos) - strlen(word)
        AS byte_offset
    FROM (SELECT {key}, generate_subscripts(words, 1) - 1 AS pos, unnest(words) AS word,
            unnest(list_slice(gaps, 1, len(words))) AS gap
          FROM (SELECT {key}, regexp_extract_all({text}, {WORD_SQL}) AS words,
                  string_split_regex({text}, {WORD_SQL}) AS gaps FROM {source}))"""


@query(
    "word_tokens",
    f"""SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS position,
        unnest(words) AS token FROM (SELECT doc_id, {words_sql('text')} AS words FROM documents)""",
)
def word_tokens(spark, sf_dir):
    return X.tokens(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "stop_words",
    f"""WITH w AS (SELECT doc_id, CASE WHEN suffix(text, '*') THEN {words_sql('text')}
            ELSE list_filter({words_sql('text')}, lambda w: w NOT IN ({STOP_SQL})) END AS words
          FROM documents)
        SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS position,
          unnest(words) AS token FROM w""",
)
def stop_words(spark, sf_dir):
    return X.tokens(
        table(spark, sf_dir, "documents"), "doc_id", "text", Tokenizer(stop_words=STOP)
    )


@query(
    "stop_word_table",
    f"""WITH w AS (SELECT DISTINCT unnest({words_sql('text')}) AS word FROM benchmark),
        d AS (SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS position,
          unnest(words) AS token FROM (SELECT doc_id, {words_sql('text')} AS words FROM documents))
        SELECT * FROM d WHERE token NOT IN (SELECT word FROM w)""",
)
def stop_word_table(spark, sf_dir):
    words = X.tokens(table(spark, sf_dir, "benchmark"), "item_id", "text")
    rows = X.tokens(table(spark, sf_dir, "documents"), "doc_id", "text")
    return X.remove_stop_words(rows, words.select(F.col("token").alias("word")))


@query(
    "token_rule",
    f"""SELECT token, count(*) AS uses FROM (
          SELECT regexp_replace(unnest({words_sql('text')}), 's$', '') AS token
          FROM documents) WHERE token <> '' GROUP BY 1""",
)
def token_rule(spark, sf_dir):
    rows = X.tokens(
        table(spark, sf_dir, "documents"), "doc_id", "text", Tokenizer(rule=strip_plural)
    )
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))


@query(
    "token_table",
    f"""SELECT doc_id, CAST(0 AS INTEGER) AS "column", CAST(position AS INTEGER) AS position, token,
        CAST(byte_offset AS INTEGER) AS byte_offset, CAST(byte_length AS INTEGER) AS byte_length
        FROM ({placed_sql('documents', 'doc_id', 'text')})""",
)
def token_table(spark, sf_dir):
    return X.token_table(table(spark, sf_dir, "documents"), "doc_id", ["text"])


def holds_sql(words: str, *terms: str) -> str:
    return " AND ".join(f"list_contains({words}, '{t}')" for t in terms)


@query(
    "text_match",
    f"SELECT doc_id, lang FROM documents WHERE {holds_sql(words_sql('text'), 'nicht')}",
)
def text_match(spark, sf_dir):
    return X.match(table(spark, sf_dir, "documents"), ["text"], "Nicht").select("doc_id", "lang")


@query(
    "text_match_all_terms",
    f"SELECT doc_id, lang FROM documents WHERE {holds_sql(words_sql('text'), 'the', 'and', 'of')}",
)
def text_match_all_terms(spark, sf_dir):
    return X.match(table(spark, sf_dir, "documents"), ["text"], "The and OF").select(
        "doc_id", "lang"
    )


@query(
    "text_prefix",
    f"""SELECT doc_id FROM documents WHERE len(list_filter({words_sql('text')},
        lambda w: starts_with(w, 'menteu'))) > 0""",
)
def text_prefix(spark, sf_dir):
    return X.match(table(spark, sf_dir, "documents"), ["text"], "menteu*").select("doc_id")


@query(
    "plural_match",
    f"""SELECT doc_id FROM documents WHERE list_contains(list_transform({words_sql('text')},
        lambda w: regexp_replace(w, 's$', '')), 'la')""",
)
def plural_match(spark, sf_dir):
    return X.match(
        table(spark, sf_dir, "documents"), ["text"], "las", Tokenizer(rule=strip_plural)
    ).select("doc_id")


@query(
    "page_match",
    f"""SELECT page_id FROM pages
        WHERE {holds_sql(f"list_concat({words_sql('url')}, {words_sql('html')})", 'example', 'nicht')}""",
)
def page_match(spark, sf_dir):
    return X.match(table(spark, sf_dir, "pages"), ["url", "html"], "example nicht").select("page_id")


@query(
    "match_offsets",
    f"""WITH u AS ({placed_sql('pages', 'page_id', 'url')}),
      h AS ({placed_sql('pages', 'page_id', 'html')}),
      p AS (SELECT *, 0 AS col FROM u UNION ALL SELECT *, 1 FROM h),
      hit AS (SELECT *, CASE WHEN token = 'example' THEN 0 ELSE 1 END AS term FROM p
              WHERE token = 'example' OR starts_with(token, 'nich')),
      good AS (SELECT page_id FROM hit GROUP BY 1 HAVING count(DISTINCT term) = 2)
    SELECT page_id, CAST(col AS INTEGER) AS "column", CAST(term AS INTEGER) AS term,
      CAST(byte_offset AS INTEGER) AS byte_offset, CAST(byte_length AS INTEGER) AS byte_length
    FROM hit WHERE page_id IN (SELECT page_id FROM good)""",
)
def match_offsets(spark, sf_dir):
    return X.match_offsets(
        table(spark, sf_dir, "pages"), "page_id", ["url", "html"], "example nich*"
    )


@query(
    "index_search",
    f"SELECT doc_id FROM documents WHERE {holds_sql(words_sql('text'), 'the', 'and')}",
)
def index_search(spark, sf_dir):
    path = scratch_path(spark, "index")
    X.write_index(
        X.tokens(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", path
    )
    return X.search_index(spark.read.parquet(path), "doc_id", "the and")


@query(
    "index_prefix_search",
    f"""SELECT doc_id FROM documents WHERE {holds_sql(words_sql('text'), 'the')}
        AND len(list_filter({words_sql('text')}, lambda w: starts_with(w, 'menteu'))) > 0""",
)
def index_prefix_search(spark, sf_dir):
    """A prefix, by way of the index's sorted dictionary."""
    path = scratch_path(spark, "index")
    X.write_index(
        X.tokens(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", path
    )
    return X.search_index(
        spark.read.parquet(path), "doc_id", "the menteu*",
        dictionary=spark.read.parquet(X.terms_path(path)),
    )
