"""The registered queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courier.llm import alignment, byte_bpe, chat, decontamination, fingerprints, line_dedup
from courier.llm import mixing, quality, simhash_dedup, suffix_dedup, tokens, toxicity, variants
from courier.llm.common import read_table
from courier.sources.scratch import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read_table(spark, sf_dir, "documents"))


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_duplicate_groups(read_table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        simhash_dedup.fingerprint_hex("fp").alias("fingerprint"),
        "component_id",
    )


def _predicted(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        F.col("id").alias("doc_id"),
        "held_out",
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
    return _predicted(scores, toxicity.THRESHOLD)


@query(
    "op4_chat_format",
    r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(length('<|im_start|>') + length(line) + len(regexp_extract_all(line, broken)) + 1
           + length(text) + len(regexp_extract_all(text, broken)) + length('<|im_end|>') + 1
          )::BIGINT AS formatted_chars
FROM (SELECT *, replace(replace(role, '%', '%25'), chr(10), '%0A') AS line,
        '[<\[]\\*(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\])' AS broken
      FROM turns)
GROUP BY conv_id
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.chat_digests(turns.unionByName(probe))


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
    return _predicted(scores, quality.THRESHOLD)


@query(
    "op6_suffix_dedup",
    """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (
  SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS w
  FROM docs, unnest(range(0, length(x) // 2 - 99)) AS t(p)),
repeats AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS nth FROM windows)
  WHERE nth > 1),
marked AS (
  SELECT doc_id, p, CASE WHEN p > lag(p) OVER d + 100 OR lag(p) OVER d IS NULL THEN 1 ELSE 0 END
           AS begins
  FROM repeats WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (
  SELECT doc_id, p, sum(begins) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM marked),
spans AS (
  SELECT doc_id, n, min(p) AS low, max(p) + 100 AS high FROM numbered GROUP BY doc_id, n),
edges AS (
  SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS last
  FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(high - low)::BIGINT AS n_removed,
         string_agg(substr(x, 2 * last + 1, 2 * (low - last)), '' ORDER BY low) AS head,
         max(high) AS last
  FROM edges JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def _weights_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {w}" for k, w in mixing.WEIGHTS.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


def _level_sql(depth: int) -> str:
    """The share-out of one level: capacities, order of filling, what each node is given."""
    path = ", ".join(mixing.LEVELS[: depth + 1])
    parent = ", ".join(mixing.LEVELS[:depth]) or "1"
    level, above = mixing.LEVELS[depth], f"g{depth}"
    return f"""
n{depth} AS (
  SELECT {path}, sum(supply)::HUGEINT * {mixing.MAX_EPOCHS} AS cap, any_value(given) AS budget,
         ({_weights_sql(level)})::HUGEINT AS w
  FROM {above} GROUP BY {path}),
o{depth} AS (
  SELECT *, coalesce(sum(cap) OVER (e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
         sum(w) OVER (e ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a
  FROM n{depth}
  WINDOW e AS (PARTITION BY {parent} ORDER BY cap // w, (cap % w)::DOUBLE / w, {level})),
f{depth} AS (SELECT *, cap * a <= (budget - b) * w AS filled FROM o{depth}),
s{depth} AS (
  SELECT {path}, CASE WHEN filled THEN cap ELSE
    ((budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER p) * w)
      // greatest(sum(CASE WHEN filled THEN 0 ELSE w END) OVER p, 1) END AS given
  FROM f{depth} WINDOW p AS (PARTITION BY {parent})),
g{depth + 1} AS (
  SELECT l.* EXCLUDE (given), s.given FROM {above} l JOIN s{depth} s USING ({path}))"""


_MIXING_SQL = f"""
WITH slim AS (
  SELECT doc_id,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'none'
              ELSE 'd' || (regexp_extract(source, '([0-9]{{1,9}})$', 1)::INT % 4) END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
  FROM documents),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS supply FROM slim
  GROUP BY ALL HAVING sum(n_tokens) > 0),
g0 AS (
  SELECT *, least((SELECT sum(supply) FROM leaves) * {mixing.BUDGET[0]} // {mixing.BUDGET[1]},
                  (SELECT sum(supply) FROM leaves) * {mixing.MAX_EPOCHS})::HUGEINT AS given
  FROM leaves),
{",".join(_level_sql(d) for d in range(len(mixing.LEVELS)))},
keyed AS (
  SELECT s.*, (given // supply)::BIGINT AS epochs, (given % supply)::BIGINT AS rest,
         md5('{mixing.SEED}:' || (given // supply)::BIGINT || ':' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM slim s JOIN g{len(mixing.LEVELS)} USING (domain, lang, source)),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens
                                ROWS UNBOUNDED PRECEDING) AS reached
  FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens,
       epochs + CASE WHEN rest > 0 AND reached <= rest THEN 1 ELSE 0 END AS copies
FROM placed WHERE epochs + CASE WHEN rest > 0 AND reached <= rest THEN 1 ELSE 0 END > 0
"""


@query("op7_mixing", _MIXING_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_copies(read_table(spark, sf_dir, "documents"))


@query(
    "op8_line_dedup",
    r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line_no, l[i] AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
       unnest(range(1, len(l) + 1)) AS t(i)),
sets AS (
  SELECT *, list_distinct(regexp_extract_all(
           lower(line), '[^\x20\x09-\x0D]+')) AS words
  FROM lines),
filled AS (
  SELECT doc_id, line_no, words, len(words) AS n, row_number() OVER (ORDER BY doc_id, line_no) AS id
  FROM sets WHERE len(words) > 0),
tokens AS (SELECT id, n, unnest(words) AS w FROM filled),
counts AS (SELECT w, count(*) AS c FROM tokens GROUP BY w),
ordered AS (
  SELECT id, n, w, row_number() OVER (PARTITION BY id ORDER BY c, w) AS nth
  FROM tokens JOIN counts USING (w)),
prefix AS (SELECT * FROM ordered WHERE nth <= n - ceil(n * 4 / 5.0) + 1),
pairs AS (
  SELECT DISTINCT x.id AS a, y.id AS b FROM prefix x JOIN prefix y
    ON x.w = y.w AND x.id > y.id AND x.n * 5 >= y.n * 4 AND y.n * 5 >= x.n * 4),
alike AS (
  SELECT DISTINCT a FROM pairs JOIN filled x ON x.id = a JOIN filled y ON y.id = b
  WHERE len(list_intersect(x.words, y.words)) * 5
        >= 4 * (x.n + y.n - len(list_intersect(x.words, y.words)))),
gone AS (SELECT doc_id, line_no FROM alike JOIN filled ON id = a)
SELECT s.doc_id, count(*) AS n_lines, count(g.line_no) AS n_removed,
       length(coalesce(string_agg(s.line, chr(10) ORDER BY s.line_no) FILTER (g.line_no IS NULL), ''))
         ::BIGINT AS kept_chars,
       sha256(coalesce(string_agg(s.line, chr(10) ORDER BY s.line_no) FILTER (g.line_no IS NULL), ''))
         AS kept_sha256
FROM lines s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.line_no = s.line_no
GROUP BY s.doc_id
""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_counts(read_table(spark, sf_dir, "documents"))


@query("op9_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_table(read_table(spark, sf_dir, "documents"))


def _normal_words_sql(table: str, key: str) -> str:
    unspaced = "".join(f"\\p{{{s}}}" for s in "Han Hiragana Katakana Thai Lao Khmer Myanmar".split())
    return f"""SELECT {key}, regexp_extract_all(
        regexp_replace(lower(coalesce(text, '')), '([{unspaced}])', ' \\1 ', 'g'),
        '[\\p{{L}}\\p{{N}}]+') AS h FROM {table}"""


#: Every diagonal that shares a word is counted, without seeds.
_DECONTAMINATION_SQL = f"""
WITH items AS ({_normal_words_sql("benchmark", "item_id")}),
docs AS ({_normal_words_sql("documents", "doc_id")}),
item_words AS (
  SELECT item_id, len(h) AS words, unnest(h) AS w, generate_subscripts(h, 1) AS i
  FROM items WHERE len(h) >= {decontamination.SHORTEST}),
doc_words AS (SELECT doc_id, unnest(h) AS w, generate_subscripts(h, 1) AS i FROM docs),
enough AS (
  SELECT doc_id, item_id, d.i - b.i AS shift, any_value(words) AS words, count(*) AS matched
  FROM doc_words d JOIN item_words b USING (w) GROUP BY doc_id, item_id, shift
  HAVING count(*) >= least({decontamination.LEAST},
                           ceil(round(any_value(words) * {decontamination.SHARE}, 6)))),
best AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, max(matched) AS matched,
         min_by(item_id, (-matched, item_id)) AS item_id
  FROM enough GROUP BY doc_id)
SELECT doc_id, best.doc_id IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items,
       coalesce(best.item_id, -1) AS item_id, coalesce(best.matched, 0) AS matched
FROM documents LEFT JOIN best USING (doc_id)
"""


@query("op10_decontamination", _DECONTAMINATION_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


@query("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode_documents(read_table(spark, sf_dir, "documents"))
    return byte_bpe.decode_documents(encoded).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align_documents(read_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    slim = aligned.withColumn("groups_sha256", digest).drop("groups")
    return alignment.link_statistics(materialise(slim, "aligned"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.word_counts(read_table(spark, sf_dir, "documents"), shorten_one_in=31)
    return variants.spelling_variants(words)
