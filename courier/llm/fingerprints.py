"""Document fingerprints by SimHash, with column expressions only.

Every word votes with its hash: by its length, at most ``HEAVIEST``, for each bit that the
hash has set and against each other bit.  A bit of the fingerprint is set if the votes for
it outweigh those against.  Votes for bits i and i + 32 are added up in the two halves of
one number, so that a document takes 32 sums of whole numbers, in one aggregate.

Fingerprints within a Hamming radius are found with permuted block tables: the 64 bits are
cut into six blocks, and each of 20 tables brings another three of them to the front as an
exact key.  Two fingerprints that differ in at most three bits agree in at least three
blocks, so one table has them under the same key; the full distance is then checked, and
the pair is taken from the first such table only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courier.llm.common import lower_ascii, text_of, words_of
from courier.sources.scratch import materialise

HEAVIEST = 12
_LANES = (1 << 32) | 1
#: First bit and number of bits of each block.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
KEY_BLOCKS = 3
#: Rows that a range of ids holds at least, and the most ranges.
RANGE_ROWS, MOST_RANGES = 4_000, 10_000


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def simhash(texts: DataFrame, keys: list[str], text_column: str) -> DataFrame:
    """``keys`` and ``fp`` of every row; ``keys`` must tell rows apart.

    Texts without words have fingerprint 0.
    """
    words = words_of(lower_ascii(text_of(text_column)))
    votes = texts.select(*keys, F.explode_outer(words).alias("word")).select(
        *keys,
        F.when(F.col("word").isNotNull(), F.xxhash64("word")).otherwise(F.lit(0)).alias("h"),
        F.coalesce(F.least(F.length("word"), F.lit(HEAVIEST)), F.lit(0))
        .cast("bigint")
        .alias("weight"),
    )
    sums = votes.groupBy(*keys).agg(
        F.sum("weight").alias("all"),
        *[
            F.sum(
                F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_LANES)) * F.col("weight")
            ).alias(f"s{i}")
            for i in range(32)
        ],
    )
    bits = F.lit(0).cast("bigint")
    for i in range(32):
        low = F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("all")
        high = F.shiftrightunsigned(F.col(f"s{i}"), 32) * 2 > F.col("all")
        bits = bits.bitwiseOR(F.when(low, F.lit(1 << i)).otherwise(F.lit(0)))
        bits = bits.bitwiseOR(F.when(high, F.lit(_signed(1 << (i + 32)))).otherwise(F.lit(0)))
    return sums.select(*keys, bits.alias("fp"))


def likeness(a: str | Column, b: str | Column) -> Column:
    """1 less the share of differing bits."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def fingerprint_hex(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _range_starts(docs: DataFrame, key: Column) -> list[int]:
    """Keys that begin ranges of about equal size: the least, and quantiles of the rest."""
    rows, least = docs.agg(F.count("*"), F.min(key)).first()
    if not rows:
        return []
    wanted = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    ranges = max(1, min(MOST_RANGES, max(wanted, rows // 1_000_000), rows // RANGE_ROWS))
    cuts = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx(key, cuts, 10_000)).first()[0] if cuts else []
    return sorted({least, *found})


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """Fingerprints of texts, of their edited texts, and likenesses.

    Gives ``doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp`` for every row.  The
    edited text has its last half, rounded down, replaced by as much of the next document's
    beginning.  Next goes by id, equal ids by text, null ids first; after the last comes the
    first, and a single document is its own next.  A null text is empty.

    Rows are dealt into ranges of ids.  A range's first row goes to the range before it as
    well, so each range finds all its next texts by itself.
    """
    least = -(1 << 63)
    key = F.coalesce(F.col(id_column).cast("bigint"), F.lit(least))
    starts = _range_starts(docs, key)
    slim = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        key.alias("key"),
        text_of(text_column).alias("text"),
    )
    firsts = F.array(*map(F.lit, starts)) if starts else F.array().cast("array<bigint>")
    number = F.size(F.filter(firsts, lambda s: s <= F.col("key"))) - 1
    begins = F.array_contains(firsts, F.col("key"))
    before = F.when(begins, (number + len(starts) - 1) % F.lit(max(1, len(starts))))
    places = F.filter(
        F.array(
            F.struct(number.alias("range"), F.lit(False).alias("guest")),
            F.struct(before.cast("int").alias("range"), F.lit(True).alias("guest")),
        ),
        lambda p: p["range"].isNotNull(),
    )
    dealt = slim.select("doc_id", "key", "text", F.inline(places))
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half),
        F.substring("next_text", F.lit(1), half),
    )
    placed = (
        dealt.withColumn("pos", F.row_number().over(order))
        .withColumn("next_text", F.coalesce(F.lead("text").over(order), F.lit("")))
        .withColumn("edited", edited)
        .select(
            "range",
            "pos",
            "guest",
            "doc_id",
            F.length("text").cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            F.inline(
                F.array(
                    F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                    F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")),
                )
            ),
        )
    )
    keys = ["range", "pos", "guest", "doc_id", "n_chars", "edited_sha256"]
    prints = simhash(placed, [*keys, "which"], "t")
    both = prints.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp"),
    )
    along = Window.partitionBy("range").orderBy("pos")
    return (
        both.withColumn("next_fp", F.lead("fp").over(along))
        .where("not guest")
        .select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")
    )


def _tables(fps: DataFrame, name: str) -> DataFrame:
    """A row for each fingerprint and table, with the table's key."""
    fp = F.col(name)
    entries = []
    for number, blocks in enumerate(combinations(range(len(BLOCKS)), KEY_BLOCKS)):
        mask = sum(((1 << BLOCKS[b][1]) - 1) << BLOCKS[b][0] for b in blocks)
        entries.append(
            F.struct(
                F.lit(number).alias("table"), fp.bitwiseAND(F.lit(_signed(mask))).alias("key")
            )
        )
    return fps.select("*", F.inline(F.array(*entries)))


def _first_table(difference: Column) -> Column:
    """The first table whose blocks are all equal; -1 if there is none."""
    tables = list(combinations(range(len(BLOCKS)), KEY_BLOCKS))
    first = []
    for differing in range(1 << len(BLOCKS)):
        fits = [n for n, t in enumerate(tables) if not any(differing >> b & 1 for b in t)]
        first.append(fits[0] if fits else -1)
    number = F.lit(0)
    for b, (low, size) in enumerate(BLOCKS):
        mask = _signed(((1 << size) - 1) << low)
        differs = difference.bitwiseAND(F.lit(mask)) != 0
        number = number + F.when(differs, 1 << b).otherwise(0)
    return F.element_at(F.array(*map(F.lit, first)), number + 1)


def near_fingerprints(queries: DataFrame, counted: DataFrame, radius: int = 3) -> DataFrame:
    """``fp, n_near``: rows within ``radius`` bits of each fingerprint of ``queries``.

    ``counted`` holds distinct fingerprints ``fp`` and the number ``n`` of rows of each, so
    that copies cost nothing.  ``radius`` is 0 to 3.  A query's own rows count.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the block tables cover a radius of 0 to 3")
    asked = _tables(queries.select(F.col("fp").alias("q")).distinct(), "q")
    held = _tables(counted.select("fp", "n"), "fp").withColumnsRenamed(
        {"table": "t", "key": "k"}
    )
    difference = F.col("q").bitwiseXOR(F.col("fp"))
    hit = (
        (F.col("key") == F.col("k"))
        & (F.col("table") == F.col("t"))
        & (F.bit_count(difference) <= radius)
        & (_first_table(difference) == F.col("t"))
    )
    pairs = asked.join(held, hit)
    return pairs.groupBy(F.col("q").alias("fp")).agg(F.sum("n").alias("n_near"))


def fingerprint_table(docs: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """All columns of the fingerprint query.

    ``n_near`` counts the other documents whose fingerprint lies within ``radius`` bits,
    for the ids divisible by ``every``; it is null for all others.
    """
    prints = materialise(edited_fingerprints(docs), "fingerprints")
    counted = prints.groupBy("fp").agg(F.count("*").alias("n"))
    asked = F.col("doc_id") % every == 0
    near = near_fingerprints(prints.where(asked).select("fp"), counted, radius)
    # Rows that are not asked for stay out of the join, where they would meet in one task.
    others = prints.where(F.coalesce(~asked, F.lit(True))).withColumn(
        "n_near", F.lit(None).cast("bigint")
    )
    rows = prints.where(asked).join(near, "fp").select(*others.columns).unionByName(others)
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint_hex("fp").alias("fingerprint"),
        fingerprint_hex("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"),
        (F.col("n_near") - 1).alias("n_near"),
    )
