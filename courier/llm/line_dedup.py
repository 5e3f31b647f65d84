"""Removal of lines that repeat an earlier line, exactly or nearly.

A line is the set of its words, lower-cased.  A line goes if an earlier one (smaller
document id, or above it in the same document) has a set with a Jaccard similarity of at
least the threshold.  All lines are judged on the input.  Lines without words stay.

The similar sets are found by an exact prefix filter over pairs of words.  Words are ordered
by how rare they are, and each word and the next form a pair; the last has a pair of its own.
A word that only one of two sets has breaks two pairs of it and one of the other.  So sets of n
and m words that have c in common share at least 3c - n - m pairs, which is (n + m) / 3 or more
where the similarity is 4/5, and then one of these is among the first few of each.  A single
rare word, in contrast, is met in ever more unlike lines as the input grows.

Every line is held first against the earliest line of each of its pairs, so a pair that m
lines share makes m rows.  Only lines that this does not settle are held against all other lines
of their pairs.  Their candidates have to fit in size, have enough pairs still to come, and
have close parity signatures of 64 bits, in which every word flips one: similar sets differ in
few bits; so do signatures of 512 bits, looked up for the candidates only.  None of
these bounds drops a similar set.  What is left is verified on all words.  Only distinct sets
take part; a set's first line stands for all its copies, so a line that occurs a million times is
one row here.

How rare a word is comes from counts over all lines, added up in ``RARITY_SLOTS`` slots by
the word's hash.  The slots have a fixed size, and any order of the words that is the same
everywhere gives the same pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courier.llm.common import SPACE, broadcast_if_small, text_of
from courier.sources.scratch import discard, materialise

THRESHOLD = (4, 5)
RARITY_SLOTS = 1 << 16
#: Rows of 100 bytes or less up to which a table of places is broadcast.
BROADCAST_ROWS = 500_000
#: Numbers of 64 bits, a power of two, in the signature that rules out candidates.
WIDE = 8
#: Parts of the pairs of words that are filed one after another, so that less is on disk at once.
PARTS = 4
#: The characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
_REST = (1 << 47) - 1
#: A place as read back from a table; joins on another type would shuffle once more.
_PLACE = "struct<doc_id: bigint, line_no: int>"


def _lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, line_no, line``: every line of every row."""
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.posexplode(F.split(text_of(text_column), "\n", -1)).alias("line_no", "line"),
    )


def line_words(line: Column) -> Column:
    """The words of a line; a line without any has one empty word."""
    return F.split(F.btrim(F.lower(line), F.lit(BLANKS)), SPACE)


def _slot(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 48).cast("int")


def rarity_ranks(lines: DataFrame) -> Column:
    """The rank of each slot, the rarest first, as a constant array of RARITY_SLOTS numbers."""
    words = lines.select(F.explode(line_words(F.col("line"))).alias("w"))
    counts = words.groupBy(_slot(F.xxhash64("w")).alias("slot")).agg(F.count("*").alias("n"))
    by_slot = {r["slot"]: r["n"] for r in counts.collect()}  # at most RARITY_SLOTS rows
    order = sorted(range(RARITY_SLOTS), key=lambda slot: (by_slot.get(slot, 0), slot))
    ranks = [0] * RARITY_SLOTS
    for rank, slot in enumerate(order):
        ranks[slot] = rank
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<int>")


def ordered_words(line: Column, ranks: Column) -> Column:
    """A line's distinct words as numbers that sort by rarity: rank of the slot, then hash."""

    def number(word: Column) -> Column:
        h = F.xxhash64(word)
        rank = F.get(ranks, _slot(h)).cast("bigint")
        return F.shiftleft(rank, 47).bitwiseOR(h.bitwiseAND(F.lit(_REST)))

    return F.sort_array(F.array_distinct(F.transform(line_words(line), number)))


def _at_least(share: tuple[int, int], n: Column) -> Column:
    """ceil(share * n) in whole numbers."""
    return F.floor((n * share[0] + (share[1] - 1)) / share[1]).cast("int")


def similar_earlier(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """``doc_id, line_no`` of every line that a similar line precedes.

    ``threshold`` is a fraction of at least 1/2.  A null text has one empty line.  Null ids
    come first, as one document; rows that repeat an id count as the same document, and
    equal lines at the same place of it do not remove each other.
    """
    t, b = threshold
    lines = _lines(docs, id_column, text_column)
    ranks = rarity_ranks(lines)
    filled = F.btrim("line", F.lit(BLANKS)) != ""
    sets = lines.where(filled).select(
        "doc_id", "line_no", ordered_words(F.col("line"), ranks).alias("words")
    )
    n = F.size("words")
    signature = F.aggregate(
        "words",
        F.lit(0).cast("bigint"),
        lambda s, w: s.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), w.bitwiseAND(F.lit(63)).cast("int"))
        ),
    )
    # The smallest set that may be similar asks for the fewest common pairs.
    count = n - _common_pairs(n, _at_least((t, b), n), threshold) + 1
    pairs = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(_width(threshold)))),
    )
    marked = materialise(
        sets.select(
            "doc_id",
            "line_no",
            F.xxhash64("words").alias("set_a"),
            F.xxhash64(F.lit(1), "words").alias("set_b"),
            n.alias("n"),
            signature.alias("signature"),
            pairs.alias("prefix"),
        ),
        "line-sets",
    )
    keys = ["set_a", "set_b"]
    place = F.struct("doc_id", "line_no")
    distinct = (
        marked.groupBy(*keys)
        .agg(F.min(F.struct("doc_id", "line_no", "n", "signature", "prefix")).alias("first"))
        .select("first.*")
    )
    distinct = materialise(distinct, "distinct-lines")
    narrow = materialise(marked.select("doc_id", "line_no", *keys), "line-keys")
    discard(marked)
    near = materialise(_near_firsts(distinct, lines, ranks, threshold), "near-lines")
    firsts = narrow.groupBy(*keys).agg(F.min(place).alias("first"))
    # Of near sets the first line goes as well, of all others only the copies.
    kept_first = firsts.join(
        near.withColumn("near", F.lit(True)), firsts["first"].eqNullSafe(near["place"]), "left"
    ).select(*keys, "first", F.coalesce("near", F.lit(False)).alias("near"))
    copies = narrow.join(kept_first, keys).where(
        F.col("near") | ~place.eqNullSafe(F.col("first"))
    )
    return copies.select("doc_id", "line_no").distinct()


def _width(threshold: tuple[int, int]) -> int:
    """Words that are filed together: pairs, or single ones where similar sets need share no pair."""
    t, b = threshold
    return 2 if 2 * t > b else 1


def _common_pairs(n: Column, m: Column, threshold: tuple[int, int]) -> Column:
    """How many pairs similar sets of n and m words share at least; one or more, and grows with m."""
    t, b = threshold
    # c is t / (t + b) of n + m at least, and 3c - n - m pairs are shared.
    return _at_least((2 * t - b if _width(threshold) == 2 else t, t + b), n + m)


def _shared(distinct: DataFrame, part: int) -> DataFrame:
    """``word_pair, place, n, at, number, nth, one``: filed pairs of words that several sets have.

    ``number`` counts the sets of a pair from the earliest, ``one``; ``nth`` is equal for equal places.
    All sets of a pair are in the same of the ``PARTS``.
    """
    entries = distinct.select("doc_id", "line_no", "n", F.posexplode("prefix").alias("at", "word_pair"))
    entries = entries.where(F.pmod("word_pair", F.lit(PARTS)) == part)
    own = Window.partitionBy("word_pair").orderBy("doc_id", "line_no")
    numbered = entries.select(
        "*",
        F.row_number().over(own).alias("number"),
        F.rank().over(own).alias("nth"),
        F.lead("n").over(own).alias("next"),
        F.first(F.struct("doc_id", "line_no", "n", "at"))
        .over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("one"),
    )
    place = F.struct("doc_id", "line_no").cast(_PLACE).alias("place")
    return numbered.where("number > 1 OR next IS NOT NULL").select(
        "word_pair", place, "n", "at", "number", "nth", "one"
    )


def _may_be_similar(
    n: Column, at: Column, m: Column, other_at: Column, threshold: tuple[int, int]
) -> Column:
    """Whether sizes n and m fit, and enough pairs follow the places of the shared one."""
    t, b = threshold
    follow = F.least(n - at, m - other_at) >= _common_pairs(n, m, threshold)
    return (m * b >= n * t) & (n * b >= m * t) & follow


def _close(x: str, y: str, n: Column, m: Column, threshold: tuple[int, int]) -> Column:
    """Whether the signatures of sets of n and m words differ in no more bits than similar sets may."""
    t, b = threshold
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= n + m - _at_least((t, t + b), n + m) * 2


def _with_earliest(shared: DataFrame, signatures: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """``later, earlier``: each set and the earliest of each of its pairs, if their signatures are close."""
    n, m = F.col("n"), F.col("one.n")
    fits = _may_be_similar(n, F.col("at"), m, F.col("one.at"), threshold)
    earliest = F.struct("one.doc_id", "one.line_no").cast(_PLACE)
    pairs = shared.where("nth > 1").where(fits).select(
        F.col("place").alias("later"), earliest.alias("earlier"), n.alias("n"), m.alias("m")
    )
    place = F.struct("doc_id", "line_no").cast(_PLACE)
    x, y = (signatures.select(place.alias(f"{s}o"), F.col("signature").alias(f"{s}s")) for s in "xy")
    met = pairs.distinct().join(x, F.col("later") == F.col("xo")).join(y, F.col("earlier") == F.col("yo"))
    close = _close("xs", "ys", F.col("n"), F.col("m"), threshold)
    return met.where(close).select("later", "earlier").distinct()


def _with_all(
    shared: DataFrame, settled: DataFrame, signatures: DataFrame, threshold: tuple[int, int]
) -> DataFrame:
    """``later, earlier``: sets that are not settled, and all but the earliest of each of their pairs."""
    signed = signatures.select(F.struct("doc_id", "line_no").cast(_PLACE).alias("signed"), "signature")
    rest = shared.where("number > 1").drop("one")
    open_ = rest.where("number > 2").join(settled, F.col("place") == F.col("later"), "left_anti")
    asked = open_.groupBy("word_pair").agg(F.max("number").alias("last"))
    met = rest.join(asked, "word_pair").where("number <= last").drop("last", "number")
    met = met.join(signed, F.col("place") == F.col("signed")).drop("signed")
    met = materialise(
        met.join(settled.withColumn("done", F.lit(True)), F.col("place") == F.col("later"), "left")
        .drop("later"),
        "open-pairs",
    )
    x, y = met.where("done IS NULL").alias("x"), met.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    candidate = (
        (F.col("x.word_pair") == F.col("y.word_pair"))
        & (F.col("x.nth") > F.col("y.nth"))
        & _may_be_similar(n, F.col("x.at"), m, F.col("y.at"), threshold)
        & _close("x.signature", "y.signature", n, m, threshold)
    )
    pairs = x.join(y, candidate).select(F.col("x.place").alias("later"), F.col("y.place").alias("earlier"))
    found = materialise(pairs.distinct(), "rest")
    discard(met)
    return found


def wide_signature(words: str) -> Column:
    """A parity signature of ``64 * WIDE`` bits, in which every word flips one."""

    def part(k: int) -> Column:
        mine = F.filter(words, lambda w: F.shiftright(w, 6).bitwiseAND(F.lit(WIDE - 1)) == k)
        return F.aggregate(
            mine,
            F.lit(0).cast("bigint"),
            lambda s, w: s.bitwiseXOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), w.bitwiseAND(F.lit(63)).cast("int"))
            ),
        )

    return F.array(*[part(k) for k in range(WIDE)])


def _not_ruled_out(pairs: DataFrame, worded: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The ``pairs`` whose wide signatures differ in no more bits than similar sets may.

    The 64 bits of the first signature fill up on long lines; their words are too many to
    travel for every candidate.  Similar sets are never ruled out.
    """
    t, b = threshold
    slim = worded.select("own", F.size("words").alias("n"), "wide")
    x, y = slim.toDF("xo", "xn", "xs"), slim.toDF("yo", "yn", "ys")
    both = F.col("xn") + F.col("yn")
    differing = sum(
        (F.bit_count(F.get("xs", F.lit(k)).bitwiseXOR(F.get("ys", F.lit(k)))) for k in range(WIDE)),
        F.lit(0),
    )
    met = pairs.join(x, F.col("later") == F.col("xo")).join(y, F.col("earlier") == F.col("yo"))
    return met.where(differing <= both - _at_least((t, t + b), both) * 2).select("later", "earlier").distinct()


def _verified(
    pairs: DataFrame, lines: DataFrame, ranks: Column, threshold: tuple[int, int]
) -> DataFrame:
    """``later`` of the pairs whose words are similar, read from their lines once more."""
    t, b = threshold
    pairs = pairs.select("later", "earlier")
    asked = pairs.select(F.col("later").alias("place")).union(pairs.select("earlier")).distinct()
    asked = materialise(asked.select("place.*"), "asked-lines")
    small = broadcast_if_small(asked, asked.count(), BROADCAST_ROWS)
    found = lines.join(
        small.withColumnsRenamed({"doc_id": "asked_id", "line_no": "asked_no"}),
        F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("line_no") == F.col("asked_no")),
        "left_semi",
    )
    # Words are filed by place once, for both sides of the pairs: rows that repeat a line go.
    # Places are structs, never null, whose null ids compare as equal.
    worded = found.select(
        F.struct("doc_id", "line_no").cast(_PLACE).alias("own"),
        ordered_words(F.col("line"), ranks).alias("words"),
    )
    worded = materialise(
        worded.dropDuplicates(["own", "words"]).withColumn("wide", wide_signature("words")), "worded"
    )
    pairs = materialise(_not_ruled_out(pairs, worded, threshold), "near-pairs")
    x = worded.select(F.col("own").alias("xo"), F.col("words").alias("xw"))
    y = worded.select(F.col("own").alias("yo"), F.col("words").alias("yw"))
    shared = F.size(F.array_intersect("xw", "yw"))
    union = F.size("xw") + F.size("yw") - shared
    similar = materialise(
        pairs.join(x, F.col("later") == F.col("xo"))
        .join(y, F.col("earlier") == F.col("yo"))
        .where(shared * b >= union * t)
        .select("later")
        .distinct(),
        "similar",
    )
    discard(asked, worded, pairs)
    return similar


def _near_firsts(
    distinct: DataFrame, lines: DataFrame, ranks: Column, threshold: tuple[int, int]
) -> DataFrame:
    """``place`` of the first lines of sets that a similar set's first line precedes.

    ``distinct`` is removed as soon as it has been read.  Among many variants of a line one similar earlier line is enough.  So each is verified
    against the earliest lines that it shares pairs with first, and only the lines that these do
    not settle are verified against all.
    """
    parts = [materialise(_shared(distinct, part), "shared-pairs") for part in range(PARTS)]
    shared = reduce(DataFrame.unionByName, parts)
    signed = materialise(distinct.select("doc_id", "line_no", "signature"), "signatures")
    discard(distinct)
    star = materialise(_with_earliest(shared, signed, threshold), "earliest")
    settled = _verified(star, lines, ranks, threshold)
    discard(star)
    rest = _with_all(shared, settled, signed, threshold)
    discard(*parts, signed)
    found = settled.union(_verified(rest, lines, ranks, threshold))
    discard(rest)
    return found.select(F.col("later").alias("place")).distinct()


def _cleaned(docs: DataFrame, **parameters) -> DataFrame:
    """``row, kept, n_removed``: each row of ``docs`` as a struct, and its text cleaned.

    Columns of ``docs`` may have any names, as they stay inside ``row``.
    """
    gone = similar_earlier(docs.select("doc_id", "text"), **parameters)
    by_doc = gone.groupBy(F.col("doc_id").alias("gone_id")).agg(
        F.collect_set("line_no").alias("gone")
    )
    by_doc = materialise(by_doc, "gone-lines")
    by_doc = broadcast_if_small(by_doc, by_doc.count(), BROADCAST_ROWS)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(
        by_doc, F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("gone_id")), "left"
    )
    lines = F.split(text_of(F.col("row.text")), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    # One struct, so that the lines are split once and not for every place.
    once = F.array(F.struct(lines.alias("lines"), places.alias("places")))
    cleaned = F.transform(
        once,
        lambda d: F.struct(
            F.array_join(F.transform(d["places"], lambda i: F.get(d["lines"], i)), "\n").alias("text"),
            (F.size(d["lines"]) - F.size(d["places"])).cast("bigint").alias("n"),
        ),
    )[0]
    cleaned = joined.select("row", "gone", F.when(F.col("gone").isNotNull(), cleaned).alias("new"))
    return cleaned.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.col("new.text")).alias("kept"),
        F.coalesce("new.n", F.lit(0).cast("bigint")).alias("n_removed"),
    )


def without_similar_lines(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with ``kept``, its text without the removed lines, and ``n_removed``.

    Null texts stay null and lose nothing; null ids are one document.  Columns of ``docs``
    that have these two names are replaced.
    """
    mine = [c for c in docs.columns if c not in ("kept", "n_removed")]
    out = _cleaned(docs, **parameters)
    return out.select(*[F.col(f"row.`{c}`") for c in mine], "kept", "n_removed")


def deduplicate_lines(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with similar later lines taken out of ``text``; other columns as they are.

    Documents that lose every line stay, with an empty text.  ``n_chars`` is counted anew
    where the text changed.
    """
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        count = F.length("kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, count).otherwise(F.col("row.n_chars"))
    columns = [new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return _cleaned(docs, **parameters).select(*columns)


def line_dedup_counts(docs: DataFrame, **parameters) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_chars, kept_sha256`` for every row of ``docs``."""
    out = without_similar_lines(docs.select("doc_id", "text"), **parameters)
    kept = text_of("kept")
    return out.select(
        "doc_id",
        F.size(F.split(text_of("text"), "\n", -1)).cast("bigint").alias("n_lines"),
        "n_removed",
        F.length(kept).cast("bigint").alias("kept_chars"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )
