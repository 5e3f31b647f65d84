"""Benchmark decontamination by spaced seeds of three words.

A document is contaminated if ``LEAST`` words of an item, or a share of ``SHARE`` of it
where that is fewer, stand in their places: on one diagonal, whatever stands between them.
The seeds miss no such passage.  Where k words of an item of n are in place, the gaps
between them add up to at most n - 1, so among the (k - 1) // 2 neighbouring pairs of gaps
one is at most ``reach(n)`` wide, and one gap of that pair at most half of it.  An item is
therefore filed under every three of its words within its reach.  A document is searched
for pairs within half the longest reach that occur in an item at all; only these are
completed to three words, after or before, and looked up, once for each three.  Each hit puts a document and
an item on a diagonal; along it the words are compared one by one.

Scripts written without spaces count character by character.  Items of fewer than
``SHORTEST`` words are too short to tell and match nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.llm.common import broadcast_if_small, text_of, without_ids
from courier.sources.scratch import materialise

SHORTEST = 5
LEAST, SHARE = 13, 0.8
#: Seeds up to which the benchmark's side is broadcast: 40 bytes each.
BROADCAST_SEEDS = 500_000
#: Words of a document that are searched as one row.
PIECE = 256


#: Characters of scripts that do not put spaces between words.  None is below U+0E00, which
#: is far cheaper to ask than the script.
UNSPACED = (
    r"([\x{E00}-\x{10FFFF}"
    r"&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]])"
)


def normal_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; each character of ``UNSPACED`` by itself."""
    spaced = F.regexp_replace(F.lower(text), UNSPACED, " $1 ")
    return F.filter(F.split(spaced, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _hashes(text: Column) -> Column:
    return F.transform(normal_words(text), lambda w: F.xxhash64(w))


def words_needed(words: int) -> int:
    """Words in place that make an overlap with an item of ``words`` words."""
    return min(LEAST, math.ceil(round(words * SHARE, 6)))


def reach(words: int) -> int:
    """Width within which some three of the words in place lie, for ``SHORTEST`` or more."""
    gaps = words_needed(words) - 1
    return (words - 1 - gaps % 2) // (gaps // 2)


def _pair(at: Column, gap: int) -> Column:
    return F.xxhash64(F.lit(gap), F.get("h", at), F.get("h", at + gap))


def _triple(at: Column, first: Column, second: Column) -> Column:
    """Words ``at``, ``first`` after it and ``second`` after that, counted from 0."""
    return F.xxhash64(
        first, second, F.get("h", at), F.get("h", at + first), F.get("h", at + first + second)
    )


def _item_seeds(items: DataFrame, widest: int) -> tuple[DataFrame, DataFrame]:
    """``seed, item, item_at`` of every three words within reach; ``pair`` of their pairs."""
    start = F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at")
    at = items.select("item", "h", "reach", start)
    both = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))
            for a in range(1, widest)
            for b in range(1, widest - a + 1)
        ]
    )
    inside = (F.col("e.a") + F.col("e.b") <= F.col("reach")) & (
        F.col("at") + F.col("e.a") + F.col("e.b") < F.size("h")
    )
    threes = at.select("item", "h", "reach", "at", F.explode(both).alias("e")).where(inside)
    seeds = threes.select(
        _triple(F.col("at"), F.col("e.a"), F.col("e.b")).alias("seed"),
        "item",
        F.col("at").alias("item_at"),
    ).distinct()
    gaps = F.array(*[F.struct(F.lit(g).alias("g"), _pair(F.col("at"), g).alias("p")) for g in _gaps(widest)])
    pairs = at.select("h", "at", F.explode(gaps).alias("e")).where(F.col("at") + F.col("e.g") < F.size("h"))
    return seeds, pairs.select(F.col("e.p").alias("pair")).distinct()


def _gaps(widest: int) -> range:
    return range(1, widest // 2 + 1)


def _pieces(hashed: DataFrame, length: int, margin: int) -> DataFrame:
    """``doc_id, h, at, low``: every place that a seed may begin at, with the words around it.

    ``h`` holds ``length`` words of a document and up to ``margin`` before and after them, from
    ``low`` on; ``at`` counts from there.  No row holds more, whatever the document's length.
    """
    start = F.when(F.size("h") > 2, F.sequence(F.lit(0), F.size("h") - 1, F.lit(length)))
    low = F.greatest(F.col("start") - margin, F.lit(0))
    pieces = hashed.select("doc_id", "h", F.explode(start).alias("start")).select(
        "doc_id",
        F.slice("h", low + 1, F.col("start") - low + length + margin).alias("h"),
        low.alias("low"),
        (F.col("start") - low).alias("first"),
    )
    last = F.least(F.col("first") + length, F.size("h")) - 1
    return pieces.select("doc_id", "h", "low", F.explode(F.sequence("first", last)).alias("at"))


def _thirds(widest: int) -> list[tuple[int, bool]]:
    """Third words for a pair: how far they lie, and whether before it.

    A gap that is narrow enough for a pair of its own needs no search from the pair behind
    it: that pair finds the same three words.
    """
    return [(o, False) for o in range(1, widest)] + [(o, True) for o in range(widest // 2 + 1, widest)]


def _document_seeds(pieces: DataFrame, pairs: DataFrame, widest: int) -> DataFrame:
    """``doc_id, h, low, at, seed`` of all three words that a pair of an item is part of."""
    entries = F.array(*[_pair(F.col("at"), g) for g in _gaps(widest)])
    filed = pieces.select("*", F.posexplode(entries).alias("g", "pair")).withColumn(
        "g", F.col("g") + _gaps(widest)[0]
    )
    met = filed.where(F.col("at") + F.col("g") < F.size("h")).join(pairs, "pair", "left_semi")
    at, g = F.col("at"), F.col("g")
    thirds = _thirds(widest)
    seeds = [
        F.when(
            (g + o <= widest) & ((at >= o) if before else (at + g + o < F.size("h"))),
            _triple(at - o, F.lit(o), g) if before else _triple(at, g, F.lit(o)),
        )
        for o, before in thirds
    ]
    threes = met.select("doc_id", "h", "low", "at", F.posexplode(F.array(*seeds)).alias("t", "seed"))
    back = F.array(*[F.lit(o if before else 0) for o, before in thirds])
    return threes.where(F.col("seed").isNotNull()).select(
        "doc_id", "h", "low", (at + F.col("low") - F.get(back, F.col("t"))).alias("at"), "seed"
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """``doc_id, item_id, shift, matched, needed``: verified overlaps that suffice.

    ``shift`` is the document's word position less the item's.  Rows with a null document
    id are searched, their overlaps have a null id.  Null texts are empty and match
    nothing; items with a null id count as items of their own.  Repeated rows give an
    overlap once for each id.
    """
    cut = materialise(
        benchmark.select(
            F.col(item_column).cast("bigint").alias("item_id"),
            _hashes(text_of(item_text)).alias("h"),
        )
        .where(F.size("h") >= SHORTEST)
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "h")),
        "items",
    )
    needed = F.least(F.lit(LEAST), F.ceil(F.size("h") * F.lit(SHARE)).cast("int"))
    reached = F.expr("(size(h) - 1 - (needed - 1) % 2) div ((needed - 1) div 2)").cast("int")
    items = cut.withColumn("needed", needed).withColumn("reach", reached)
    widest = max(items.agg(F.max("reach")).first()[0] or 0, 2)  # one number
    seeds, pairs = (
        materialise(side, label)
        for side, label in zip(_item_seeds(items, widest), ("seeds", "pairs"))
    )
    hashed = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), _hashes(text_of(text_column)).alias("h")
    )
    small = items.select("item", "item_id", "needed", F.col("h").alias("words"))
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    n_pairs = pairs.count()
    in_place = max(n_pairs, seeds.count()) <= broadcast_seeds
    near = broadcast_if_small(pairs, n_pairs, broadcast_seeds)
    if in_place:
        longest = items.agg(F.max(F.size("h"))).first()[0] or widest
        margin = max(longest, widest)
        hits = _document_seeds(_pieces(hashed, max(PIECE, margin), margin), near, widest)
        found = hits.join(F.broadcast(seeds), "seed").select("doc_id", "item", shift, "low", "h")
        found = found.join(F.broadcast(small), "item")
    else:  # rows that travel hold one place each
        hits = _document_seeds(_pieces(hashed, 1, widest), near, widest)
        slim = hits.join(seeds, "seed").select("doc_id", "item", shift).distinct()
        found = slim.join(hashed, slim["doc_id"].eqNullSafe(hashed["doc_id"])).select(
            slim["doc_id"], "item", "shift", F.lit(0).alias("low"), "h"
        )
        found = found.join(small, "item")
    # The document's words where the item would lie; fewer at the document's ends.
    at = F.col("shift") - F.col("low")
    ahead, skipped = F.greatest(at, F.lit(0)), F.greatest(-at, F.lit(0))
    same = F.zip_with(
        F.slice("words", skipped + 1, F.size("words")),
        F.slice("h", ahead + 1, F.greatest(F.size("words") - skipped, F.lit(0))),
        lambda a, b: a == b,
    )
    matched = F.size(F.filter(same, lambda s: s))
    return (
        found.select("doc_id", "item_id", "shift", matched.alias("matched"), "needed")
        .where("matched >= needed")
        .distinct()
    )


def contamination(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``doc_id, contaminated, n_items, item_id, matched`` for every row of ``docs``.

    ``item_id`` is the item with the most words in place (the smallest of equal ones) and
    ``matched`` their number; without an overlap they are -1 and 0.
    """
    found = overlaps(docs, benchmark, **parameters)
    best = found.groupBy("doc_id").agg(
        F.countDistinct("item_id").alias("n_items"),
        F.max(F.struct("matched", (-F.col("item_id")).alias("least"))).alias("best"),
    )
    ids = docs.select(F.col("doc_id").cast("bigint"))
    joined = ids.join(
        best.withColumnRenamed("doc_id", "found_id"),
        F.col("doc_id").eqNullSafe(F.col("found_id")),
        "left",
    )
    return joined.select(
        "doc_id",
        F.col("best").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce(-F.col("best.least"), F.lit(-1)).alias("item_id"),
        F.coalesce("best.matched", F.lit(0)).cast("bigint").alias("matched"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; all their columns.

    Of a repeated id all rows go if one is contaminated; rows with a null id are kept.
    """
    return without_ids(docs, overlaps(docs, benchmark).select("doc_id"), "contaminated-ids")
