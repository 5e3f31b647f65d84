"""Near-duplicate groups of documents by SimHash and multi-index hashing.

A fingerprint of 64 bits is cut into two segments of 32.  Of two fingerprints within
``radius`` bits, one segment differs in at most ``radius // 2`` bits.  For a radius of 4
or 5 that is 2 bits: the ball of radius 1 around the one segment then meets the ball of
radius 1 around the other.  So every fingerprint is filed in the table of each segment
under the 33 values of such a ball; rows that share an entry are candidates, and their
complete distance is verified.  Cutting the ball in halves that meet keeps 66 entries for
each fingerprint instead of 1,058 probes, and 32-bit segments keep chance hits rare.

Only distinct fingerprints are filed, so copies cost nothing.  Where many near copies
share an entry, their links are found as a spanning forest: whatever a fingerprint
reaches is taken out of the search, so the groups are those of all links, without
writing out all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.llm.common import without_ids
from courier.llm.components import connected_components
from courier.sources.scratch import arrow_batches, discard, materialise

#: Shingles hashed before their bits are added up.
BLOCK = 32_768
#: Entries of up to this many fingerprints are compared pair by pair.
SMALL = 16
#: Words of the shingles that the pipeline's stage compares, and bits of its first search.
STAGE_WORDS, STAGE_RADIUS = 5, 5
#: Rows whose shingles are handed to a worker, and held as arrays, at a time.
SLICE = 256
#: Slots of the counts that order shingles by rarity; they change no result, only the work.
RARITY_SLOTS = 1 << 18
#: Numbers of 64 bits in the parity signature of a set.
WIDE = 16


def shingle_fingerprint(text: str | None, words: int) -> int:
    """The fingerprint of one text as an unsigned number; 0 without words."""
    import re

    import xxhash

    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return 0
    last = max(1, len(found) - words + 1)
    votes = np.zeros(64, dtype=np.int64)
    for low in range(0, last, BLOCK):
        hashes = np.array(
            [
                xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), 42)
                for i in range(low, min(last, low + BLOCK))
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str, text_column: str, words: int) -> DataFrame:
    """``id, fp``: one row per document, the fingerprint's bits as a bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_fingerprint(t.as_py(), words) for t in batch.column(1)]
            bits = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), bits], names=["id", "fp"])

    slim = docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string"))
    return slim.mapInArrow(run, "id bigint, fp bigint")


def _pairs_of_run(run: np.ndarray, radius: int) -> list[np.ndarray]:
    """Links that span the groups of one entry; ``run`` holds distinct fingerprints."""
    found = []
    rest = run
    while rest.size > 1:
        waiting, rest = [rest[:1]], rest[1:]
        while waiting and rest.size:
            for at in waiting.pop():
                near = np.bitwise_count(rest ^ at) <= radius
                if near.any():
                    hit, rest = rest[near], rest[~near]
                    found.append(np.stack([np.full(hit.size, at, dtype=np.uint64), hit]))
                    waiting.append(hit)
                if not rest.size:
                    break
    return found


def _links_of_sorted(keys: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Links among rows sorted by key, as two rows of fingerprints."""
    found = []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, keys.size])
    for start, length in zip(starts[lengths > SMALL], lengths[lengths > SMALL]):
        found += _pairs_of_run(np.unique(fps[start : start + length]), radius)
    small = np.repeat(lengths <= SMALL, lengths)
    for step in range(1, SMALL):
        same = (keys[step:] == keys[:-step]) & small[step:]
        if not same.any():
            break
        left, right = fps[:-step][same], fps[step:][same]
        near = np.bitwise_count(left ^ right) <= radius
        found.append(np.stack([left[near], right[near]]))
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), dtype=np.uint64)


def fingerprint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` whose groups are those of all pairs within ``radius`` bits.

    ``distinct`` has a bigint column ``fp`` without repeats.  ``radius`` is 0 to 5.
    """
    if not 0 <= radius <= 5:
        raise ValueError("the segment balls cover a radius of 0 to 5")
    fp = F.col("fp")
    flips = [F.lit(0), *(F.lit(1 << bit) for bit in range(32))] if radius > 1 else [F.lit(0)]
    segments = [
        F.shiftrightunsigned(fp, 32),
        fp.bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseXOR(F.lit(1 << 33)),
    ]
    entries = F.array(*[s.bitwiseXOR(flip) for s in segments for flip in flips])
    filed = distinct.select(F.explode(entries).alias("entry"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy()]
            fps = np.r_[fps, batch.column(1).to_numpy().view(np.uint64)]
            if not keys.size or keys[0] == keys[-1]:
                continue
            end = int(np.searchsorted(keys, keys[-1]))  # the last entry may go on
            yield _as_links(_links_of_sorted(keys[:end], fps[:end], radius))
            keys, fps = keys[end:], fps[end:]
        if keys.size:
            yield _as_links(_links_of_sorted(keys, fps, radius))

    return (
        filed.repartition("entry")
        .sortWithinPartitions("entry", "fp")
        .mapInArrow(run, "a bigint, b bigint")
        .distinct()
    )


def _as_links(pairs: np.ndarray) -> pa.RecordBatch:
    ends = [pa.array(end.view(np.int64)) for end in np.ascontiguousarray(pairs)]
    return pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def near_duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 4,
    radius: int = 4,
) -> DataFrame:
    """``id, fp, component_id`` for every document.

    Documents link if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id that links reach, the own one included.  Texts
    without words (null and empty ones too) have fingerprint 0 and link like any other.
    Documents with equal texts always share a group.  A null id keeps its row; its group
    is that of its fingerprint, whose smallest id that is not null names it (null if there
    is none).  Repeated ids keep a row each.
    """
    marked = materialise(fingerprints(docs, id_column, text_column, words), "fingerprints")
    distinct = materialise(
        marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints"
    )
    roots = connected_components(fingerprint_links(distinct.select("fp"), radius), "a", "b")
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = materialise(placed.join(named, "root").select("fp", "component_id"), "groups")
    return marked.join(groups, "fp").select("id", "fp", "component_id")


def fingerprint_hex(fp: str | Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- groups by similarity ------------------------------------------------------------


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``id, key, fp, n, wide, shingles``: the sorted distinct hashes of a text's shingles.

    ``key`` is a hash of the set, ``fp`` the fingerprint, ``n`` the size of the set and ``wide``
    a parity signature, in which every shingle flips one bit.  Null and empty texts have an
    empty set; null and repeated ids keep their rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import xxhash

        words_of = re.compile(rb"[^\x20\x09-\x0D]+").findall
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                own, keys, prints, wide = [], [], [], []
                for text in part.column(1).to_pylist():
                    found = words_of((text or "").encode("utf-8", "surrogatepass").lower())
                    last = max(1, len(found) - words + 1) if found else 0
                    hashes = np.array(
                        [xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), 42) for i in range(last)],
                        dtype="<u8",
                    )
                    votes = np.zeros(64, np.int64)
                    for at in range(0, last, BLOCK):
                        rows = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
                        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                    prints.append(np.packbits(votes * 2 > last, bitorder="little").view("<i8")[0])
                    own.append(np.unique(hashes).view(np.int64))
                    keys.append(xxhash.xxh64_intdigest(own[-1].tobytes(), 7))
                    flips = np.bincount(own[-1] % (64 * WIDE), minlength=64 * WIDE) & 1
                    wide.append(np.packbits(flips.astype(np.uint8)).view("<i8"))
                ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.array(keys, np.uint64).view(np.int64)),
                        pa.array(np.array(prints, np.int64)),
                        pa.array(np.diff(ends)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(own) + 1, dtype=np.int32) * WIDE), pa.array(np.concatenate(wide))
                        ),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own))),
                    ],
                    names=["id", "key", "fp", "n", "wide", "shingles"],
                )

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(
        run, "id bigint, key bigint, fp bigint, n int, wide array<bigint>, shingles array<bigint>"
    )


def _rarity(sets: DataFrame, slots: int) -> np.ndarray:
    """How often shingles of each of ``slots`` hash slots occur, over all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                flat = batch.column(0).slice(low, SLICE).flatten().to_numpy()
                total += np.bincount(flat % slots, minlength=slots)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "c"])

    counted = sets.select("shingles").mapInArrow(run, "slot bigint, c bigint")
    with arrow_batches(sets.sparkSession, SLICE):
        found = counted.groupBy("slot").agg(F.sum("c").alias("c")).toArrow()  # at most a row a slot
    out = np.zeros(slots, np.int64)
    out[found["slot"].to_numpy()] = found["c"].to_numpy()
    return out


def _prefixes(sets: DataFrame, slots: int) -> DataFrame:
    """``key, n, entry``: the rarest n - ceil(0.8 n) + 1 shingles of each set.

    Two sets of similarity 0.8 share one of these, whatever the order is, as long as it is
    the same for all; rarest first keeps shingles of common passages out.
    """
    counts = sets.sparkSession.sparkContext.broadcast(_rarity(sets, slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):  # sorting holds several copies
                yield _rarest(batch.slice(low, SLICE), counts.value)

    return sets.select("key", "n", "shingles").mapInArrow(run, "key bigint, n int, entry bigint")


def _rarest(batch: pa.RecordBatch, counts: np.ndarray) -> pa.RecordBatch:
    """The prefixes of a batch of ``key, n, shingles``."""
    flat = batch.column(2).flatten().to_numpy()
    n = batch.column(1).to_numpy()
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((flat, counts[flat % len(counts)], owner))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    first = place < np.repeat(n - (4 * n + 4) // 5 + 1, n)
    owner = owner[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(batch.column(0).to_numpy()[owner]),
            pa.array(n[owner]),
            pa.array(flat[order][first]),
        ],
        names=["key", "n", "entry"],
    )


def _not_ruled_out(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs (a, b)`` whose signatures differ in no more bits than similar sets may.

    Sets of n and m shingles with a similarity of 0.8 differ in (n + m) / 9 at most, and in no
    more bits; so none of these is ruled out, and the others' shingles need not travel.
    """
    slim = sets.select("key", "n", "wide").dropDuplicates(["key"])
    met = pairs.join(slim.toDF("a", "n", "x"), "a").join(slim.toDF("b", "m", "y"), "b")
    bits = (F.bit_count(F.get("x", F.lit(k)).bitwiseXOR(F.get("y", F.lit(k)))) for k in range(WIDE))
    return met.where(sum(bits, F.lit(0)) * 9 <= F.col("n") + F.col("m")).select("a", "b")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs (a, b)`` of keys whose sets have a Jaccard similarity of 0.8 or more."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = materialise(_not_ruled_out(pairs, sets), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    met = materialise(
        sets.join(ends, "key", "left_semi").groupBy("key").agg(F.any_value("shingles").alias("x")),
        "pair-sets",
    )
    left, right = met.select(F.col("key").alias("a"), "x"), met.toDF("b", "y")
    common = F.size(F.array_intersect("x", "y"))
    links = materialise(
        pairs.join(left, "a").join(right, "b")
        .where(common * 9 >= 4 * (F.size("x") + F.size("y"))).select("a", "b"),
        "links",
    )
    discard(pairs, met)
    return links


def _placed(entries: DataFrame, links: DataFrame) -> DataFrame:
    """``entries`` with the root of each key's group."""
    roots = connected_components(links, "a", "b").withColumnRenamed("node", "key")
    return entries.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))


def jaccard_groups(
    docs: DataFrame,
    words: int = STAGE_WORDS,
    radius: int = STAGE_RADIUS,
    slots: int = RARITY_SLOTS,
) -> DataFrame:
    """``id, component_id``: groups of all pairs with a Jaccard similarity of 0.8 or more.

    Candidates come from the fingerprints of five-word shingles first: rows of the segment
    tables within ``radius`` bits, verified on the whole sets, which links most copies along
    spanning trees.  At a similarity of 0.8 fingerprints differ in ten bits on average, often
    more, so what lies further apart is completed by rare shingles: sets that share one of
    their rarest, and are in different groups yet, are verified as well, first with one set of
    each shingle and then, where several groups are left, with all.  No pair is missed.  Texts
    without words are equal.  Null ids link, and have no part in naming a group.
    """
    sets = materialise(shingle_sets(docs, words), "sets", SLICE)
    full = sets.where("n > 0")
    prints = materialise(
        full.groupBy("fp").agg(F.min("key").alias("key"), F.max("key").alias("last")), "prints"
    )
    far = fingerprint_links(prints.select("fp"), radius)
    ends = [
        prints.select(F.col("fp").alias(side), F.col("key").alias(f"key_{side}")) for side in "ab"
    ]
    near = far.join(ends[0], "a").join(ends[1], "b").select(
        F.col("key_a").alias("a"), F.col("key_b").alias("b")
    )
    same = full.select("fp", F.col("key").alias("b")).join(
        prints.where("key <> last").select("fp", F.col("key").alias("a")), "fp"
    )
    links = _alike(near.unionByName(same.where("a <> b").select("a", "b")), full)

    filed = materialise(_prefixes(full, slots).distinct(), "entries", SLICE)
    shared = filed.groupBy("entry").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    kept = filed.join(shared.where("lo <> hi").select("entry"), "entry")
    entries = materialise(_placed(kept, links), "shared-entries")
    discard(filed, prints)
    near_sizes = "least(n, m) * 5 >= greatest(n, m) * 4"
    one = entries.groupBy("entry").agg(F.min(F.struct("root", "key", "n")).alias("one"))
    led = entries.join(one, "entry").select(
        F.col("key").alias("b"), "n", "root", F.col("one.key").alias("a"),
        F.col("one.n").alias("m"), F.col("one.root").alias("other"),
    )
    more = _alike(led.where("root <> other").where(near_sizes).select("a", "b"), full)
    links = links.unionByName(more)

    entries_now = materialise(_placed(entries.drop("root"), links), "placed")
    discard(entries)
    mixed = entries_now.groupBy("entry").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    rest = entries_now.join(mixed.where("lo <> hi").select("entry"), "entry")
    other = rest.select("entry", F.col("key").alias("b"), F.col("n").alias("m"), F.col("root").alias("r"))
    across = rest.join(other, "entry").where("key < b AND root <> r").where(near_sizes)
    last = _alike(across.select(F.col("key").alias("a"), "b"), full)
    roots = connected_components(links.unionByName(last), "a", "b").withColumnRenamed("node", "key")
    named = materialise(
        sets.select("id", "key").join(roots, "key", "left").select(
            "id", F.coalesce("root", "key").alias("root")
        ),
        "set-groups",
    )
    discard(entries_now, sets)
    return named.join(named.groupBy("root").agg(F.min("id").alias("component_id")), "root").select(
        "id", "component_id"
    )


def keep_one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of the smallest id of each group; all its columns.

    The groups are those of ``jaccard_groups``.  Rows that repeat the kept id stay
    together; documents with a null id all stay.
    """
    groups = jaccard_groups(docs)
    gone = groups.where("id <> component_id").select(F.col("id").alias("doc_id"))
    return without_ids(docs, gone, "near-duplicate-ids")
