"""Removal of repeated byte strings, from sorted contexts of several documents at once.

A byte goes if it lies in a string of ``length`` bytes (a window) that also starts earlier:
in a document of a smaller id, or further up in the same one.  Windows are compared across
all documents, on the input.

Anchors.  Each window takes the gram of ``GRAM`` bytes with the least hash in it as its
anchor.  Equal windows have the same anchor at the same place, so only windows around equal
grams need to be compared; an anchor serves about 35 windows in a row, and together they are
its context.  Grams that occur once in the corpus cannot anchor a repeat.  A bitmap of
fixed size lets the others through; what it lets through needlessly costs time only.

Of equal contexts all but the first repeat an earlier one.  They are told apart where they
are read, so that a text with a period sends one of each on; those that are left are dealt
out by gram and sorted, so that equal ones follow each other.  That takes hashes and places; the bytes of a context are read
again only where a gram has several different ones.

Different contexts of one gram share some of their windows at most.  These are found column
by column: round by round one more symbol of every context of the collection is taken in,
away from the gram to the right, then to the left, and the sorted order of the contexts is
refined by it, as in the column-wise construction of a suffix array for many documents.
Contexts that stay together have a common prefix as long as the rounds so far; one that
stands alone is out.  A window with l bytes left of the gram and r right of it is the pair
of its places in the left order after l rounds and the right order after r rounds, so
windows are compared by content, not by hash.  The rows arrive sorted from shuffle files,
and whole grams are taken in batches of bounded size.

A gram with more than ``MOST_CONTEXTS`` different contexts is not brought together: its
windows are dealt out one by one by their hashes, in an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.llm.common import text_of
from courier.sources.scratch import materialise

LENGTH = 100
GRAM = 32
#: Bytes of a document that are hashed at once.
CHUNK = 1 << 22
_PLACE_BITS = 24
#: Bits of the bitmap of repeated grams.
BITMAP_BITS = 27
#: Contexts that one batch of the column-wise order holds, and a single gram at most.
BATCH_CONTEXTS = 40_000
MOST_CONTEXTS = 20_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of each run of GRAM bytes (a power of two), from halves of halves."""
    h = _mix((raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    size = 1
    while size < GRAM:
        h = _mix(h[:-size] * np.uint64(0x94D049BB133111EB) + h[size:])
        size *= 2
    return h


def _window_least(v: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbours."""
    done = 1
    while done * 2 <= size:
        v = np.minimum(v[:-done], v[done:])
        done *= 2
    if done < size:
        v = np.minimum(v[: v.size - (size - done)], v[size - done :])
    return v


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Gram hash, place of the gram, first window and number of windows of each anchor."""
    out = []
    whole = np.frombuffer(raw, dtype=np.uint8)
    for low in range(0, len(raw) - length + 1, CHUNK):
        h = gram_hashes(whole[low : low + CHUNK + length - 1])
        places = np.arange(h.size, dtype=np.uint64)
        keyed = (h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | places
        least = _window_least(keyed, length - GRAM + 1)
        at = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        count = np.diff(np.r_[first, at.size])
        out.append((h[at[first]], at[first] + low, first + low, count))
    if not out:
        empty = np.empty(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    return tuple(np.concatenate(column) for column in zip(*out))


def _numbered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id`` (null as the least), ``h`` (a hash of the text) and ``text``."""
    text = text_of(text_column)
    return docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63))).alias("id"),
        F.hash(text).alias("h"),
        text.alias("text"),
    )


def _bitmap(slots: DataFrame) -> np.ndarray:
    """Bits of the bigint column ``slot``, of a fixed size whatever the input."""
    slot = F.col("slot").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int")
    )
    words = slots.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    got = words.toArrow()  # at most 2 ** (BITMAP_BITS - 6) rows
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    bitmap[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return bitmap.view(np.uint64)


def _is_set(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slot = slots & np.uint64((1 << BITMAP_BITS) - 1)
    word = bitmap[(slot >> np.uint64(6)).astype(np.int64)]
    return (word >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _repeated_grams(rows: DataFrame, length: int) -> np.ndarray:
    """The bitmap of grams that anchor more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [anchors(t.encode(), length)[0] for t in batch.column(0).to_pylist()]
            if grams:
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"]
                )

    counted = rows.select("text").mapInArrow(run, "gram bigint, n bigint")
    repeated = counted.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    return _bitmap(repeated.select(F.col("gram").alias("slot")))


def _place_slots(ids: np.ndarray, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Slots of a context by its document and first window."""
    word = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    word = _mix(word ^ h.astype(np.int64).view(np.uint64))
    return _mix(word * np.uint64(0x94D049BB133111EB) + starts.astype(np.int64).view(np.uint64))


#: Columns of a context; ``start`` is the first window's, ``place`` the gram's distance from it.
_CONTEXT = "id bigint, h int, gram bigint, place int, start bigint, windows int"


def _anchored(batch: pa.RecordBatch, length: int, keep) -> tuple[list, list[bytes]]:
    """Columns of the contexts in ``id, h, text`` rows that ``keep`` lets through; bytes."""
    columns, pieces = [], []
    ids = batch.column(0).to_numpy()
    hashes = batch.column(1).to_numpy()
    for number, text in enumerate(batch.column(2).to_pylist()):
        raw = text.encode()
        gram, at, first, count = anchors(raw, length)
        kept = keep(np.full(gram.size, ids[number]), np.full(gram.size, hashes[number]), gram, first)
        gram, at, first, count = gram[kept], at[kept], first[kept], count[kept]
        columns.append((np.full(gram.size, number), gram, at - first, first, count))
        ends = (first + count + length - 1).tolist()
        pieces += [raw[a:b] for a, b in zip(first.tolist(), ends)]
    number, gram, place, first, count = (np.concatenate(c) for c in zip(*columns))
    return [
        pa.array(ids[number], pa.int64()),
        pa.array(hashes[number], pa.int32()),
        pa.array(gram.view(np.int64)),
        pa.array(place.astype(np.int32)),
        pa.array(first, pa.int64()),
        pa.array(count.astype(np.int32)),
    ], pieces


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """Possible repeats, each with the hash of its bytes."""
    bitmap = rows.sparkSession.sparkContext.broadcast(_repeated_grams(rows, length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        keep = lambda ids, h, gram, first: _is_set(bitmap.value, gram)
        for batch in batches:
            if batch.num_rows:
                columns, pieces = _anchored(batch, length, keep)
                hashed = np.array([xxhash.xxh64_intdigest(p) for p in pieces], dtype=np.uint64)
                columns.append(pa.array(hashed.view(np.int64)))
                columns.append(pa.array(_copies_within(columns)))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["id", "h", "gram", "place", "start", "windows", "hash", "copy"]
                )

    return rows.mapInArrow(run, f"{_CONTEXT}, hash bigint, copy boolean")


def _copies_within(columns: list[pa.Array]) -> np.ndarray:
    """Which contexts of a batch repeat an earlier one of the same batch."""
    ids, h, gram, place, start, _, hashed = (c.to_numpy() for c in columns)
    order = np.lexsort((start, h, ids, hashed, place, gram))
    keys = [column[order] for column in (gram, place, hashed)]
    where = [column[order] for column in (ids, h, start)]
    copy = np.zeros(order.size, dtype=bool)
    copy[order] = _copies_of_sorted(keys, where)[0]
    return copy


def _copies_of_sorted(keys: list, where: list) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key and place: which are copies, and which begin a key.

    The same place again is a row repeated in the input, not a copy.
    """
    new = np.ones(keys[0].size, dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    of = first[np.cumsum(new) - 1]
    return ~new & np.any([w != w[of] for w in where], axis=0), first


def _settled(contexts: DataFrame) -> DataFrame:
    """Copies of contexts, and the first of each where a gram has several different ones.

    ``different`` is 0 for a copy, else the number of different contexts of its gram.  Rows
    come sorted; what is held between batches are the first contexts of one gram.
    """
    names = ["gram", "place", "hash", "id", "h", "start", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(names) + 1)]
            known = rows.pop()
            if known.any():  # copies found where they were read only pass through
                at = np.flatnonzero(known)
                yield out(rows, at, np.zeros(at.size, dtype=np.int32))
                rows = [column[~known] for column in rows]
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows)]
            if not rows[0].size:
                continue
            gram, place, hashed, ids, h, start, _ = rows
            copy, first = _copies_of_sorted([gram, place, hashed], [ids, h, start])
            last = gram[first] == gram[-1]
            yield out(rows, np.flatnonzero(copy), np.zeros(int(copy.sum()), dtype=np.int32))
            yield grown(rows, first[~last])
            held = [column[first[last]] for column in rows]
        if held is not None:
            yield grown(held, np.arange(held[0].size))

    def grown(rows: list, firsts: np.ndarray) -> pa.RecordBatch:
        _, group, n = np.unique(rows[0][firsts], return_inverse=True, return_counts=True)
        several = n[group] > 1
        return out(rows, firsts[several], n[group][several].astype(np.int32))

    def out(rows: list, at: np.ndarray, different: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(rows[names.index(c)][at]) for c in ("id", "h", "gram", "start", "windows")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(different)],
            names=["id", "h", "gram", "start", "windows", "different"],
        )

    # Copies may be many to a gram, as in periodic texts; they are spread by a salt.
    salt = F.when(F.col("copy"), F.xxhash64("id", "start") % 1024).otherwise(F.lit(-1))
    return (
        contexts.select(*names, "copy")
        .repartition("gram", salt)
        .sortWithinPartitions("gram", "place", "hash", "id", "h", "start")
        .mapInArrow(run, "id bigint, h int, gram bigint, start bigint, windows int, different int")
    )


def _with_bytes(rows: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """The contexts of ``firsts`` with their bytes, read once more.

    A few others come along, as the bitmap of places has no more than its fixed size;
    they are contexts like any other.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _place_slots(*(batch.column(i).to_numpy() for i in range(3)))
            yield pa.RecordBatch.from_arrays([pa.array(slot.view(np.int64))], names=["slot"])

    places = firsts.select("id", "h", "start").mapInArrow(slots, "slot bigint")
    bitmap = rows.sparkSession.sparkContext.broadcast(_bitmap(places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = lambda ids, h, gram, first: _is_set(bitmap.value, _place_slots(ids, h, first))
        for batch in batches:
            if batch.num_rows:
                columns, pieces = _anchored(batch, length, keep)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(pieces, pa.binary())],
                    names=["id", "h", "gram", "place", "start", "windows", "context"],
                )

    return rows.mapInArrow(run, f"{_CONTEXT}, context binary")


def _refine(classes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Places in the order after one more symbol; -1 for contexts that stand alone.

    ``classes`` are places so far, -1 for contexts that are out.
    """
    out = np.full(classes.size, -1, dtype=np.int64)
    active = np.flatnonzero(classes >= 0)
    if active.size:
        _, place, n = np.unique(
            classes[active] * 256 + symbols[active], return_inverse=True, return_counts=True
        )
        out[active] = np.where(n[place] > 1, place, -1)
    return out


def repeated_windows(
    grams: np.ndarray, places: np.ndarray, contexts: list[bytes], length: int
) -> np.ndarray:
    """Which windows of each context repeat one of a context before it.

    Contexts must come in the order of their grams' places in the corpus.  The result has a
    column for each number of bytes left of the gram, up to ``length - GRAM``.
    """
    n, most = len(contexts), length - GRAM
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    left_room, right_room = places, sizes - places - GRAM
    _, group, count = np.unique(grams, return_inverse=True, return_counts=True)
    group = np.where(count[group] > 1, group, -1).astype(np.int64)

    def take(column: np.ndarray, room: np.ndarray, classes: np.ndarray, depth: int) -> np.ndarray:
        classes = np.where(room >= depth, classes, -1)
        safe = np.where(classes >= 0, column, 0)
        return _refine(classes, text[safe].astype(np.int64))

    right = np.full((most + 1, n), -1, dtype=np.int64)
    right[0] = group
    for depth in range(1, most + 1):
        column = starts + places + GRAM + depth - 1
        right[depth] = take(column, right_room, right[depth - 1], depth)
    found = np.zeros((n, most + 1), dtype=bool)
    left = group
    for depth in range(0, most + 1):
        if depth:
            left = take(starts + places - depth, left_room, left, depth)
        other = right[most - depth]
        both = np.flatnonzero((left >= 0) & (other >= 0))
        if both.size:
            _, first, inverse = np.unique(
                left[both] * (n + 1) + other[both], return_index=True, return_inverse=True
            )
            found[both, depth] = first[inverse] != np.arange(both.size)
    return found


def _spans(found: np.ndarray, places: np.ndarray, starts: np.ndarray, length: int):
    """Context number, first and last byte (exclusive) of each run of repeated windows."""
    padded = np.zeros((found.shape[0], found.shape[1] + 2), dtype=np.int8)
    padded[:, 1:-1] = found
    change = np.diff(padded, axis=1)
    row, low = np.nonzero(change == 1)
    _, high = np.nonzero(change == -1)
    # Columns count bytes left of the gram: the farther left, the earlier the window.
    gram = starts[row] + places[row]
    return row, gram - (high - 1), gram - low + length


def _spans_of_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """``id, h, low, high``: repeated windows among different contexts of a gram."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        order = table.append_column(
            "gram_at", pa.array(table["start"].to_numpy() + table["place"].to_numpy())
        ).sort_by([("id", "ascending"), ("h", "ascending"), ("gram_at", "ascending")])
        # A row repeated in the input is one document.
        same = np.zeros(order.num_rows, dtype=bool)
        same[1:] = True
        for name in ("id", "h", "gram_at"):
            column = order[name].to_numpy()
            same[1:] &= column[1:] == column[:-1]
        order = order.filter(pa.array(~same))
        places = order["place"].to_numpy().astype(np.int64)
        found = repeated_windows(
            order["gram"].to_numpy(), places, order["context"].to_pylist(), length
        )
        row, low, high = _spans(found, places, order["start"].to_numpy(), length)
        taken = order.select(["id", "h"]).take(pa.array(row)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(taken["id"].to_numpy(), pa.int64()),
                pa.array(taken["h"].to_numpy(), pa.int32()),
                pa.array(low, pa.int64()),
                pa.array(high, pa.int64()),
            ],
            names=["id", "h", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < BATCH_CONTEXTS:
                continue
            table = pa.Table.from_batches(held)
            gram = table["gram"].to_numpy()
            end = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on
            if end:
                yield solve(table.slice(0, end))
            held = table.slice(end).combine_chunks().to_batches()
            rows -= end
        if held:
            yield solve(pa.Table.from_batches(held))

    return (
        contexts.select("gram", "id", "h", "place", "start", "context")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(run, "id bigint, h int, low bigint, high bigint")
    )


def _spans_of_large_grams(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams with any number of contexts: windows dealt out by hash."""
    windows = contexts.select(
        "id",
        "h",
        "gram",
        "start",
        "place",
        "context",
        F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("w"),
    )
    piece = F.substring("context", F.col("w") + 1, F.lit(length))
    keyed = windows.select(
        F.struct("id", "h", (F.col("start") + F.col("w")).alias("at")).alias("window"),
        "gram",
        F.xxhash64(piece).alias("a"),
        F.xxhash64(F.lit(1), piece).alias("b"),
    )
    keys = ["gram", "a", "b"]
    first = keyed.groupBy(*keys).agg(F.min("window").alias("first"), F.count("*").alias("n"))
    again = keyed.join(first.where("n > 1"), keys).where("window <> first")
    return again.select(
        "window.id", "window.h", F.col("window.at").alias("low"), (F.col("window.at") + length).alias("high")
    )


def repeated_spans(
    docs: DataFrame, id_column: str, text_column: str, length: int, most_contexts: int
) -> DataFrame:
    """``id, h, low, high``: byte ranges that repeat; they may overlap."""
    rows = _numbered(docs, id_column, text_column)
    settled = materialise(_settled(_contexts(rows, length)), "settled-contexts")
    end = F.col("start") + F.col("windows") + (length - 1)
    copies = settled.where("different = 0").select(
        "id", "h", F.col("start").alias("low"), end.alias("high")
    )
    firsts = settled.where("different > 0")
    contexts = _with_bytes(rows, firsts, length)
    large_grams = materialise(
        firsts.where(F.col("different") > most_contexts).select("gram").distinct(), "large-grams"
    )
    if large_grams.isEmpty():
        return copies.unionByName(_spans_of_contexts(contexts, length))
    small = contexts.join(large_grams, "gram", "left_anti")
    large = contexts.join(large_grams, "gram", "left_semi")
    return (
        copies.unionByName(_spans_of_contexts(small, length))
        .unionByName(_spans_of_large_grams(large, length))
    )


def _merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as ranges that do not touch."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    begins = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
    return low[begins], high[np.r_[begins[1:] - 1, low.size - 1]]


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    most_contexts: int = MOST_CONTEXTS,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``.

    ``kept`` holds the bytes that stay.  Texts are UTF-8 bytes, null is empty, and texts
    shorter than ``length`` (at least 2 * GRAM) stay whole.  Null ids come first.  Rows that
    repeat an id with another text count as documents of their own, in the order of a hash;
    rows that repeat id and text as one document, so they do not remove each other.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    spans = repeated_spans(docs, id_column, text_column, length, most_contexts)
    by_doc = spans.groupBy("id", "h").agg(
        F.collect_list("low").alias("low"), F.collect_list("high").alias("high")
    )
    rows = _numbered(docs, id_column, text_column).join(by_doc, ["id", "h"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, runs, kept = [], [], [], []
            for text, low, high in zip(*(c.to_pylist() for c in batch.columns[1:])):
                raw = text.encode()
                size.append(len(raw))
                if not low:
                    removed.append(0), runs.append(0), kept.append(raw)
                    continue
                begin, end = _merged(np.array(low), np.array(high))
                edges = zip([0, *end.tolist()], [*begin.tolist(), len(raw)])
                left = b"".join(raw[a:b] for a, b in edges)
                kept.append(left)
                removed.append(len(raw) - len(left))
                runs.append(len(begin))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in (size, removed, runs)),
                    pa.array(kept, pa.binary()),
                ],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    out = rows.select("id", "text", "low", "high").mapInArrow(
        run, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
    no_id = F.col("id") == F.lit(-(1 << 63))
    return out.select(
        F.when(~no_id, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept"
    )
