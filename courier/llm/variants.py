"""Spelling variants: words one edit apart, each rare one led to its frequent form.

Two words are near if one code point was inserted, deleted or replaced: their common prefix
and common suffix together reach the longer one's length less one.  Near words share either
the first half of the shorter one's length or the rest of it at the end, so words are filed
under both; each goes where words of its own length look for it, and where words one shorter
do.  Inside a file, blocks of words stand as padded matrices of code points, left-aligned
for prefixes and right-aligned for suffixes, and pairs of blocks are compared as dense tiles.
A file of more than ``FILE_WORDS`` words is dealt into parts, and each pair of parts is a task
of its own, so no file meets in one task.  Only near pairs leave a tile.

Words are counted in the tasks that read the texts; what is shuffled are a task's distinct
words with their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.llm.common import text_of
from courier.sources.scratch import materialise

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10

#: Different words that a task counts before it hands them over.
COUNTED_WORDS = 500_000
#: Words of a file, or of one of its parts.
FILE_WORDS = 4096
#: Rows of a block, and cells of its matrix.
BLOCK_ROWS, BLOCK_CELLS = 128, 1 << 20
#: Filed words that are compared at a time.
CHUNK_ROWS = 20_000

NEAR = "word string, other string, n bigint"


# --- words -------------------------------------------------------------------------


def _shortened(run: bytes, number: int) -> bytes:
    """The run without the code point ``number % length``."""
    if b"\xc3" not in run:  # one byte a code point
        at = number % len(run)
        return run[:at] + run[at + 1 :]
    text = run.decode()
    at = number % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _length(word: bytes) -> int:
    return len(word) - word.count(b"\xc3")


def word_counts(
    docs: DataFrame,
    shorten_one_in: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``word, n``: runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, counted over all texts.

    Only words of ``least_length`` code points and ``least_count`` occurrences.  With
    ``shorten_one_in``, a run whose ``crc32("<id>:<run>")`` is a multiple of that number loses
    the code point ``crc32 % length`` before it is counted.  Null texts hold no words, a null
    id counts as the empty text, repeated rows count each time, and an empty table gives no
    rows.  Other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        from collections import Counter

        # In UTF-8, U+00C0 to U+00FF are C3 and one more byte, and C3 begins nothing else.
        runs_of = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+").findall
        total: dict[bytes, int] = {}

        def counted() -> pa.RecordBatch:
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            counts = pa.array(total.values(), pa.int64())
            return pa.RecordBatch.from_arrays([words, counts], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                begun = crc32(f"{key}:".encode())
                for word, n in Counter(runs_of(text.encode().lower())).items():
                    if len(word) < least_length:
                        continue
                    if shorten_one_in:
                        number = crc32(word, begun)
                        if number % shorten_one_in == 0:
                            word = _shortened(word, number)
                    if _length(word) >= least_length:
                        total[word] = total.get(word, 0) + n
                if len(total) > COUNTED_WORDS:
                    yield counted()
                    total.clear()
        yield counted()

    slim = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")), text_of(text_column)
    )
    partial = slim.mapInArrow(run, "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- near words --------------------------------------------------------------------


def _matrix(words: list[str]) -> np.ndarray:
    """Code points, a row per word, padded with zeros on the right."""
    width = max(1, max(map(len, words)))
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


class _Block:
    """A few consecutive filed words as matrices; U+0000 is in no word."""

    def __init__(self, rows: dict[str, np.ndarray], low: int, high: int) -> None:
        words = rows["word"][low:high].tolist()
        self.low = low
        self.length = np.array([len(w) for w in words])
        self.left = _matrix(words)
        self.right = _matrix([w[::-1] for w in words])
        self.file = rows["group"][low:high]
        self.part = rows["part"][low:high]
        self.short = rows["short"][low:high]
        self.head = rows["head"][low:high]
        self.inside = rows["inside"][low:high]


def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every row of ``x`` and every row of ``y``."""
    alike = np.ones((len(x), len(y)), bool)
    length = np.zeros(alike.shape, np.int32)
    for k in range(min(x.shape[1], y.shape[1])):
        alike &= (x[:, k, None] == y[None, :, k]) & (x[:, k, None] != 0)
        if not alike.any():
            break
        length += alike
    return length


def _tile(x: _Block, y: _Block) -> tuple[np.ndarray, np.ndarray]:
    """Rows of near words of two blocks, each pair of a file once over all its tiles."""
    prefix, suffix = _shared(x.left, y.left), _shared(x.right, y.right)
    longer = np.maximum(x.length[:, None], y.length[None, :])
    shorter = np.minimum(x.length[:, None], y.length[None, :])
    near = (prefix + suffix >= longer - 1) & (longer - shorter <= 1)
    near &= (x.file[:, None] == y.file[None, :]) & (shorter == x.short[:, None])
    near &= x.inside[:, None] | (x.part[:, None] != y.part[None, :])
    # A pair whose first halves agree belongs to the file of that half alone.
    near &= (prefix >= x.short[:, None] // 2) == x.head[:, None]
    i, j = np.nonzero(near)
    i, j = i + x.low, j + y.low
    return i[i < j], j[i < j]


def _near_pairs(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Near rows of whole files, given in order of their file."""
    starts, low, total = [], 0, len(rows["word"])
    lengths = np.array([max(1, len(w)) for w in rows["word"]])
    while low < total:
        high = min(low + BLOCK_ROWS, total)
        high = low + max(1, min(high - low, int(BLOCK_CELLS // lengths[low:high].max())))
        starts.append((low, high))
        low = high
    found: list[tuple[np.ndarray, np.ndarray]] = []
    last = np.searchsorted(rows["group"], rows["group"], side="right")
    for number, (low, high) in enumerate(starts):
        x = _Block(rows, low, high)
        found.append(_tile(x, x))
        for other in starts[number + 1 :]:
            if other[0] >= last[high - 1]:
                break
            found.append(_tile(x, _Block(rows, *other)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def _filed(words: DataFrame) -> DataFrame:
    """``file, short, head, word, n``: every word under its four half words."""
    size = F.char_length("word")
    files = []
    for short in (size, size - 1):  # as one of the shorter length, as the longer one
        half = (short / 2).cast("int")
        for head, part in (
            (True, F.substring(F.col("word"), F.lit(1), half)),
            (False, F.substring(F.col("word"), size - (short - half) + 1, short - half)),
        ):
            files.append(
                F.struct(
                    F.xxhash64(short, F.lit(head), part).alias("file"),
                    short.alias("short"),
                    F.lit(head).alias("head"),
                )
            )
    return words.select("word", "n", F.explode(F.array(*files)).alias("f")).select(
        "f.file", "f.short", "f.head", "word", "n"
    )


def near_words(words: DataFrame, file_words: int = FILE_WORDS) -> DataFrame:
    """``word, other, n``: every near pair of ``words (word, n)`` in both directions.

    ``n`` is the other word's count.  Words are distinct and not null; it is best to write
    them first.  Hashed files may hold words of other halves as well: each pair is compared
    in full, so these add nothing.
    """
    filed = _filed(words)
    sizes = filed.groupBy("file").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if(F.char_length("word") == F.col("short")).alias("own"),
    )
    # A file with one word, or without one of its own length, has no pairs.
    sizes = sizes.where("size > 1 AND own > 0").select(
        "file", F.ceil(F.col("size") / file_words).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64(F.lit(1), "word"), F.col("parts")).cast("int")
    dealt = filed.join(sizes, "file").withColumn("part", part)
    # Part p of n meets part q in the task of (lesser, greater); with itself in (p, p).
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda q: F.struct(F.least("part", q).alias("p"), F.greatest("part", q).alias("q")),
    )
    tiles = dealt.withColumn("tile", F.explode(meets)).select(
        "short", "file", F.col("tile.p").alias("p"), F.col("tile.q").alias("q"),
        "head", "part", "word", "n",
    )
    sorted_tiles = tiles.repartition("file", "p", "q").sortWithinPartitions("short", "file", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= CHUNK_ROWS:
                table = pa.Table.from_batches(waiting)
                ends = _ends(table)
                if len(ends) > 1:  # the last file may go on
                    yield _compared(table.slice(0, ends[-2]))
                    waiting = table.slice(ends[-2]).combine_chunks().to_batches()
        if waiting:
            yield _compared(pa.Table.from_batches(waiting))

    return sorted_tiles.mapInArrow(run, NEAR)


def _ends(table: pa.Table) -> np.ndarray:
    """Where each run of rows of one file and tile ends."""
    key = np.stack([table[c].to_numpy().astype(np.int64) for c in ("file", "p", "q")])
    change = (key[:, 1:] != key[:, :-1]).any(axis=0)
    return np.append(np.flatnonzero(change) + 1, table.num_rows)


def _compared(table: pa.Table) -> pa.RecordBatch:
    ends = _ends(table)
    sizes = np.diff(np.concatenate([[0], ends]))
    rows = {
        "group": np.repeat(np.arange(len(ends)), sizes),
        "word": np.array(table["word"].to_pylist(), object),
        "short": table["short"].to_numpy(),
        "head": table["head"].to_numpy(),
        "part": table["part"].to_numpy(),
        "inside": table["p"].to_numpy() == table["q"].to_numpy(),
    }
    i, j = _near_pairs(rows)
    one, other = np.concatenate([i, j]), pa.array(np.concatenate([j, i]))
    word = table["word"].combine_chunks()
    return pa.RecordBatch.from_arrays(
        [word.take(pa.array(one)), word.take(other), table["n"].combine_chunks().take(other)],
        names=["word", "other", "n"],
    )


# --- forms -------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms (word, form)``: the end of each word's chain of forms.

    Every form is at least ``TIMES`` times as frequent, so chains are short and never
    close; each round doubles the steps taken.
    """
    forms = materialise(forms, "forms")
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = roots.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")
        )
        after = materialise(after, "roots")
        moved = after.where("went").isEmpty()
        roots = after.select("word", "root")
        if moved:
            return roots


def spelling_variants(words: DataFrame, times: int = TIMES, **tiling) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words (word, n)``.

    ``n_near`` counts the near words.  ``form`` is the one with the largest count, of equals
    the first in code-point order, if its count is at least ``times`` the word's own; else
    it and ``form_n`` are null.  ``root`` follows the forms to the last; a word without a form
    is its own.  No words give no rows.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its word")
    words = materialise(words.select("word", "n"), "words")
    near = near_words(words, **tiling)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("n")).alias("less"), F.col("other"))).alias("best"),
    )
    joined = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        (-F.col("best.less")).alias("most"),
        F.col("best.other").alias("other"),
    )
    leads = F.col("most") >= F.col("n") * times
    table = materialise(
        joined.select(
            "word",
            F.when(leads, F.col("other")).alias("form"),
            "n",
            "n_near",
            F.when(leads, F.col("most")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(table.where("form IS NOT NULL").select("word", "form"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
