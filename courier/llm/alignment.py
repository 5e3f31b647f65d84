"""Alignment of two tokenizers' tokens on the bytes of a text.

Both tokenizers encode the same bytes: a space and the text.  Where a token of each ends at
the same byte, the text is cut; the tokens between two cuts are a group, and every token of
one side is linked to every token of the other side of its group.

The work is done on Arrow columns, a slice of documents at a time.  The lists of ids are
flattened with the index of their document, token lengths are summed up inside each document
to byte ends, and a hash join on (document, end) finds the ends that both sides share; groups
are counted off between them.  Links of a group with a single token on a side follow from its
number; for all others a second hash join, on the group, makes them.  They are counted by
document and id pair.  In a group with many tokens equal ids are counted first, so
a long run of one character makes no rows for each pair of its tokens.

How many documents hold a pair is counted by Arrow per task and merged by Spark.  Back at the
documents, counts of the most frequent pairs (at most ``HOT_PAIRS``, a fixed size) are looked
up in a broadcast table; the other pairs, each in few documents, are joined by a shuffle.  So
no frequent pair meets in one task, and no pair is left out.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.llm.common import text_of
from courier.llm.pretokens import Cutter, PieceCache, tokenizer_path
from courier.llm.tokens import PRE_TOKEN
from courier.sources.scratch import materialise

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Characters and rows of the documents that are aligned at a time.
SLICE_CHARS, SLICE_ROWS = 1_000_000, 1024
#: Links of a group from which equal ids are counted before they are joined.
WIDE_GROUP = 64
#: Pairs whose counts are broadcast, 17 bytes each.
HOT_PAIRS = 1 << 20
#: Different pairs that a task counts before it hands them over.
COUNTED_PAIRS = 2_000_000

ALIGNED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups string, pairs array<bigint>, links array<bigint>"
)


# --- the two tokenizers ------------------------------------------------------------


class _Side:
    """A tokenizer: the ids of texts, the bytes of each id, and the ids written out."""

    def __init__(self, token_bytes: list[bytes], group_end: str) -> None:
        self.bytes = pa.array(token_bytes, pa.large_binary())
        self.lengths = np.array([len(t) for t in token_bytes], np.int64)
        ends = (",", group_end, "")
        self.written = pa.array(
            [f"{i}{end}" for i in range(len(token_bytes)) for end in ends], pa.large_string()
        )

    def ids(self, spaced: list[str]) -> list[bytes]:
        raise NotImplementedError


def _byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable characters stand for their own code; all other bytes, in order, for the
    characters from U+0100.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(shown))
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteLevelSide(_Side):
    """A byte-level BPE ``.json`` file; special strings inside texts are plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        byte = _byte_of_char()
        tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        super().__init__([bytes(byte.get(c, 0x3F) for c in t) for t in tokens], "|")
        cuts = tokenizer.pre_tokenizer.pre_tokenize_str
        self._cut = Cutter(PRE_TOKEN, lambda text: len(cuts(text)) == 1)
        self._cache = PieceCache(
            lambda pieces: (
                e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
            )
        )

    def ids(self, spaced: list[str]) -> list[bytes]:
        return self._cache.ids([self._cut(t) for t in spaced])


class PieceSide(_Side):
    """A sentencepiece ``.model`` file, which puts the space before the text itself.

    No piece of such a model has a space after another character, so no merge reaches over
    the begin of a run of spaces, and each run with what follows it is encoded by itself.  A
    model of another kind, or one that normalises, encodes texts whole.
    """

    #: Spaces and what follows; a single last space goes with the run before it.
    _RUN = re.compile(r" +[^ ]*(?: \Z)?")

    def __init__(self, path: str) -> None:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        super().__init__(
            [
                bytes([int(p[3:-1], 16)])
                if processor.is_byte(i)
                else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ],
            ";",
        )
        probe = "a  b ½ﬁ "
        plain = "".join(processor.encode(probe, out_type=str)).replace("▁", " ")
        apart = not any(re.search("[^▁]▁", p) for p in pieces)
        self._apart = apart and plain == f" {probe}"
        self._cache = PieceCache(
            lambda pieces: processor.encode([p[1:] for p in pieces], num_threads=1)
        )

    def _cut(self, text: str) -> list[str]:
        # A text with U+2581 itself does not come back the same from any model; its spaces
        # are not those of the cut, so it is encoded whole.
        if not self._apart or "▁" in text:
            return [text]
        if "  " in text or text.endswith(" ") or "\0" in text:
            return self._RUN.findall(text)
        return text.replace(" ", "\0 ").split("\0")[1:]  # single spaces: the same cuts, without a search

    def ids(self, spaced: list[str]) -> list[bytes]:
        return self._cache.ids([self._cut(t) for t in spaced])


@lru_cache(maxsize=4)
def _sides(byte_level: str, pieces: str) -> tuple[ByteLevelSide, PieceSide]:
    return ByteLevelSide(tokenizer_path(byte_level)), PieceSide(tokenizer_path(pieces))


# --- one slice of documents --------------------------------------------------------


def _lists(ids: list[bytes]) -> pa.LargeListArray:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
    return pa.LargeListArray.from_arrays(
        pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int64))
    )


def _same_bytes(side: _Side, lists: pa.LargeListArray, truth: list[bytes]) -> np.ndarray:
    """Do the joined bytes of a document's tokens equal its text?"""
    taken = side.bytes.take(lists.flatten())
    places = np.frombuffer(taken.buffers()[1], np.int64)[lists.offsets.to_numpy()]
    joined = memoryview(taken.buffers()[2]).cast("B") if places[-1] else b""
    return np.array(
        [joined[low:high] == t for low, high, t in zip(places[:-1], places[1:], truth)], bool
    )


class _Tokens:
    """The tokens of one side of a slice, flattened."""

    def __init__(self, side: _Side, lists: pa.LargeListArray, keep: np.ndarray) -> None:
        parents = pc.list_parent_indices(lists).to_numpy()
        kept = keep[parents]
        self.side = side
        self.doc = parents[kept]
        self.id = lists.flatten().to_numpy()[kept]
        self.count = np.bincount(self.doc, minlength=len(keep))
        # Segmented cumulative sum: byte ends inside each document.
        sums = pc.cumulative_sum(pa.array(side.lengths[self.id])).to_numpy()
        begins = np.concatenate([[0], np.cumsum(self.count)[:-1]])
        before = np.concatenate([[0], sums])[begins]
        self.end = sums - before[self.doc]

    def ends(self, place: str) -> pa.Table:
        return pa.table({"end": (self.doc << 40) + self.end, place: np.arange(len(self.end))})

    def cut_at(self, places: np.ndarray) -> None:
        """Number the groups that end at these tokens."""
        self.last = np.zeros(len(self.id), bool)
        self.last[places] = True
        self.group = np.cumsum(self.last) - self.last

    def sizes(self, groups: int) -> np.ndarray:
        return np.bincount(self.group, minlength=groups)

    def by_group(self, groups: np.ndarray, wide: np.ndarray, name: str) -> pa.Table:
        """``group, <name>, n_<name>`` of some groups, equal ids of wide ones as one row."""
        mine = groups[self.group]
        group, ids = self.group[mine], self.id[mine]
        many = wide[group]
        one = pa.table(
            {"group": group[~many], name: ids[~many], f"n_{name}": np.ones((~many).sum(), np.int64)}
        )
        counted = (
            pa.table({"group": group[many], name: ids[many]})
            .group_by(["group", name], use_threads=False)
            .aggregate([(name, "count")])
            .select(["group", name, f"{name}_count"])
            .rename_columns(["group", name, f"n_{name}"])
        )
        return pa.concat_tables([one, counted])


def _written(a: _Tokens, b: _Tokens, groups: int, docs: int) -> pa.Array:
    """Each document's groups as ``a1,a2|b1;a3|b2``, from one column of written ids."""
    size_a, size_b = a.sizes(groups), b.sizes(groups)
    before_a = np.concatenate([[0], np.cumsum(size_a)])
    before_b = np.concatenate([[0], np.cumsum(size_b)])
    codes = np.empty(len(a.id) + len(b.id), np.int64)
    offset = len(a.side.written)
    final = np.zeros(len(b.id), bool)
    final[np.cumsum(b.count)[b.count > 0] - 1] = True
    codes[np.arange(len(a.id)) + before_b[a.group]] = a.id * 3 + a.last
    codes[np.arange(len(b.id)) + before_a[b.group + 1]] = (
        offset + b.id * 3 + np.where(final, 2, b.last)
    )
    text = pa.concat_arrays([a.side.written, b.side.written]).take(pa.array(codes))
    if not len(text):
        return pa.array([""] * docs, pa.string())
    places = np.frombuffer(text.buffers()[1], np.int64)
    ends = places[np.concatenate([[0], np.cumsum(a.count + b.count)])]
    out = pa.LargeStringArray.from_buffers(docs, pa.py_buffer(ends.copy()), text.buffers()[2])
    return out.cast(pa.string())


def align_texts(side_a: _Side, side_b: _Side, texts: list[str]) -> dict[str, pa.Array]:
    """The columns of ``ALIGNED`` after ``doc_id``, for one slice of documents."""
    spaced = [f" {t}" if t else "" for t in texts]
    truth = [t.encode() for t in spaced]
    lists = [_lists(side.ids(spaced)) for side in (side_a, side_b)]
    keep = _same_bytes(side_a, lists[0], truth) & _same_bytes(side_b, lists[1], truth)
    a, b = (_Tokens(side, one, keep) for side, one in zip((side_a, side_b), lists))
    shared = a.ends("i").join(b.ends("j"), "end", join_type="inner", use_threads=False)
    a.cut_at(shared["i"].to_numpy())
    b.cut_at(shared["j"].to_numpy())
    groups, docs = int(a.last.sum()), len(texts)
    doc_of_group = a.doc[a.last]
    size_a, size_b = a.sizes(groups), b.sizes(groups)
    links = np.zeros(docs, np.int64)
    np.add.at(links, doc_of_group, size_a * size_b)

    # In most groups one side has a single token, so each token of the other has one link and
    # its partner's place follows from the group's number; only the others are joined.
    one_a, one_b = size_a == 1, size_b == 1
    lone_a = one_b[a.group]  # tokens of A whose group has one token of B
    lone_b = one_a[b.group] & ~one_b[b.group]
    single = [
        (a.group[lone_a], a.id[lone_a], b.id[b.last][a.group[lone_a]]),
        (b.group[lone_b], a.id[a.last][b.group[lone_b]], b.id[lone_b]),
    ]
    many = ~one_a & ~one_b
    wide = size_a * size_b >= WIDE_GROUP
    joined = a.by_group(many, wide, "a").join(
        b.by_group(many, wide, "b"), "group", join_type="inner", use_threads=False
    )
    group, id_a, id_b = (
        np.concatenate([*parts, joined[name].to_numpy()])
        for name, parts in zip(("group", "a", "b"), zip(*single))
    )
    times = np.ones(len(group), np.int64)
    times[len(group) - len(joined) :] = joined["n_a"].to_numpy() * joined["n_b"].to_numpy()
    vocabulary_b = len(side_b.lengths)
    pairs = len(side_a.lengths) * vocabulary_b
    key = doc_of_group[group] * pairs + id_a * vocabulary_b + id_b
    counted = (
        pa.table({"key": key, "n": times})
        .group_by("key", use_threads=False)
        .aggregate([("n", "sum")])
    )
    keys, sums = counted["key"].to_numpy(), counted["n_sum"].to_numpy()
    order = np.argsort(keys)
    keys, sums = keys[order], sums[order]
    ends = pa.array(np.searchsorted(keys, np.arange(docs + 1) * pairs), pa.int32())
    return {
        "n_a": pa.array(a.count, pa.int64()),
        "n_b": pa.array(b.count, pa.int64()),
        "n_groups": pa.array(np.bincount(doc_of_group, minlength=docs), pa.int64()),
        "n_links": pa.array(links),
        "groups": _written(a, b, groups, docs),
        "pairs": pa.ListArray.from_arrays(ends, pa.array(keys % pairs)),
        "links": pa.ListArray.from_arrays(ends, pa.array(sums)),
    }


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of rows with few characters together; a long text may be alone."""
    low = held = 0
    for at, text in enumerate(texts):
        if at > low and (held + len(text) > SLICE_CHARS or at - low >= SLICE_ROWS):
            yield low, at
            low, held = at, 0
        held += len(text)
    if texts:
        yield low, len(texts)


# --- the operator ------------------------------------------------------------------


def align_documents(
    docs: DataFrame,
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Tokens, groups and linked id pairs of every row, without a shuffle.

    ``row`` numbers the rows, so that repeated and null ids stay apart; it holds for this
    evaluation, so write the table before it is read twice.  ``n_a, n_b`` are the tokens of
    the byte-level and of the piece tokenizer, ``groups`` is their text ``a1,a2|b1;a3|b2``,
    ``pairs`` are the linked id pairs (first id times the second vocabulary's size, plus the
    second id), ``links`` how often each is linked.  Null and empty texts, and texts whose
    bytes one of the tokenizers does not give back, have no tokens: zeros, an empty text, empty
    lists.  Other columns are not looked at; a table without rows gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(byte_level, pieces)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for low, high in _slices(texts):
                part = batch.slice(low, high - low)
                columns = align_texts(*sides, texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *columns.values()],
                    names=["row", "doc_id", *columns],
                )

    slim = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("bigint").alias("doc_id"),
        text_of(text_column).alias("text"),
    )
    return slim.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, vocabulary_b: int) -> DataFrame:
    """``pair, a, n, best``: documents that hold a pair, and whether no pair of ``a`` has more.

    ``aligned`` needs ``pairs``, each pair once a row; it is read once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})

        def merged(tables: list[pa.Table]) -> pa.Table:
            sums = pa.concat_tables(tables).group_by("pair", use_threads=False)
            return sums.aggregate([("n", "sum")]).select(["pair", "n_sum"]).rename_columns(["pair", "n"])

        waiting, rows = [], 0
        for batch in batches:
            flat = batch.column(0).flatten()
            waiting.append(pa.table({"pair": flat, "n": pa.repeat(pa.scalar(1, pa.int64()), len(flat))}))
            rows += len(flat)
            if rows >= COUNTED_PAIRS:
                held, waiting, rows = merged([held, *waiting]), [], 0
                if len(held) >= COUNTED_PAIRS:
                    yield from held.to_batches()
                    held = held.slice(0, 0)
        yield from merged([held, *waiting]).to_batches()

    partial = aligned.select("pairs").mapInArrow(run, "pair bigint, n bigint")
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialise(
        counts.select("pair", F.expr(f"pair div {vocabulary_b}").alias("a"), "n"), "pair-counts"
    )
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most one row per id of A
    return counts.join(F.broadcast(most), "a").select(
        "pair", "a", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _hot(counts: DataFrame, limit: int) -> tuple[int, tuple[np.ndarray, ...]]:
    """The least count of a pair that is broadcast, and those pairs, sorted.

    The bound is a power of two, so that it follows from at most 63 grouped counts.
    """
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    least, held = 0, 0
    for row in sorted(sizes, key=lambda r: -r["power"]):
        held += row["count"]
        if held > limit:
            least = 2 << row["power"]
            break
    table = counts.where(F.col("n") >= least).select("pair", "n", "best").toArrow()
    pairs = table["pair"].to_numpy()
    order = np.argsort(pairs)
    return least, (pairs[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order])


def link_statistics(
    aligned: DataFrame, vocabulary_b: int | None = None, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """``aligned`` without its lists, with ``n_best`` and ``count_sum``.

    A link's count is the number of rows that hold its id pair.  ``count_sum`` adds them up
    over a row's links, ``n_best`` counts the links whose pair no other pair of the same first
    id exceeds.  ``aligned`` must be a written table: it is read three times, and its texts of
    groups are best dropped or hashed before it is written.
    """
    if vocabulary_b is None:
        vocabulary_b = len(_sides(BYTE_LEVEL, PIECES)[1].lengths)
    counts = materialise(pair_counts(aligned, vocabulary_b), "pair-best")
    least, hot = _hot(counts, hot_pairs)
    table = aligned.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, best = table.value
        for batch in batches:
            lists = batch.column(1)
            pairs = lists.flatten().to_numpy()
            links = batch.column(2).flatten().to_numpy()
            place = np.searchsorted(known, pairs)
            found = np.zeros(len(pairs), bool)
            inside = place < len(known)
            found[inside] = known[place[inside]] == pairs[inside]
            at = place[found]
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])

            def summed(values: np.ndarray) -> np.ndarray:
                every = np.zeros(len(pairs) + 1, np.int64)
                every[1:][found] = values
                every = np.cumsum(every)
                return every[ends[1:]] - every[ends[:-1]]

            left = np.concatenate([[0], np.cumsum(~found)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(summed(links[found] * best[at])),
                    pa.array(summed(links[found] * number[at])),
                    pa.ListArray.from_arrays(pa.array(left), pa.array(pairs[~found])),
                    pa.ListArray.from_arrays(pa.array(left), pa.array(links[~found])),
                ],
                names=["row", "n_best", "count_sum", "pairs", "links"],
            )

    scored = materialise(
        aligned.select("row", "pairs", "links").mapInArrow(
            run,
            "row bigint, n_best bigint, count_sum bigint, pairs array<bigint>, links array<bigint>",
        ),
        "link-sums",
    )
    rest = scored.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links")
    )
    rare = counts.where(F.col("n") < least).select("pair", "n", "best")
    cold = rest.join(rare, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("n")).alias("count_sum"),
    )
    sums = (
        scored.select("row", "n_best", "count_sum")
        .unionByName(cold)
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    kept = [c for c in aligned.columns if c not in ("pairs", "links", "n_best", "count_sum")]
    return aligned.select(*kept).join(sums, "row").drop("row")
