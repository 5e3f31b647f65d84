"""Token counts with a byte-level BPE tokenizer, without a shuffle of its words.

The tokenizer cuts a text into pre-tokens (a word with its space, a run of digits, ...) and
encodes each by itself, so a text's count is the sum over its pre-tokens.  Lengths are
looked up in two tiers: a broadcast table of frequent pre-tokens, at most ``entries`` of
them; and, for the rest, a cache in each Python worker, filled by the tokenizer itself.  A
text that holds an added token's string, or a character on which the cutting rules of the
two libraries might differ, is encoded whole.

Which pre-tokens are in the broadcast table changes no count, only speed.  They are taken
from about ``sample`` rows, chosen by a hash of the id: each task counts its own and hands
over its most frequent, so no pre-token is shuffled here either.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.llm.common import text_of

#: How byte-level BPE cuts texts; a fixed value of this kind of tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Scripts whose letter and digit classes are long settled; other texts are encoded whole.
#: Basic Latin to Cyrillic, general punctuation, currency signs, letterlike symbols, CJK.
SETTLED = r"[\x00-ͷ΄-ΆΈ-ΊΎ-ΡΣ-ԯ -⁤₠-₿℀-↋←-⏿─-⯿ぁ-ゖ゙-ヿ一-龥가-힣！-ﾟ\U0001F300-\U0001F64F]*"

ENTRIES = 32_768
SAMPLE = 2_000
#: Lengths kept by one worker, besides the broadcast table.
CACHED = 400_000
#: Longer pre-tokens are encoded each time.
LONGEST_CACHED = 64


class _Worker:
    """A tokenizer with its cache, one for each worker process and tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile(PRE_TOKEN).findall
        self.settled = regex.compile(SETTLED).fullmatch
        self.lengths: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str] | None:
        """The text's pre-tokens, or ``None`` if it must be encoded whole."""
        if any(a in text for a in self.added) or not self.settled(text):
            return None
        return self.cut(text)

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def counts(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        """Tokens of each text; ``frequent`` is the first tier and never leaves the cache."""
        if not self.lengths or len(self.lengths) > CACHED + len(frequent):
            self.lengths = dict(frequent)
        cut = [self.pre_tokens(t) for t in texts]
        missing = list(set(chain.from_iterable(c for c in cut if c)).difference(self.lengths))
        encoded = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        self.lengths.update((p, len(e.ids)) for p, e in zip(missing, encoded))
        length = self.lengths.__getitem__
        out = [
            self.whole(text) if parts is None else sum(map(length, parts))
            for text, parts in zip(texts, cut)
        ]
        for p in missing:
            if len(p) > LONGEST_CACHED:
                del self.lengths[p]
        return out


@lru_cache(maxsize=4)
def _worker(path: str) -> _Worker:
    return _Worker(path)


def _tokenizer_path(name: str) -> str:
    """The file on this machine: a public tokenizer's name, or a path as it is."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def frequent_lengths(
    docs: DataFrame,
    tokenizer: str,
    id_column: str,
    text_column: str,
    sample: int = SAMPLE,
    entries: int = ENTRIES,
) -> dict[str, int]:
    """Lengths of pre-tokens frequent in a sample of about ``sample`` rows."""
    rows = docs.count()
    share = F.pmod(F.xxhash64(F.lit(7), id_column), F.lit(1_000_003)) < int(
        min(1.0, sample / max(rows, 1)) * 1_000_003
    )
    chosen = docs.select(id_column, text_column).where(share).select(text_of(text_column))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, seen = _worker(_tokenizer_path(tokenizer)), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(
                    p for p in worker.pre_tokens(text) or () if len(p) <= LONGEST_CACHED
                )
        top = seen.most_common(entries)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            names=["p", "n"],
        )

    total: Counter = Counter()
    for p, n in chosen.mapInArrow(run, "p string, n bigint").toLocalIterator():
        total[p] += n
        if len(total) > 8 * entries:
            total = Counter(dict(total.most_common(4 * entries)))
    top = [p for p, _ in total.most_common(entries)]
    encoded = _worker(_tokenizer_path(tokenizer)).tokenizer.encode_batch(
        top, add_special_tokens=False
    )
    return {p: len(e.ids) for p, e in zip(top, encoded)}


def token_counts(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
    sample: int = SAMPLE,
    entries: int = ENTRIES,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, in one pass without shuffle.

    ``tokenizer`` is a ``.json`` file of a byte-level BPE tokenizer.  Nothing is added at a
    text's begin or end, nothing truncated or padded; strings of added tokens inside a text
    count as the library counts them.  A null text counts as empty: no bytes, no tokens.
    Null and repeated ids keep their rows, and a table without rows gives none.
    """
    table = frequent_lengths(docs, tokenizer, id_column, text_column, sample, entries)
    frequent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _worker(_tokenizer_path(tokenizer))
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = part.column(1).to_pylist()
                counts = worker.counts(texts, frequent.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    slim = docs.select(F.col(id_column).cast("bigint"), text_of(text_column))
    counted = slim.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
