"""Words of a text: tokens as an array column, and where they lie in the text."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of letters and digits.
WORD = r"[\p{L}\p{N}]+"

@dataclass(frozen=True)
class Tokenizer:
    """Lower-cased words, a rule for each of them, and words to leave out.

    ``rule`` maps a token column to a token column.  ``stop_words`` is a word list that
    fits a literal; for more use ``text.remove_stop_words``.  Stop words are kept in a
    text that ends in ``*``, so that a prefix query may start with one.
    """

    rule: Callable[[Column], Column] | None = None
    stop_words: Sequence[str] = ()

    def token(self, word: Column) -> Column:
        lowered = F.lower(word)
        return lowered if self.rule is None else self.rule(lowered)

    def kept(self, token: Column, text: Column) -> Column:
        """Is the token neither empty nor a stop word?"""
        kept = token != F.lit("")
        if self.stop_words:
            kept = kept & (~token.isin(*self.stop_words) | text.endswith("*"))
        return kept

    def tokens(self, text: Column) -> Column:
        """All tokens of a text, in order."""
        words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
        tokens = F.transform(words, self.token)
        if self.rule is None and not self.stop_words:
            return tokens
        return F.filter(tokens, lambda t: self.kept(t, text))


def strip_plural(token: Column) -> Column:
    """A token rule: without one trailing ``s``."""
    return F.regexp_replace(token, "s$", "")


def running_sums(numbers: Column) -> Column:
    """``numbers[0] + ... + numbers[i]`` for every i of an array of bigints.

    Each step adds what lies 1, 2, 4, ... places before, so n numbers take log n passes.
    """
    size = F.size(numbers)
    steps = F.when(
        size > 1, F.sequence(F.lit(0), F.ceil(F.log2(size)).cast("int") - 1)
    ).otherwise(F.array().cast("array<int>"))

    def step(sums: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(
            sums, lambda v, i: v + F.coalesce(F.get(sums, i - back), F.lit(0).cast("bigint"))
        )

    return F.aggregate(steps, numbers, step)


def word_spans(text: Column) -> Column:
    """Each word of a text with its UTF-8 byte offset and length; null for a null text.

    Offsets are running sums over the gaps between the words and the words themselves.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    gaps = F.split(text, WORD, -1)
    both = F.struct(words.alias("words"), F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gaps"))

    # Arrays of one struct name what would be worked out again for every word.
    def placed(d: Column) -> Column:
        bytes_of = F.zip_with(
            d["gaps"],
            d["words"],
            lambda g, w: (F.octet_length(g) + F.octet_length(w)).cast("bigint"),
        )
        return F.struct(d["words"].alias("words"), bytes_of.alias("bytes"))

    def summed(d: Column) -> Column:
        return F.struct(d["words"].alias("words"), running_sums(d["bytes"]).alias("ends"))

    def spans(d: Column) -> Column:
        return F.transform(
            d["words"],
            lambda w, i: F.struct(
                w.alias("word"),
                (F.get(d["ends"], i) - F.octet_length(w)).cast("int").alias("byte_offset"),
                F.octet_length(w).alias("byte_length"),
            ),
        )

    found = F.array(both)
    for step in (placed, summed, spans):
        found = F.transform(found, step)
    return F.when(text.isNotNull(), F.get(found, F.lit(0)))
