"""Spelling variants against all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from courier.llm import variants
from tests.llm.data import SCHEMA, ascii_lower, documents, frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, shorten=31, least=7):
    total = Counter()
    for key, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = ascii_lower(run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if shorten and h % shorten == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, times=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def misspelt(rng, word):
    at = rng.randrange(len(word))
    letter = rng.choice("abcé")
    return rng.choice(
        [word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]]
    )


def counted_words(seed=5, n=300):
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        word = "".join(rng.choice("abcdé") for _ in range(rng.randrange(7, 12)))
        words[word] = rng.randrange(2, 5000)
        for _ in range(rng.randrange(4)):
            word = misspelt(rng, word)
            words[word] = rng.randrange(2, 50)
    # Repeated letters can be told apart in several ways; a chain of forms; a long word twice.
    words |= {"a" * k: 10 ** (k - 6) * 2 for k in range(7, 12)}
    words |= {"x" * 3000: 2, "x" * 2999 + "y": 40}
    return words


@pytest.mark.parametrize("file_words", [4096, 20])
def test_variants_are_those_of_all_pairs(spark, file_words):
    words = counted_words()
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = variants.spelling_variants(table, file_words=file_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(words)
    assert set(rows) == brute_variants(words)


def test_few_rows_at_a_time_change_nothing(spark, monkeypatch):
    words = counted_words(seed=6, n=60)
    expected = brute_variants(words)
    rows = [(w, n) for w, n in words.items()]
    table = spark.createDataFrame(rows, "word string, n bigint").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {tuple(r) for r in variants.spelling_variants(table, file_words=3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected


def test_words_of_texts(spark):
    rows = documents()
    text = "Straße ÉCOLES écoles ×××××××× abcdefgh Abcdefgi übermäßig " * 3
    rows += [(100 + i, f"{text} {i}", "de", "s", 0) for i in range(40)]
    rows += [(None, text, None, None, None), rows[3]]
    rows.append((-5, "abcdefgh" * 2000 + " " + "abcdefgh" * 2000, "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS word", "2 AS n", "3 AS id")
    for shorten in (31, None, 2):
        got = {r["word"]: r["n"] for r in variants.word_counts(docs, shorten).collect()}
        assert got == brute_words(rows, shorten)


def test_query_result_on_texts(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(7, 11))) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(base) for _ in range(200)), "en", "s", 0) for i in range(60)]
    words = variants.word_counts(frame(spark, rows), shorten_one_in=31)
    got = {tuple(r) for r in variants.spelling_variants(words).collect()}
    expected = brute_variants(brute_words(rows))
    assert got == expected
    assert any(r[1] is not None for r in got)


def test_no_words(spark):
    empty = frame(spark, [])
    words = variants.word_counts(empty, 31)
    assert words.collect() == []
    assert variants.spelling_variants(words).collect() == []
