"""Tokens, stop words, search and byte offsets."""

import re

import pytest
import regex
from pyspark.sql import functions as F

from courier.functions.words import Tokenizer, running_sums, strip_plural, word_spans
from courier.operators import text as X

PLURAL = Tokenizer(rule=strip_plural)


@pytest.fixture(scope="module")
def mail(spark):
    return spark.createDataFrame(
        [
            (1, "hello world", "This message is a hello world message."),
            (2, "urgent: serious", "This mail is seen as a more serious mail"),
            (3, None, "é wörld 中文 🙂 wORLD's end_of *"),
        ],
        "id int, subject string, body string",
    ).cache()


def ids(df):
    return sorted(r["id"] for r in df.collect())


def hits(df):
    return sorted((r["id"], r["column"], r["term"], r["byte_offset"], r["byte_length"]) for r in df.collect())


def test_tokens(mail):
    found = X.tokens(mail.where("id = 3"), "id", "body").orderBy("position").collect()
    assert [r["token"] for r in found] == ["é", "wörld", "中文", "world", "s", "end", "of"]


def test_offsets_of_the_mail(mail):
    assert hits(X.match_offsets(mail, "id", ["subject", "body"], "world")) == [
        (1, 0, 0, 6, 5), (1, 1, 0, 24, 5),
        (3, 1, 0, len("é wörld 中文 🙂 ".encode()), 5),
    ]


def test_offsets_in_bytes(mail):
    rows = X.token_table(mail, "id", ["subject", "body"]).collect()
    bodies = {(r["id"], 0): r["subject"] for r in mail.collect()} | {(r["id"], 1): r["body"] for r in mail.collect()}
    assert len(rows) == 2 + 7 + 2 + 9 + 7
    for r in rows:
        raw = bodies[(r["id"], r["column"])].encode()
        cut = raw[r["byte_offset"] : r["byte_offset"] + r["byte_length"]].decode()
        assert cut.lower() == r["token"]


def test_match(mail):
    both = ["subject", "body"]
    assert ids(X.match(mail, both, "World")) == [1, 3]
    assert ids(X.match(mail, ["subject"], "World")) == [1]
    assert ids(X.match(mail, both, "urgent mail")) == [2]  # terms in different columns
    assert ids(X.match(mail, both, "hello serious")) == []
    assert ids(X.match(mail, both, "ser*")) == [2]
    assert ids(X.match(mail, both, "mail mail")) == [2]
    assert ids(X.match(mail, both, "this m*")) == [1, 2]
    assert ids(X.match(mail, both, "")) == [] and ids(X.match(mail, both, "*")) == []
    assert hits(X.match_offsets(mail, "id", both, "is m*"))[:2] == [(1, 1, 0, 13, 2), (1, 1, 1, 5, 7)]


def test_plural_rule(spark):
    text = spark.createDataFrame([(1, "I like the band Queensrÿche. They are really great musicians.")], "id int, t string")
    assert ids(X.match(text, ["t"], "Queensrÿche")) == [1]
    assert ids(X.match(text, ["t"], "bands")) == []
    assert ids(X.match(text, ["t"], "bands", PLURAL)) == [1]


def test_stop_words(spark):
    stop = Tokenizer(stop_words=["the", "a"])
    df = spark.createDataFrame([(1, "The end of a day"), (2, "the end *"), (3, "the end*")], "id int, t string")
    found = {}
    for r in X.tokens(df, "id", "t", stop).orderBy("id", "position").collect():
        found.setdefault(r["id"], []).append(r["token"])
    assert found == {1: ["end", "of", "day"], 2: ["the", "end"], 3: ["the", "end"]}
    assert ids(X.match(df, ["t"], "the day", stop)) == [1]
    assert ids(X.match(df, ["t"], "the*", stop)) == [2, 3]
    words = spark.createDataFrame([("the",), ("of",), ("of",)], "word string")
    left = X.remove_stop_words(X.tokens(df.where("id = 1"), "id", "t"), words)
    assert sorted(r["token"] for r in left.collect()) == ["a", "day", "end"]


def test_index(spark, mail, tmp_path):
    path = str(tmp_path / "index")
    X.write_index(X.token_table(mail, "id", ["subject", "body"]), "id", path, buckets=8)
    index = spark.read.parquet(path)
    for query in ("world", "this message", "hello serious", "mail", "ser*", "this m*", "nothing"):
        assert ids(X.search_index(index, "id", query, buckets=8)) == ids(
            X.match(mail, ["subject", "body"], query)
        ), query
    dictionary = spark.read.parquet(X.terms_path(path))
    for query in ("ser*", "this m*", "world*", "none*", "world"):
        found = X.search_index(index, "id", query, buckets=8, dictionary=dictionary)
        assert ids(found) == ids(X.match(mail, ["subject", "body"], query)), query
    plan = X.search_index(index, "id", "world", buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_a_prefix_reads_only_folders_of_its_tokens(spark, tmp_path):
    path = str(tmp_path / "index")
    words = [(i, f"common w{i} x{i}") for i in range(200)]
    df = spark.createDataFrame(words, "id int, t string")
    X.write_index(X.tokens(df, "id", "t"), "id", path, buckets=16)
    index, dictionary = spark.read.parquet(path), spark.read.parquet(X.terms_path(path))
    found = X.search_index(index, "id", "common w1*", buckets=16, dictionary=dictionary)
    assert ids(found) == [i for i in range(200) if str(i).startswith("1")]
    few = X.search_index(index, "id", "w15*", buckets=16, dictionary=dictionary)
    assert ids(few) == [15, *range(150, 160)]
    read = few._jdf.queryExecution().executedPlan().toString()
    folders = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", read).group(1)
    assert "bucket#" in folders and set(re.findall(r"\b\d+\b", folders)) != {str(b) for b in range(16)}
    one = X.search_index(index, "id", "x77*", buckets=16, dictionary=dictionary)
    assert ids(one) == [77]
    pushed = dictionary.where("startswith(token, 'x77')")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(token,x77)" in pushed


def test_running_sums(spark):
    rows = [list(range(n)) for n in (0, 1, 2, 3, 7, 8, 9, 1000)] + [None, [2**40, 2**40]]
    df = spark.createDataFrame([(r,) for r in rows], "v array<bigint>")
    found = [r[0] for r in df.select(running_sums(F.col("v"))).collect()]
    assert found == [None if r is None else [sum(r[: i + 1]) for i in range(len(r))] for r in rows]


def test_spans_of_odd_texts(spark):
    texts = ["", " ", "a", "é𠀀b 🙂x", "\n\nzwei  drei", "١٢ ½ a_b", "w " * 5000, None, "𠀀𠀀 𝒳"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in df.select("t", word_spans(F.col("t")).alias("s")).collect():
        if r["t"] is None:
            assert r["s"] is None
            continue
        words = regex.findall(r"[\p{L}\p{N}]+", r["t"])
        assert [s["word"] for s in r["s"]] == words
        raw = r["t"].encode()
        for s in r["s"]:
            assert raw[s["byte_offset"] : s["byte_offset"] + s["byte_length"]].decode() == s["word"]
