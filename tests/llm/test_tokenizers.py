"""Encoding, decoding and alignment against the tokenizers' own libraries."""

import hashlib
import os
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from courier.llm import alignment, byte_bpe  # noqa: E402
from courier.sources.scratch import materialise  # noqa: E402
from tests.llm.data import SCHEMA, documents, frame  # noqa: E402


def odd_texts(n=60):
    """Every kind of character, specials as text, runs, and texts that end in spaces."""
    rng = random.Random(1)
    texts = [
        "a" * 700, " " * 50, "a ", " a", "a  b\n\n\tc <|endoftext|></s><unk>", "▁x", "x ▁",
        "\x00z\x1c\x85 ", "अनुच्छेद ๑๒ 漢字かな𠀀 ՘ ꟎", "!?" * 100, "\U0001f600" * 30, "it's IT'S 'll  x",
    ]
    picks = [lambda: rng.randrange(32, 0x3000), lambda: 0x20, lambda: rng.randrange(0x20, 0x7F),
             lambda: rng.randrange(0xE000, 0x110000)]
    texts += ["".join(chr(rng.choice(picks)()) for _ in range(80)) for _ in range(n)]
    return texts


def rows_with_odd_texts():
    rows = documents(n=12)
    rows += [(200 + i, t, "en", "odd", 0) for i, t in enumerate(odd_texts())]
    return [*rows, (None, "no id", None, None, None), rows[0], rows[0]]


def clashing(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.selectExpr("*", "1 AS row", "2 AS ids", "3 AS n_tokens", "4 AS pairs", "5 AS links")


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


# --- encoding and decoding -----------------------------------------------------------


@pytest.mark.parametrize("vocabulary", [byte_bpe.VOCABULARY, "byte_bpe_50k.tiktoken"])
def test_ids_are_the_librarys_and_go_back(spark, vocabulary):
    import tiktoken

    ranks = byte_bpe.read_ranks(public_tokenizers.path(vocabulary))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = rows_with_odd_texts()
    encoded = byte_bpe.encode_documents(clashing(spark, rows), vocabulary)
    got = byte_bpe.decode_documents(encoded, vocabulary).collect()
    expected = []
    for key, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((key, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    assert by_row((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in got) == by_row(expected)


def test_tokens_that_no_merge_builds():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 300, b"abc": 258}
    vocabulary = byte_bpe.Vocabulary.from_ranks(ranks)
    assert vocabulary.whole == {b"xyz": 300}
    encode = byte_bpe._Encoder(vocabulary)
    ids = [np.frombuffer(i, "<u4").tolist() for i in encode(["xyz", "xyzab", "abc", "é"])]
    assert ids == [[300], [120, 121, 122, 256], [258], [195, 169]]
    decode = byte_bpe._Decoder(vocabulary)
    assert decode(encode(["xyz abc", ""])) == [b"xyz abc", b""]


def test_ids_that_stand_for_nothing(spark):
    odd = [b"", None, b"\x01", np.array([70_000], "<u4").tobytes(), np.array([5], "<u4").tobytes()]
    table = spark.createDataFrame(
        [(i, 0, b) for i, b in enumerate(odd)], "doc_id bigint, n_tokens bigint, ids binary"
    )
    got = {r["doc_id"]: r["decoded"] for r in byte_bpe.decode_documents(table).collect()}
    assert (got[0], got[1], got[2], got[3]) == (b"", b"", None, None) and got[4]


def test_a_vocabulary_needs_every_byte():
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary.from_ranks({b"a": 0})


# --- alignment -----------------------------------------------------------------------


def brute_alignment(texts):
    """Per text: tokens, groups, links, the groups' text, and the linked id pairs."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_LEVEL))
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))
    byte = alignment._byte_of_char()
    out = []
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = other.encode(text) if text else []
        spelt_a = [bytes(byte[c] for c in one.id_to_token(i)) for i in a]
        spelt_b = [
            bytes([int(other.id_to_piece(i)[3:-1], 16)])
            if other.is_byte(i)
            else other.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        whole = f" {text}".encode()
        if not text or b"".join(spelt_a) != whole or b"".join(spelt_b) != whole:
            out.append((0, 0, 0, 0, "", Counter()))
            continue
        ends_a, ends_b = list(accumulate(map(len, spelt_a))), list(accumulate(map(len, spelt_b)))
        written, pairs, i, j = [], Counter(), 0, 0
        cuts = sorted(set(ends_a) & set(ends_b))
        for cut in cuts:
            to_i, to_j = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            in_a, in_b, i, j = a[i:to_i], b[j:to_j], to_i, to_j
            written.append(",".join(map(str, in_a)) + "|" + ",".join(map(str, in_b)))
            pairs.update((x, y) for x in in_a for y in in_b)
        out.append((len(a), len(b), len(cuts), sum(pairs.values()), ";".join(written), pairs))
    return out


@pytest.mark.parametrize("hot_pairs", [1 << 20, 50, 0])
def test_alignment_and_counts(spark, hot_pairs):
    rows = rows_with_odd_texts()
    alone = brute_alignment([r[1] for r in rows])
    documents_of = Counter(p for *_, pairs in alone for p in pairs)
    most = Counter()
    for (a, _), n in documents_of.items():
        most[a] = max(most[a], n)
    expected = []
    for (key, *_), (*numbers, written, pairs) in zip(rows, alone):
        best = sum(n for p, n in pairs.items() if documents_of[p] == most[p[0]])
        total = sum(n * documents_of[p] for p, n in pairs.items())
        expected.append((key, *numbers, written, best, total))
    aligned = materialise(alignment.align_documents(clashing(spark, rows)), "aligned")
    got = alignment.link_statistics(aligned, hot_pairs=hot_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert by_row(tuple(r) for r in got.collect()) == by_row(expected)


def test_wide_groups_and_small_slices(monkeypatch):
    texts = ["", "\U0001f468‍\U0001f469‍\U0001f467" * 20, "zzz" * 300, "ab " * 10] + odd_texts(10)
    sides = alignment._sides(alignment.BYTE_LEVEL, alignment.PIECES)
    expected = brute_alignment(texts)
    for wide, rows in ((1, 1024), (64, 1), (10**9, 3)):
        monkeypatch.setattr(alignment, "WIDE_GROUP", wide)
        monkeypatch.setattr(alignment, "SLICE_ROWS", rows)
        got = []
        for low, high in alignment._slices(texts):
            columns = alignment.align_texts(*sides, texts[low:high])
            for i in range(high - low):
                row = {name: column[i].as_py() for name, column in columns.items()}
                pairs = {divmod(p, 32000): n for p, n in zip(row["pairs"], row["links"])}
                got.append((*[row[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups")], pairs))
        assert got == expected


def test_only_groups_of_many_tokens_are_joined(monkeypatch):
    """Groups with one token on a side are most; joining them took a tenth of the time."""
    joined, real = [], alignment._Tokens.by_group

    def counting(self, groups, wide, name):
        joined.append(int(groups.sum()))
        return real(self, groups, wide, name)

    monkeypatch.setattr(alignment._Tokens, "by_group", counting)
    sides = alignment._sides(alignment.BYTE_LEVEL, alignment.PIECES)
    one = alignment.align_texts(*sides, ["the house and the garden"])
    assert joined == [0, 0] and one["n_links"][0].as_py() == 5


@pytest.mark.parametrize(
    "text", ["a b c", "a  b", "a ", " a", "a\0b c", "\0 a", " ", "a ▁b", "a\tb c\n d", "a b  "]
)
def test_runs_of_spaces_are_cut_as_by_the_pattern(text):
    side = alignment._sides(alignment.BYTE_LEVEL, alignment.PIECES)[1]
    spaced = f" {text}"
    assert side._cut(spaced) == ([spaced] if "▁" in text else side._RUN.findall(spaced))


def test_partial_counts_are_merged(spark, monkeypatch):
    lists = [[1, 5, 9], [], [5], [5, 32001], None]
    table = spark.createDataFrame([(p,) for p in lists], "pairs array<bigint>").repartition(2)
    got = {tuple(r) for r in alignment.pair_counts(table, 32000).collect()}
    assert got == {(1, 0, 1, False), (5, 0, 3, True), (9, 0, 1, False), (32001, 1, 1, True)}


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(empty)).collect() == []
    aligned = materialise(alignment.align_documents(empty), "aligned")
    assert alignment.link_statistics(aligned).collect() == []


def test_queries_give_digests(spark, tmp_path):
    from courier.llm.queries import QUERIES

    rows = documents(n=8)
    frame(spark, rows).write.parquet(os.path.join(tmp_path, "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op11_byte_bpe"](spark, str(tmp_path)).collect()}
    for key, text, *_ in rows:
        assert got[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    aligned = {r["doc_id"]: r for r in QUERIES["op12_tokenizer_alignment"](spark, str(tmp_path)).collect()}
    for (key, *_), (*numbers, written, _) in zip(rows, brute_alignment([r[1] for r in rows])):
        row = aligned[key]
        assert [row[c] for c in ("n_a", "n_b", "n_groups", "n_links")] == numbers
        digest = hashlib.sha256(written.encode()).hexdigest() if written else ""
        assert row["groups_sha256"] == digest
