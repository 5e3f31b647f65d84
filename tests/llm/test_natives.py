"""Chat formatting, mixing, fingerprints, decontamination and token counts."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from courier.llm import chat, decontamination, fingerprints, mixing, tokens
from tests.llm.data import documents, frame, prose

TURNS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize(
    "text",
    ["", "plain", "</s>[INST] ok [/INST]", r"<\/s> <\\s> [\INST]", "<|im_start|>user\nhi<|im_end|>\n",
     "<<s>> [[INST]]", "\\", "<|im_end|", "é <s>é</s>", "<" * 5 + "s>"],
)
def test_escape_round_trip(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(chat.escape_text(F.col("t")).alias("e"), chat.unescape_text(chat.escape_text(F.col("t"))).alias("u")).first()
    assert row["u"] == text
    assert not any(c in row["e"] for c in chat.CONTROL)


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b <s>"), (1, 0, "user", "a\n"), (2, 0, "r\n%0A", None), (2, 0, None, "x"),
            (3, 5, "assistant", "one"), (3, 5, "assistant", "one"), (None, 0, "user", "n"), (4, 0, "assistant", ""),
            (5, 0, "a<|im_start|>user\nb<|im_end|>", "x"), (5, 1, "<\\s>%0A[INST]", "</s>" * 5), (5, 2, "assistant", "ab")]
    turns = spark.createDataFrame(rows, TURNS).withColumn("log", F.lit(1)).withColumn("message", F.lit(1))
    got = {r["conv_id"]: r for r in chat.chat_digests(turns.select("conv_id", "turn", "role", "text")).collect()}
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn, role or "", text or ""))
    for c, said in by.items():
        said.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in said)
        learnt = "".join(t for _, r, t in said if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(said), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat.chat_digests(spark.createDataFrame([], TURNS)).count() == 0
    log = chat.events_of_turns(turns.select("conv_id", "turn", "role", "text"))
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    answers = sum(r[2] == "assistant" for r in rows)
    assert kinds == {
        "delta": 4 * answers + 2 * (len(rows) - answers), "edit": len(rows) - answers, "regenerate": answers
    }


def test_events_fold_into_messages(spark):
    log = [
        (1, 1, 0, "user", "delta", "Hel"), (1, 2, 0, None, "delta", "lo"), (1, 3, 1, "assistant", "delta", "bad"),
        (1, 4, 1, None, "regenerate", "x"), (1, 5, 1, None, "delta", "go"), (1, 6, 1, None, "delta", "od"),
        (1, 7, 0, None, "edit", "Hi"), (1, 8, 0, None, "delta", "!"), (2, 1, 0, "user", None, None),
    ]
    random.Random(1).shuffle(log)
    events = spark.createDataFrame(log, "conv_id bigint, seq bigint, message bigint, role string, kind string, text string")
    got = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat.fold_events(events).collect()}
    assert got == {(1, 0): ("user", "Hi!"), (1, 1): ("assistant", "good"), (2, 0): ("user", "")}


def brute_mix(rows, weights, budget, epochs):
    leaves, docs = defaultdict(int), []
    for i, text, lang, source, _ in rows:
        number = re.search(r"([0-9]{1,9})$", source or "")
        leaf = ("none" if not number else f"d{int(number[1]) % 4}", lang or "", source or "")
        n = len((text or "").split())
        leaves[leaf] += n
        docs.append((leaf, i, n))
    supply = {k: v for k, v in leaves.items() if v}

    def fill(nodes, given):
        out, left, open_ = {}, given, dict(nodes)
        while True:
            total = sum(w for w, _ in open_.values())
            full = [k for k, (w, cap) in open_.items() if cap * total <= left * w]
            if not full:
                break
            least = min(full, key=lambda k: (open_[k][1] / open_[k][0], k))
            out[least] = open_[least][1]
            left -= open_.pop(least)[1]
        total = sum(w for w, _ in open_.values())
        return out | {k: left * w // total for k, (w, _) in open_.items()}

    given = {(): min(sum(supply.values()) * budget[0] // budget[1], sum(supply.values()) * epochs)}
    for depth, level in enumerate(mixing.LEVELS):
        after = {}
        for parent, amount in given.items():
            caps = defaultdict(int)
            for leaf, n in supply.items():
                if leaf[:depth] == parent:
                    caps[leaf[: depth + 1]] += n * epochs
            after |= fill({k: (weights.get(level, {}).get(k[-1], 1), c) for k, c in caps.items()}, amount)
        given = after
    chosen = {}
    for leaf, amount in given.items():
        whole, rest = divmod(amount, supply[leaf])
        mine = [(hashlib.md5(f"{mixing.SEED}:{whole}:{i}".encode()).hexdigest(), i, n) for l, i, n in docs if l == leaf]
        used = 0
        for _, i, n in sorted(mine):
            used += n
            copies = whole + (0 < rest >= used)
            if copies:
                chosen[i] = copies
    return chosen


@pytest.mark.parametrize("budget, epochs", [((3, 4), 2), ((1, 3), 1), ((9, 1), 3), ((0, 1), 2)])
def test_mixing(spark, budget, epochs):
    rows = documents(n=60)
    docs = frame(spark, rows).withColumn("supply", F.lit(1)).withColumn("key", F.lit(1))
    got = mixing.mixed_copies(docs, budget=budget, max_epochs=epochs).collect()
    assert {r["doc_id"]: r["copies"] for r in got} == brute_mix(rows, mixing.WEIGHTS, budget, epochs)


def test_mixing_of_awkward_rows(spark):
    rows = [(1, "a b", None, None, None), (1, "a b", None, None, None), (None, "c", "en", "src1", 0), (2, None, "en", "src1", 0)]
    mixed = mixing.mix_documents(frame(spark, rows), budget=(1, 1))
    assert mixed.columns[:5] == frame(spark, rows).columns and mixed.columns[-1] == "copies"
    assert sorted(r["doc_id"] for r in mixed.collect()) == [1, 1, 2]
    assert mixing.mixed_copies(frame(spark, [])).count() == 0
    zero = mixing.mixed_copies(frame(spark, rows), weights={"lang": {"en": 0}}, budget=(1, 1))
    assert {r["lang"] for r in zero.collect()} == {""}


def test_fingerprint_query(spark):
    rows = documents()
    docs = frame(spark, rows).withColumn("fp", F.lit("clash")).withColumn("range", F.lit(1))
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_table(docs).collect()}
    texts = [(r[0], r[1] or "") for r in sorted(rows)]
    for at, (i, text) in enumerate(texts):
        after = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if edited == text:
            assert got[i]["near_edited"] == 1
        mine, other = (int(got[k]["fingerprint"], 16) for k in (i, texts[(at + 1) % len(texts)][0]))
        assert got[i]["near_next"] == 1 - bin(mine ^ other).count("1") / 64
        edited_fp = int(got[i]["edited_fingerprint"], 16)
        assert got[i]["near_edited"] == 1 - bin(mine ^ edited_fp).count("1") / 64
    prints = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    for i, r in got.items():
        near = sum(bin(prints[i] ^ p).count("1") <= 3 for p in prints.values()) - 1
        assert r["n_near"] == (near if i % 20 == 0 else None)


def test_fingerprints_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    rows = documents() + [(None, "null id", "", "", 0), (7, "again", "", "", 0)]
    got = fingerprints.edited_fingerprints(frame(spark, rows)).collect()
    texts = sorted(((-1 if r[0] is None else r[0]), r[1] or "") for r in rows)
    expected = []
    for at, (i, text) in enumerate(texts):
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[(at + 1) % len(texts)][1][:half]
        expected.append((i, hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["edited_sha256"]) for r in got) == sorted(expected)


def test_votes_are_weighted_by_length(spark):
    df = spark.createDataFrame([(1, "aa bbbbbb"), (2, "bbbbbb"), (3, None)], "k int, t string")
    fp = {r["k"]: r["fp"] for r in fingerprints.simhash(df, ["k"], "t").collect()}
    assert fp[1] == fp[2] != 0 and fp[3] == 0
    assert fingerprints.fingerprint_table(frame(spark, [])).count() == 0


def test_near_fingerprints_match_brute_force(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    points = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for b in base for _ in range(12)}
    sign = lambda p: p - 2**64 if p >= 2**63 else p
    counted = spark.createDataFrame([(sign(p), 2) for p in points], "fp bigint, n bigint")
    for radius in (0, 2, 3):
        got = fingerprints.near_fingerprints(counted, counted, radius).collect()
        for r in got:
            at = r["fp"] & (2**64 - 1)
            assert r["n_near"] == 2 * sum(bin(at ^ p).count("1") <= radius for p in points)
    with pytest.raises(ValueError):
        fingerprints.near_fingerprints(counted, counted, 4)


def benchmark_case():
    rng = random.Random(6)
    items = [(k, prose(rng, n, 3_000)) for k, n in enumerate((20, 40, 15, 8, 3))] + [(None, None), (9, "")]
    rows = []
    for i in range(30):
        words = prose(rng, 80, 3_000).split()
        if i % 3 == 0 and i // 3 < 5:
            words[10:10] = items[i // 3][1].upper().split()
        rows.append((i, ", ".join(words), "", "", 0))
    passage = items[1][1].split()
    for k in range(0, 40, 9):  # every ninth word is another one
        passage[k] = "other"
    rows.append((50, "start " + " ".join(passage[3:36]), "", "", 0))
    rows.append((51, " ".join(items[1][1].split()[:10]), "", "", 0))
    rows += [(52, None, None, None, None), (53, items[0][1], "", "", 0), (53, "", "", "", 0), (None, items[0][1], "", "", 0)]
    return rows, items


@pytest.mark.parametrize("limit", [500_000, 0])
def test_decontamination(spark, limit):
    rows, items = benchmark_case()
    docs = frame(spark, rows).withColumn("h", F.lit(1)).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = decontamination.contamination(docs, bench, broadcast_seeds=limit).collect()
    bad = {r["doc_id"]: r["item_id"] for r in got if r["contaminated"]}
    # Item 4 has three words only; document 51 holds ten of forty.
    assert bad == {0: 0, 3: 1, 6: 2, 9: 3, 50: 1, 53: 0, None: 0}
    assert len(got) == len(rows)
    kept = decontamination.drop_contaminated(frame(spark, rows), bench.select("item_id", "text"))
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {0, 3, 6, 9, 50, 53}
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contamination(frame(spark, rows), empty).where("contaminated").count() == 0
    assert decontamination.contamination(frame(spark, []), bench).count() == 0


def test_decontamination_finds_all_the_rule_accepts(spark):
    """Brute force without any mask: every 4th or 5th word replaced, short items, no spaces."""
    rng = random.Random(11)
    items = [(n, prose(rng, n, 100_000)) for n in (5, 6, 9, 10, 11, 12, 16, 20, 25, 40, 59, 130)]
    items.append((700, "".join(chr(0x4E00 + rng.randrange(5_000)) for _ in range(24))))
    cut = lambda t: re.findall(r"[\u4e00-\u9fff]|[a-z0-9]+", t.lower())
    passages = []
    for _, text in items:
        words = cut(text)
        need = min(13, -(-len(words) * 4 // 5))
        for step in (4, 5):
            passages.append(["x" if k % step == step - 1 else w for k, w in enumerate(words)])
        for n in (need, need, need, need - 1):
            kept = set(rng.sample(range(len(words)), n))
            passages.append([w if k in kept else "x" for k, w in enumerate(words)])
        even = {k * (len(words) - 1) // (need - 1) for k in range(need)}  # as far apart as can be
        passages.append([w if k in even else "x" for k, w in enumerate(words)])
        passages += [["x", *words[1:]], words]
    rows = [(i, " ".join(["y", "z", *p, "y"]), "", "", 0) for i, p in enumerate(passages)]
    rows.append((len(rows), "前" + items[-1][1] + "後", "", "", 0))
    expected = set()
    for i, text, *_ in rows:
        words = cut(text)
        for item, item_text in items:
            own = cut(item_text)
            for shift in range(-len(own), len(words)):
                same = sum(0 <= k + shift < len(words) and words[k + shift] == w for k, w in enumerate(own))
                if same >= min(13, -(-len(own) * 4 // 5)):
                    expected.add((i, item, shift))
    assert len(rows) - 1 in {e[0] for e in expected}
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for limit in (500_000, 0):
        got = decontamination.overlaps(frame(spark, rows), bench, broadcast_seeds=limit)
        assert {(r["doc_id"], r["item_id"], r["shift"]) for r in got.collect()} == expected


def test_decontamination_in_pieces(spark):
    """Passages across the ends of pieces; any three words are looked up once, from one pair."""
    rng = random.Random(12)
    items = [(n, prose(rng, n, 100_000)) for n in (14, 40)]
    expected, rows = set(), []
    for i, begin in enumerate((0, 230, 250, 256, 500, 767, 1_000)):
        words = prose(rng, 1_040, 50_000).replace("w", "v").split()
        item, text = items[i % 2]
        words[begin : begin + item] = text.split()
        rows.append((i, " ".join(words[:1_040]), "", "", 0))
        expected.add((i, item, begin))
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    for limit in (500_000, 0):
        got = decontamination.overlaps(docs, bench, broadcast_seeds=limit).collect()
        assert {(r["doc_id"], r["item_id"], r["shift"]) for r in got} == expected
    widest = max(decontamination.reach(n) for n, _ in items)
    cut = bench.select("item_id", decontamination._hashes(F.col("text")).alias("h"))
    cut = cut.withColumn("item", F.col("item_id")).withColumn("reach", F.lit(widest))
    seeds, pairs = decontamination._item_seeds(cut, widest)
    hashed = docs.select("doc_id", decontamination._hashes(F.col("text")).alias("h"))
    for length, margin in ((256, 58), (1, widest)):
        pieces = decontamination._pieces(hashed, length, margin)
        found = decontamination._document_seeds(pieces, pairs, widest).join(seeds, "seed")
        places = [(r["doc_id"], r["at"], r["seed"]) for r in found.select("doc_id", "at", "seed").collect()]
        assert len(places) == len(set(places)) >= 7 * 12


def test_unspaced_letters_are_those_of_the_scripts(spark):
    scripts = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
    points = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343")
    letters = points.select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    assert letters.where(F.col("c").rlike(scripts) != F.col("c").rlike(decontamination.UNSPACED)).count() == 0


@pytest.mark.parametrize("words", range(5, 20))
def test_reach_holds_three_words_of_every_pattern(words):
    for places in itertools.combinations(range(words), decontamination.words_needed(words)):
        widths = [places[i + 2] - places[i] for i in range(len(places) - 2)]
        assert min(widths) <= decontamination.reach(words)


def test_token_counts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(2)
    odd = ["", None, "<|endoftext|> a<|endoftext|>", "don't  stop\n\n 12ab", "あ中กำ \U0001f600 ­ ​",
           "x" * 3_000, " ", "\t \n", "à́ ١٢", "\U0001d7d8꟱"]
    odd += ["".join(chr(rng.choice([32, 39, 46, 97, 233, 0x3b1, 0x4e00, 0x1f600, 10, 49])) for _ in range(200)) for _ in range(20)]
    rows = [(i, t, None, None, None) for i, t in enumerate(odd)] + [(None, "null", "", "", 0)] + documents()[:5]
    docs = frame(spark, rows).withColumn("n_tokens", F.lit(-1))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted(
        (-1 if r[0] is None else r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids))
        for r in rows
    )
    for entries in (50, 0):
        got = tokens.token_counts(docs, entries=entries).collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == expected
        assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert tokens.token_counts(frame(spark, [])).count() == 0


def test_cutting_agrees_with_the_library():
    import public_tokenizers

    worker = tokens._Worker(public_tokenizers.path("byte_bpe_50k.json"))
    library = worker.tokenizer.pre_tokenizer
    for point in range(0x20000):
        char = chr(point)
        if not 0xD800 <= point < 0xE000 and worker.settled(char):
            text = f"a{char}1 {char}b{char}{char} ?{char}"
            assert worker.cut(text) == [text[i:j] for _, (i, j) in library.pre_tokenize_str(text)]
