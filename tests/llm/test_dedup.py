"""SimHash groups, repeated strings, similar lines and components against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from courier.llm import line_dedup, simhash_dedup, suffix_dedup
from courier.llm.components import connected_components
from tests.llm.data import SCHEMA, WORD, ascii_lower, documents, frame


def brute_fingerprint(text, words=4):
    found = WORD.findall(ascii_lower(text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(points, radius):
    root = {}
    for i, x in points:
        root[i] = i
    find = lambda i: i if root[i] == i else find(root[i])
    for i, x in points:
        for j, y in points:
            if j < i and bin(x ^ y).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in points}


def test_fingerprints_and_groups(spark):
    rows = documents()
    docs = frame(spark, rows).withColumn("fp", F.lit("clash")).withColumn("id", F.lit(0))
    got = simhash_dedup.near_duplicate_groups(docs).collect()
    prints = {r["id"]: r["fp"] & (2**64 - 1) for r in got}
    assert prints == {r[0]: brute_fingerprint(r[1]) for r in rows}
    expected = brute_groups(sorted(prints.items()), 4)
    assert {r["id"]: r["component_id"] for r in got} == expected
    kept = simhash_dedup.keep_one_of_each_group(frame(spark, rows))
    assert kept.columns[0] == "doc_id" and {r["doc_id"] for r in kept.collect()} == set(expected.values())


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 5])
def test_links_span_the_groups_of_all_pairs(spark, radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    points = set()
    for c in centres:  # dense groups, and chains that leave them
        at = int(c)
        for _ in range(60):
            flips = rng.choice(64, size=int(rng.integers(0, 5)), replace=False)
            points.add(at ^ sum(1 << int(b) for b in flips))
            at = at ^ (1 << int(rng.integers(0, 64))) if rng.random() < 0.3 else at
    points = sorted(points)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in points]
    fps = spark.createDataFrame(signed, "fp bigint")
    links = simhash_dedup.fingerprint_links(fps, radius)
    for a, b in ((r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in links.collect()):
        assert bin(a ^ b).count("1") <= radius
    roots = {r["node"] & (2**64 - 1): r["root"] for r in connected_components(links, "a", "b").collect()}
    expected = brute_groups(list(enumerate(points)), radius)
    groups = {}
    for i, p in enumerate(points):
        groups.setdefault(expected[i], set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_large_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash_dedup.fingerprint_links(spark.createDataFrame([], "fp bigint"), 6)


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = [(None, "a b", None, None, None), (5, "a b", None, None, None), (5, "a b", "", "", 1), (None, None, "", "", 1)]
    got = simhash_dedup.near_duplicate_groups(frame(spark, rows)).collect()
    assert sorted((r["id"] is None, r["component_id"] or -1) for r in got) == [
        (False, 5), (False, 5), (True, -1), (True, 5),
    ]
    assert simhash_dedup.near_duplicate_groups(frame(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (60, 50), (50, 60)]
    got = connected_components(spark.createDataFrame(chain, "a bigint, b bigint"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in got} == {**{i: 0 for i in range(41)}, 50: 50, 60: 50}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted((r[0], r[1] or "") for r in rows):
        raw = text.encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                gone[p : p + length] = True
            seen.add(window)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most_contexts", [20_000, 1])
def test_repeated_strings(spark, most_contexts):
    rows = documents() + [(90, "a" * 450, "", "", 0), (91, "ab" * 200 + "é" * 90, "", "", 0)]
    docs = frame(spark, rows).withColumn("h", F.lit(1)).withColumn("low", F.lit(1))
    got = suffix_dedup.remove_repeats(docs, most_contexts=most_contexts).collect()
    found = {
        r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
        for r in got
    }
    assert found == brute_repeats(rows)
    assert any(v[2] > 1 for v in found.values())


def test_repeated_strings_across_chunks(spark, monkeypatch):
    rows = documents(seed=8, n=12)
    raw = rows[-2][1].encode()
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1_000)
    gram, at, first, count = suffix_dedup.anchors(raw, 100)
    assert count.sum() == len(raw) - 99 and (first[1:] == first[:-1] + count[:-1]).all()
    assert (at >= first + count - 1).all() and (at + suffix_dedup.GRAM <= first + 100).all()


def test_repeated_strings_of_awkward_rows(spark):
    long = "abcdefghij" * 3 + "".join(chr(65 + i % 26) + str(i) for i in range(60))
    rows = [(1, long, None, None, None), (1, long, "", "", 0), (None, long, "", "", 0), (2, None, "", "", 0)]
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    # The null id comes first; the row that repeats id and text is one document with the other.
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [
        (0, 0), (1, len(long)), (1, len(long)), (2, 0),
    ]
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(frame(spark, rows), length=40)


def brute_lines(rows, t=0.8):
    earlier, gone = [], set()
    for i, text in sorted((r[0], r[1] or "") for r in rows):
        for number, line in enumerate(text.split("\n")):
            words = frozenset(WORD.findall(line.lower()))
            if words:
                if any(len(words & e) >= t * len(words | e) - 1e-9 for e in earlier):
                    gone.add((i, number))
                earlier.append(words)
    return gone


def test_similar_lines(spark):
    rows = documents(seed=5, n=60)
    base = [f"k{i}" for i in range(30)]
    for i, cut in enumerate((0, 1, 3, 5, 6, 7, 8)):  # similarities around the threshold
        rows.append((200 + i, " ".join(base[cut:] + [f"new{i}"]), "", "", 0))
    rows.append((300, "a b c d\na b c d e\nb a D c\nq r s\nq r s t", "", "", 0))
    docs = frame(spark, rows).withColumn("line", F.lit(1)).withColumn("gone", F.lit(1))
    expected = brute_lines(rows)
    assert {tuple(r) for r in line_dedup.similar_earlier(docs).collect()} == expected
    kept = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate_lines(frame(spark, rows)).collect()}
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        left = [line for n, line in enumerate(lines) if (i, n) not in expected]
        changed = len(left) < len(lines)
        assert kept[i] == ("\n".join(left) if changed else text)
    counts = line_dedup.line_dedup_counts(frame(spark, rows)).collect()
    assert sum(r["n_removed"] for r in counts) == len(expected) and len(counts) == len(rows)


def test_lines_of_awkward_rows(spark):
    rows = [(None, "x y z", "", "", 3), (1, "x y z\nz y X", "", "", 9), (1, "x y z", "", "", 5), (2, None, None, None, None)]
    got = {tuple(r) for r in line_dedup.similar_earlier(frame(spark, rows)).collect()}
    assert got == {(1, 0), (1, 1)}
    assert line_dedup.deduplicate_lines(frame(spark, rows)).columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert line_dedup.similar_earlier(frame(spark, [])).count() == 0


def test_lines_beside_columns_of_any_name(spark):
    rows = documents(seed=2, n=12)
    docs = frame(spark, rows)
    names = ("kept", "gone", "gone_id", "n_removed", "row", "new", "line", "a b", "c.d")
    odd = docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])
    got = line_dedup.deduplicate_lines(odd)
    assert got.columns == odd.columns
    plain = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate_lines(docs).collect()}
    for r in got.collect():
        assert plain[r["doc_id"]] == r["text"] and tuple(r)[5:] == tuple(range(len(names)))
    both = line_dedup.without_similar_lines(odd)
    assert both.columns[-2:] == ["kept", "n_removed"] and len(set(both.columns)) == len(both.columns)


def test_wide_signatures_rule_out_unlike_long_lines_only(spark):
    """Lines of 150 words: 64 bits are full, so most candidates used to take their words along."""
    import random

    rng = random.Random(4)
    base = [f"k{i}" for i in range(150)]
    rows, unlike = [(0, " ".join(base), "", "", 0)], 0
    for i in range(1, 41):
        changed = 10 + i  # similar up to 16 changed words
        words = base[:]
        for at in rng.sample(range(150), changed):
            words[at] = f"n{i}x{at}"
        unlike += 5 * (150 - changed) < 4 * (150 + changed)
        rows.append((i, " ".join(words), "", "", 0))
    docs = frame(spark, rows)
    assert {tuple(r) for r in line_dedup.similar_earlier(docs).collect()} == brute_lines(rows)
    lines = line_dedup._lines(docs, "doc_id", "text")
    ranks = line_dedup.rarity_ranks(lines)
    worded = lines.select(
        F.struct("doc_id", "line_no").cast(line_dedup._PLACE).alias("own"),
        line_dedup.ordered_words(F.col("line"), ranks).alias("words"),
    ).withColumn("wide", line_dedup.wide_signature("words"))
    first = worded.where("own.doc_id = 0").select(F.col("own").alias("earlier"))
    pairs = worded.where("own.doc_id > 0").select(F.col("own").alias("later")).crossJoin(first)
    left = line_dedup._not_ruled_out(pairs, worded, (4, 5)).select("later.doc_id").collect()
    found = {r["doc_id"] for r in left}
    assert found >= {i for i in range(1, 41) if 5 * (140 - i) >= 4 * (160 + i)}
    assert len(found) < 41 - unlike + unlike // 3


def test_unlike_lines_that_share_single_rare_words_are_no_candidates(spark):
    """300 long lines, some thousand pairs of which share one of their rarest words by chance."""
    import random

    rng = random.Random(6)
    rows = [(i, " ".join(rng.sample([f"w{k}" for k in range(20_000)], 150)), "", "", 0) for i in range(300)]
    base = [f"b{i}" for i in range(20)]
    for i in range(100):  # variants, two words of which are replaced: most settled by the first
        words = base[:]
        for at in rng.sample(range(20), 2):
            words[at] = f"n{i}x{at}"
        rows.append((1000 + i, " ".join(words), "", "", 0))
    # Two rows of one id have lines at the same place, which do not remove each other.
    rows += [(2000, "p q r s t", "", "", 0), (2000, "p q r s t u", "", "", 0), (2001, "p q r s u", "", "", 0)]
    docs = frame(spark, rows)
    expected = brute_lines(rows[:-3]) | {(2001, 0)}
    assert {tuple(r) for r in line_dedup.similar_earlier(docs).collect()} == expected
    asked = {}
    verified = line_dedup._verified

    def watched(pairs, *rest):
        asked[len(asked)] = pairs.count()
        return verified(pairs, *rest)

    line_dedup._verified = watched
    try:
        assert line_dedup.similar_earlier(docs.where("doc_id < 300")).count() == 0
    finally:
        line_dedup._verified = verified
    assert sum(asked.values()) < 100  # single words: 430


def test_lines_at_a_similarity_of_one_half(spark):
    """Similar sets then need not share a pair of neighbouring words, so single ones are filed."""
    rows = [(1, "a c e g\na b c d e f g h", "", "", 0), (2, "b d f h i k\nx y\ny z", "", "", 0)]
    got = {tuple(r) for r in line_dedup.similar_earlier(frame(spark, rows), threshold=(1, 2)).collect()}
    assert got == brute_lines(rows, 0.5) == {(1, 1)}


def test_a_document_of_very_many_similar_lines(spark):
    import time

    line = "one two three four five six seven eight nine ten"
    text = "\n".join(f"{line} {i % 50}" for i in range(200_000)) + "\nlast words"
    docs = frame(spark, [(1, text, "en", "s", 0), (2, "own text", "en", "s", 0)])
    begin = time.monotonic()
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate_lines(docs).collect()}
    assert got == {1: f"{line} 0\nlast words", 2: "own text"}
    assert time.monotonic() - begin < 100


def test_stage_finds_every_pair_at_the_similarity(spark):
    """Copies with a few edited words lie far beyond 4 bits; brute force over all pairs."""
    import random

    from courier.llm import simhash_dedup

    rng = random.Random(8)
    rows = []
    for i in range(12):
        words = [f"v{rng.randrange(5_000)}" for _ in range(rng.choice((6, 60, 150)))]
        for edits in (0, 1, 2, 3, 4):
            near = list(words)
            for k in rng.sample(range(len(near)), edits):
                near[k] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(near), "", "", 0))
    rows += [(100, "", "", "", 0), (101, None, "", "", 0)]

    def shingles(text):
        w = (text or "").split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {r[0]: shingles(r[1]) for r in rows}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    kept = simhash_dedup.keep_one_of_each_group(spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    assert {r["doc_id"] for r in kept.collect()} == set(group.values())
    assert 14 < len(set(group.values())) < 62


def shingles(text, words=5):
    found = WORD.findall(ascii_lower(text or ""))
    return {" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def brute_similar_groups(texts):
    """Groups of all pairs of similarity 0.8 or more, by id."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    for i in sets:
        for j in sets:
            if j < i and len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("slots, radius", [(1 << 18, 5), (4, 0)])
def test_similar_groups_are_those_of_all_pairs(spark, slots, radius):
    rng = np.random.default_rng(4)
    shared = " ".join(f"s{i}" for i in range(30))
    texts = {i: r[1] for i, r in enumerate(documents(seed=4, n=20))}
    for _ in range(60):  # edited copies around the bound, some with a common passage
        words = [f"v{k}" for k in rng.integers(0, 5000, int(rng.integers(5, 120)))]
        for _ in range(int(rng.integers(1, 5))):
            texts[len(texts)] = " ".join(words) + (" " + shared if rng.random() < 0.3 else "")
            for _ in range(int(rng.integers(0, 3))):
                words[int(rng.integers(0, len(words)))] = f"e{rng.integers(0, 999)}"
    texts |= {len(texts) + k: f"{shared} t{k} u{k} w{k}" for k in range(20)}
    expected = brute_similar_groups(texts)
    assert 20 < len(set(expected.values())) < len(texts) - 20
    docs = frame(spark, [(i, t, "en", "s", 0) for i, t in texts.items()])
    docs = docs.selectExpr("*", "1 AS id", "2 AS key", "3 AS fp", "4 AS shingles").repartition(3)
    groups = simhash_dedup.jaccard_groups(docs, radius=radius, slots=slots)
    assert {r["id"]: r["component_id"] for r in groups.collect()} == expected


def test_written_tables_leave_no_shuffle_files(spark):
    from courier.sources.scratch import SHUFFLE_CLEANUP, materialise

    def files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP)
    table = materialise(spark.range(10_000).repartition(5, "id"), "spread")
    assert files() <= before and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert table.count() == 10_000


def test_signatures_rule_out_unlike_sets_only(spark):
    """Texts that share rare shingles: unlike pairs used to take their whole sets along."""
    base = [f"k{i}" for i in range(400)]
    rows = [(0, " ".join(base), "", "", 0)]
    rows += [(i, " ".join(base[: 400 - 10 * i] + [f"n{i}x{k}" for k in range(10 * i)]), "", "", 0) for i in range(1, 31)]
    sets = simhash_dedup.shingle_sets(frame(spark, rows), 5)
    found = {r["id"]: (r["key"], set(r["shingles"])) for r in sets.collect()}
    pairs = spark.createDataFrame([(found[0][0], found[i][0]) for i in range(1, 31)], "a bigint, b bigint")
    left = {r["b"] for r in simhash_dedup._not_ruled_out(pairs, sets).collect()}
    near = {k for k, s in found.values() if s != found[0][1] and 5 * len(s & found[0][1]) >= 4 * len(s | found[0][1])}
    assert near and near <= left and len(left) < 15
    assert {(r["a"], r["b"]) for r in simhash_dedup._alike(pairs, sets).collect()} == {
        (min(found[0][0], k), max(found[0][0], k)) for k in near
    }


class Largest(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, one, other):
        return max(one, other)


def test_the_stage_hands_its_workers_small_batches(spark, monkeypatch):
    """Lists of shingles in batches of 10,000 rows took an executor over its memory."""
    largest, kind = [], type(spark.range(1))
    real = kind.mapInArrow

    def noting(self, run, schema, *args, **options):
        if not {"shingles", "text"} & set(self.columns):
            return real(self, run, schema, *args, **options)
        rows = spark.sparkContext.accumulator(0, Largest())
        largest.append(rows)

        def noted(batches):
            def each():
                for batch in batches:
                    rows.add(batch.num_rows)
                    yield batch

            return run(each())

        return real(self, noted, schema, *args, **options)

    monkeypatch.setattr(kind, "mapInArrow", noting)
    before = dict(spark.conf.getAll)
    docs = frame(spark, [(i, f"a{i} b c d e f g{i}", "en", "s", 0) for i in range(600)]).coalesce(1)
    groups = simhash_dedup.jaccard_groups(docs).collect()
    assert len(groups) == 600 and all(r["id"] == r["component_id"] for r in groups)
    assert [rows.value for rows in largest] == [simhash_dedup.SLICE] * 3  # sets, counts, prefixes
    assert dict(spark.conf.getAll) == before
