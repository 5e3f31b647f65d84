"""Toxicity and quality scores on made-up classes, and their awkward rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from courier.llm import quality, toxicity
from tests.llm.data import frame, prose


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(20, 120), 800).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(len(words) // 12 + 1):
                words[rng.randrange(len(words))] = rng.choice(["nasty", "vileone", "viletwo", "vile" + str(i)])
        junk = i % 7 == 0
        if junk:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


def tables(spark):
    rows, labels = corpus()
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def held_out(i, folds, fold):
    return zlib.crc32(str(i).encode()) % folds == fold


def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark)
    got = toxicity.toxicity_scores(docs.withColumn("y", F.lit(9)), labels).collect()
    assert len(got) == 400 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == held_out(r["id"], 4, 2) for r in got)
    unseen = [r for r in got if r["held_out"]]
    right = sum((r["score"] >= 0.3) == (r["id"] % 5 == 0) for r in unseen)
    assert right >= 0.9 * len(unseen)


def test_toxicity_never_reads_held_out_labels(spark):
    docs, labels = tables(spark)
    other = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    scores = [
        {r["id"]: r["score"] for r in toxicity.toxicity_scores(docs, which).collect()}
        for which in (labels, other)
    ]
    assert scores[0] == scores[1]


def test_toxicity_of_awkward_rows(spark):
    docs, labels = tables(spark)
    odd = frame(spark, [(None, "nasty", None, None, None), (900, None, None, None, None), (901, "", "", "", 0), (901, "123", "", "", 0)])
    marks = spark.createDataFrame(
        [(None, 1, 1), (5, None, None), (900, 1, None), (0, 1, 1), (0, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    got = toxicity.toxicity_scores(docs.unionByName(odd), labels.unionByName(marks)).collect()
    assert len(got) == 404 and not any(np.isnan(r["score"]) for r in got)
    assert toxicity.toxicity_scores(frame(spark, []), labels).count() == 0
    assert toxicity.toxicity_scores(odd, marks.limit(0)).count() == 4
    kept = toxicity.drop_toxic(docs.unionByName(odd), labels)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() == 1


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    labelled = labels.where("doc_id % 2 = 0")
    got = quality.quality_scores(docs.withColumn("x", F.lit(9)), labelled).collect()
    assert len(got) == 400 and all(r["held_out"] == held_out(r["id"], 5, 0) for r in got)
    right = sum((r["score"] >= 0.3) == (r["id"] % 7 != 0) for r in got)
    assert right >= 0.95 * len(got)


def test_prior_is_found():
    rng = np.random.default_rng(0)
    good = lambda n: np.c_[np.ones(n), rng.normal(2, 1, n)]
    bad = lambda n: np.c_[np.ones(n), rng.normal(-2, 1, n)]
    for share in (0.3, 0.6, 0.9):
        unlabelled = np.r_[good(int(4000 * share)), bad(int(4000 * (1 - share)))]
        prior = quality.estimate_prior(good(3000), unlabelled)
        assert abs(prior - share) < 0.08
        beta = quality.fit_non_negative(good(3000), unlabelled, prior)
        right = share * (good(1000) @ beta > 0).mean() + (1 - share) * (bad(1000) @ beta < 0).mean()
        assert right > 0.94


def test_prior_of_few_rows():
    rng = np.random.default_rng(1)
    rows = lambda n: np.c_[np.ones(n), rng.normal(0, 1, n)]
    for n in (1, 2, 3, 50):
        assert 0.05 <= quality.estimate_prior(rows(n), rows(n)) <= 0.98


def test_quality_never_reads_label_rows_of_the_held_out_fold(spark):
    docs, labels = tables(spark)
    labels = labels.where("doc_id % 2 = 0")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    changed = labels.withColumn("quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [
        {r["id"]: r["score"] for r in quality.quality_scores(docs, which).collect()}
        for which in (labels, labels.where(fold != 0), changed)
    ]
    assert scores[0] == scores[1] == scores[2]


def test_quality_sees_words_and_extra_columns(spark):
    """Good and bad texts of the same shape, told apart by their words alone."""
    rng = random.Random(2)
    good, bad = (["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30)] for _ in "ab")
    rows = [
        (i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(60)), "en", "s", 0)
        for i in range(600)
    ]
    docs = frame(spark, rows).selectExpr("*", "1 AS id", "2 AS x", "3 AS y", "true AS positive", "'t' AS t")
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(300)], "doc_id bigint, quality int, toxic int"
    ).selectExpr("*", "5 AS id", "6 AS y")
    got = quality.quality_scores(docs.unionByName(docs.limit(50)), labels).collect()
    right = sum((r["score"] >= 0.5) == (r["id"] % 2 == 1) for r in got)
    assert len(got) == 650 and right >= 0.95 * len(got)


def test_quality_of_awkward_rows(spark):
    docs, labels = tables(spark)
    odd = frame(spark, [(None, "x", None, None, None), (900, None, None, None, None), (901, "", "", "", 0)])
    got = quality.quality_scores(docs.unionByName(odd), labels.where("doc_id < 200")).collect()
    assert len(got) == 403 and not any(np.isnan(r["score"]) for r in got)
    assert quality.quality_scores(frame(spark, []), labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
