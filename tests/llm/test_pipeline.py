"""The pipeline's stages, each on what its predecessor kept, against brute force."""

import math
import re

import pytest

import corpus_pipeline
from courier.llm import decontamination, mixing, toxicity
from courier.sources.scratch import materialise
from tests.llm.data import SCHEMA, documents, frame
from tests.llm.test_dedup import brute_lines, brute_similar_groups
from tests.llm.test_natives import brute_mix
from tests.llm.test_scores import corpus

ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus()
    extra = [(1000 + r[0], *r[1:]) for r in documents(seed=9, n=30)]
    extra.append((1100, f"before {ITEM} after", "en", "src1", 0))
    docs = frame(spark, rows + extra)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return folder


def contaminated(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    item = ITEM.split()
    for shift in range(-len(item), len(words)):
        pairs = [(k, k + shift) for k in range(len(item)) if 0 <= k + shift < len(words)]
        same = {k for k, p in pairs if item[k] == words[p]}
        if len(same) >= min(decontamination.LEAST, math.ceil(len(item) * decontamination.SHARE)):
            return True
    return False


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = materialise(stage(spark, docs, tables), "tested")
        after = {r[0]: tuple(r) for r in docs.collect()}
        texts = {r[0]: r[1] for r in before}
        if name == "toxicity":
            scores = toxicity.toxicity_scores(
                frame(spark, before), spark.read.parquet(f"{tables}/labels.parquet")
            )
            bad = {r["id"] for r in scores.collect() if r["score"] >= toxicity.THRESHOLD}
            assert 60 <= len(bad) <= 100 and set(after) == set(texts) - bad
        elif name == "line_dedup":
            gone = brute_lines(before)
            for i, text in texts.items():
                lines = (text or "").split("\n")
                left = [line for n, line in enumerate(lines) if (i, n) not in gone]
                assert after[i][1] == (text if len(left) == len(lines) else "\n".join(left))
        elif name == "simhash_dedup":
            assert set(after) == set(brute_similar_groups(texts).values())
        elif name == "decontamination":
            assert set(after) == {i for i, t in texts.items() if not contaminated(t)}
            assert 1100 in texts and 1100 not in after
        else:
            assert {i: r[-1] for i, r in after.items()} == brute_mix(
                before, mixing.WEIGHTS, mixing.BUDGET, mixing.MAX_EPOCHS
            )
        if name != "mixing":
            assert docs.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")


def test_run_chains_the_stages(spark, tables):
    docs = corpus_pipeline.run(spark, tables)
    assert docs.columns[-1] == "copies" and 0 < docs.count() < 440


def test_pipeline_of_an_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    for name, columns in (("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
