"""Quality scores learnt from trusted positives and unlabelled text.

Positive-unlabelled learning: the risk of a linear scorer g over text features is written
without negatives, with the class prior q of good documents in unlabelled text,

    q * E_pos[l(g)]  +  max(0, E_unl[l(-g)] - q * E_pos[l(-g)]),   l(z) = log(1 + exp(-z)).

The second term estimates the risk on negatives.  It can fall below zero on a sample only
by fitting noise; the non-negative risk then stops counting it, and a step that would
make it negative walks back.  Of all steps the one with the least non-negative risk is kept.
The prior is estimated from the data as well.  A plain scorer of positives against unlabelled
rows ranks rows that neither side has shown it; above any score, the unlabelled share divided
by the positive share is at least q, and close to it where only good rows score so high.  The
threshold is the one whose upper confidence bound is least (best bin estimation).

Features are ratios of characters, words and lines, and the shares of ``WORD_SLOTS`` hashed
groups of words.  The scorer is fitted on bounded samples, one row of each of ``sample`` ids
of either kind chosen by a hash; every document is scored.  Nothing of the held-out fold is
used, neither its labels nor its texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.llm.common import id_fold, text_of

#: Rows of either kind that the scorer is fitted on at most.
SAMPLE = 8_000
#: Score from which a document counts as good.
THRESHOLD = 0.3
#: Groups of hashed words, a fixed number of features.
WORD_SLOTS = 128
#: Chance that the prior's confidence bound is too low, and the weight of the bound.
DOUBT, BOUND_WEIGHT = 0.1, 1.1
_WORD = re.compile(r"\S+")


def text_features(text: str) -> np.ndarray:
    """Ratios that describe a whole text, none of which grows with its length."""
    raw = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    words = _WORD.findall(text)
    n, k = max(1, int(raw.sum())), max(1, len(words))
    upper, lower = int(raw[65:91].sum()), int(raw[97:123].sum())
    letters = max(1, upper + lower)
    same = sum(a == b for a, b in zip(words, words[1:]))
    lines = [line for line in text.split("\n") if line]
    marks = lambda chars: sum(int(raw[ord(c)]) for c in chars)
    shouted = sum(w.isupper() and len(w) > 1 for w in words)
    ends = sum(not w[-1].isalnum() for w in words)
    slots = np.zeros(WORD_SLOTS)
    for word, count in Counter(words).items():
        slots[crc32(word.lower().encode()) % WORD_SLOTS] += count
    ratios = np.array(
        [
            upper / letters,
            shouted / k,
            marks("|") / k,
            marks("$%&*#@^~<>{}[]=+_\\") / k,
            marks("!?") / k,
            marks(".,;:") / k,
            int(raw[48:58].sum()) / n,
            int(raw[128:].sum()) / n,
            same / k,
            len(set(words)) / k,
            1 - len(set(lines)) / max(1, len(lines)),
            ends / k,
            min(40.0, sum(map(len, words)) / k) / 10,
            min(1.0, np.log1p(k) / 10),
            float(not words),
        ]
    )
    return np.r_[ratios, np.sqrt(slots / k)]


def _standard(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x.mean(0), np.maximum(x.std(0), 1e-3)


def _design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    return np.c_[np.ones(len(z)), z[:, :-WORD_SLOTS], np.abs(z[:, :-WORD_SLOTS]), z[:, -WORD_SLOTS:] / 4]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _plain_scorer(pos: np.ndarray, unl: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression of positives against unlabelled rows."""
    x, y = np.r_[pos, unl], np.r_[np.ones(len(pos)), np.zeros(len(unl))]
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ beta)
        slope = x.T @ (y - p) / len(x) - ridge * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(beta))
        beta += np.linalg.solve(curve, slope)
    return beta


def _best_bin(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among unlabelled rows, from scores of rows new to the scorer."""
    cuts = np.unique(pos)
    above_pos = 1 - np.searchsorted(np.sort(pos), cuts) / len(pos)
    above_unl = 1 - np.searchsorted(np.sort(unl), cuts) / len(unl)
    width = sum(np.sqrt(np.log(4 / DOUBT) / (2 * len(x))) for x in (pos, unl))
    at = np.argmin((above_unl + BOUND_WEIGHT * width) / above_pos)
    return float(above_unl[at] / above_pos[at])


def estimate_prior(pos: np.ndarray, unl: np.ndarray, ridge: float = 1e-3) -> float:
    """Share of positives among unlabelled rows; each half scores the other."""
    found = []
    for side in (0, 1):
        seen = [x[np.arange(len(x)) % 2 == side] for x in (pos, unl)]
        new = [x[np.arange(len(x)) % 2 != side] for x in (pos, unl)]
        if min(map(len, [*seen, *new])) == 0:
            continue
        beta = _plain_scorer(*seen, ridge)
        found.append(_best_bin(*(x @ beta for x in new)))
    return float(np.clip(np.mean(found) if found else 0.5, 0.05, 0.98))


def fit_non_negative(
    pos: np.ndarray, unl: np.ndarray, prior: float, ridge: float = 1e-3, steps: int = 400
) -> np.ndarray:
    """Weights of the least non-negative risk among Adam steps over all rows."""
    beta = np.zeros(pos.shape[1])
    best, least = beta, np.inf
    loss = lambda z: np.logaddexp(0, z).mean()
    first, second = np.zeros_like(beta), np.zeros_like(beta)
    for t in range(1, steps + 1):
        on_pos, on_unl = pos @ beta, unl @ beta
        negative_risk = loss(on_unl) - prior * loss(on_pos)
        risk = prior * loss(-on_pos) + max(0.0, negative_risk) + ridge / 2 * (beta[1:] @ beta[1:])
        if risk < least:
            best, least = beta.copy(), risk
        gp, gu = _sigmoid(on_pos), _sigmoid(on_unl)
        # d l(g) = -(1 - s(g)) x and d l(-g) = s(g) x.
        on_positives = -prior * ((1 - gp) @ pos) / len(pos)
        on_negatives = (gu @ unl) / len(unl) - prior * (gp @ pos) / len(pos)
        slope = on_positives + on_negatives if negative_risk >= 0 else -on_negatives
        slope = slope + ridge * np.r_[0, beta[1:]]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        size = first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        beta = beta - 0.1 * (1 - t / (steps + 1)) * size
    return best


def feature_rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, x``: the features of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [text_features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"]
            )

    slim = docs.select(F.col(id_column).cast("bigint"), text_of(text_column))
    return slim.mapInArrow(run, "id bigint, x array<double>")


def _sample_ids(ids: DataFrame, size: int) -> DataFrame:
    """Up to ``size`` ids by the smallest hashes: a bounded, repeatable sample."""
    return ids.orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(size)


def fit_scorer(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str,
    text_column: str,
    quality_column: str,
    folds: int,
    held_out_fold: int,
    sample: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Mean, scale and weights; ``None`` if there are no positives or no unlabelled rows."""
    labelled = labels.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(quality_column).alias("y")
    ).where("id IS NOT NULL AND y IS NOT NULL")
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("id"), text_of(text_column).alias("t")
    ).where("id IS NOT NULL")
    usable = id_fold("id", folds) != held_out_fold
    known = labelled.where(usable).groupBy("id").agg(F.min("y").alias("y"))
    every = texts.where(usable).select("id").distinct()
    chosen = (
        _sample_ids(every.join(known.where("y = 1"), "id", "left_semi"), sample)
        .withColumn("positive", F.lit(True))
        .unionByName(
            _sample_ids(every.join(known, "id", "left_anti"), sample).withColumn(
                "positive", F.lit(False)
            )
        )
    )
    # At most two samples of ids, 16 bytes each, are broadcast; one row of each comes back.
    rows = texts.join(F.broadcast(chosen.select("id")), "id", "left_semi")
    got = (
        feature_rows(rows, "id", "t")
        .groupBy("id")
        .agg(F.min("x").alias("x"))
        .join(F.broadcast(chosen), "id")
        .toPandas()
        .sort_values("id", kind="stable")
    )
    pos, unl = (np.array(got[got.positive == p].x.tolist()) for p in (True, False))
    if len(pos) < 2 or not len(unl):
        return None
    mean, scale = _standard(np.r_[pos, unl])
    pos, unl = _design(pos, mean, scale), _design(unl, mean, scale)
    return mean, scale, fit_non_negative(pos, unl, estimate_prior(pos, unl))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    quality_column: str = "quality",
    folds: int = 5,
    held_out_fold: int = 0,
    sample: int = SAMPLE,
) -> DataFrame:
    """``id, held_out, score`` for every row of ``docs``.

    Trusted positives are rows with label 1 outside the held-out fold (the smallest label
    of an id counts); unlabelled rows are those outside that fold without any label.  Labels of
    the held-out fold and labels 0 are not used; without those label rows nothing changes.  Null and empty texts are scored by the features of an
    empty text.  Without positives or unlabelled rows every score is 0.5.  Null and
    repeated ids keep their rows.
    """
    fitted = fit_scorer(
        docs, labels, id_column, text_column, quality_column, folds, held_out_fold, sample
    )
    share = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            if share.value is not None and batch.num_rows:
                mean, scale, beta = share.value
                x = np.array([text_features(t) for t in batch.column(1).to_pylist()])
                score = _sigmoid(_design(x, mean, scale) @ beta)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score)], names=["id", "score"]
            )

    slim = docs.select(F.col(id_column).cast("bigint"), text_of(text_column))
    scored = slim.mapInArrow(run, "id bigint, score double")
    return scored.select("id", (id_fold("id", folds) == held_out_fold).alias("held_out"), "score")
