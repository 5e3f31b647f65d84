"""Toxicity scores from two Kneser-Ney models of words, one per class.

Each class c interpolates discounted counts with a backoff.  For a word w with opening
letters p,

    P_c(w) = (C_c(w) - r_c(w)) / C_c  +  R_c / C_c * Q_c(p) * S(w | p)
    Q_c(p) = (R_c(p) - u_c(p)) / R_c  +  U_c / R_c * S(p)

r is what discounting releases of a count, R its sum over words; u and U are the same one
level up.  The backoffs S are shared: they follow what both classes together released.
These are Kneser-Ney's continuation counts, which ask in how many contexts a word occurs,
with the classes as contexts, and with more than 1 as the most that one context can add: a
class releases up to the discount, and up to TOLERANCE times the count that the other
class, brought to the same size, has.  So a word too rare to tell the classes apart is
shared entirely, and so is one whose frequency differs by less than that factor, as the
words of a language do that is a little commoner in one class.  A rare inflection is judged
by how its opening is spread over the classes, and a word that one class uses often and the
other never counts for much.  A document's evidence is the mean of log P_toxic - log
P_ordinary over its words, which does not grow with length.

Counts are sums over every labelled row of the training folds.  They are kept in hash
tables of a fixed number of slots, so what is broadcast has a fixed size whatever the
corpus; forms that share a slot share their counts.

A logistic curve turns evidence into a score.  It is fitted to a fold that the models have
not seen, from counts of documents per class, evidence bin and length bin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.llm.common import broadcast_if_small, id_fold, text_of, without_ids
from courier.sources.scratch import materialise

WORD_SLOTS = 1 << 20
OPENING_SLOTS = 1 << 18
OPENING_LETTERS = 4
#: What the smaller class loses at most of a word's count.
DISCOUNT = 5.0
#: Factor between the classes' frequencies up to which a word is shared entirely.
TOLERANCE = 5.0
#: Labelled rows up to which their ids are broadcast: 16 bytes each.
BROADCAST_LABELS = 1_000_000
#: Evidence is counted in bins of this width, between the limits.
EVIDENCE_BIN, EVIDENCE_LIMIT = 0.005, 4.0
#: Words whose ratios are computed at once.
BLOCK = 1 << 17
#: Score from which a document counts as toxic.
THRESHOLD = 0.3


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters, in order."""
    return F.transform(_words(text), lambda w: F.xxhash64(w))


def opening_hashes(text: Column) -> Column:
    return F.transform(_words(text), lambda w: F.xxhash64(F.substring(w, 1, OPENING_LETTERS)))


def _slots(hashes: Column, size: int) -> Column:
    return F.transform(hashes, lambda h: h.bitwiseAND(F.lit(size - 1)).cast("int"))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}]+"), lambda w: w != "")


@dataclass(frozen=True)
class ClassModels:
    """Counts of words and released counts of openings by slot; rows: toxic, ordinary."""

    words: np.ndarray
    openings: np.ndarray
    discounts: tuple[float, float]

    def released(self, counts: np.ndarray) -> np.ndarray:
        """What discounting releases of counts; rows: toxic, ordinary."""
        toxic, ordinary = self.discounts
        other = counts[::-1] * np.array([[toxic / ordinary], [ordinary / toxic]], np.float32)
        most = np.maximum(np.array([[toxic], [ordinary]], np.float32), TOLERANCE * other)
        return np.minimum(counts, most)

    @cached_property
    def again(self) -> tuple[np.ndarray, np.ndarray]:
        """What openings release, and per class: words, words released, openings released."""
        again = self.released(self.openings)
        sums = [t.sum(1, dtype=np.float64) for t in (self.words, self.openings, again)]
        return again, np.maximum(np.stack(sums, axis=1), 1.0)

    def log_ratios(self, words: np.ndarray, openings: np.ndarray) -> np.ndarray:
        """log P_toxic - log P_ordinary of each word, from its hashes or slots."""
        word = words & (WORD_SLOTS - 1)
        opening = openings & (OPENING_SLOTS - 1)
        counts, released = self.words[:, word], self.openings[:, opening]
        let_go = self.released(counts)
        # One more for what neither class has shown, so that no probability is zero.
        form = (let_go.sum(0) + 1) / (released.sum(0) + 1)
        form = np.minimum(form, 1)
        again, totals = self.again
        start = (again[:, opening].sum(0) + 1) / (totals[:, 2].sum() + OPENING_SLOTS)
        logs = []
        for c in (0, 1):
            tokens, all_released, saved = totals[c]
            kept = released[c] - again[c, opening]
            first = kept / all_released + saved / all_released * start
            own = (counts[c] - let_go[c]) / tokens
            logs.append(np.log(own + all_released / tokens * first * form))
        return logs[0] - logs[1]


def class_discounts(labelled: DataFrame, text_column: str, toxic_column: str) -> tuple:
    """The discounts of the toxic and the ordinary class, from the lengths of their texts."""
    length = F.length(text_of(text_column))
    toxic, ordinary = labelled.agg(
        F.sum(F.when(F.col(toxic_column) == 1, length)),
        F.sum(F.when(F.col(toxic_column) == 0, length)),
    ).first()
    ratio = max(1, toxic or 0) / max(1, ordinary or 0)
    return DISCOUNT * max(1.0, ratio), DISCOUNT * max(1.0, 1 / ratio)


def class_counts(
    labelled: DataFrame, text_column: str, toxic_column: str, discounts: tuple[float, float]
) -> DataFrame:
    """``kind, slot, toxic, ordinary`` summed over all words of all rows.

    Kind 0 counts words by word slot, kind 1 what discounting releases by opening slot.
    """
    words = labelled.select(
        F.col(toxic_column).alias("y"),
        F.arrays_zip(
            word_hashes(text_of(text_column)).alias("w"),
            opening_hashes(text_of(text_column)).alias("p"),
        ).alias("pairs"),
    ).select("y", F.explode("pairs").alias("e"))
    forms = (
        words.select(
            "y",
            F.col("e.w").alias("w"),
            F.col("e.p").bitwiseAND(F.lit(OPENING_SLOTS - 1)).cast("int").alias("p"),
        )
        .groupBy("w", "p")
        .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"))
    )

    def row(kind: int, slot: Column, toxic: Column, ordinary: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            slot.alias("slot"),
            toxic.cast("double").alias("t"),
            ordinary.cast("double").alias("o"),
        )

    word_slot = F.col("w").bitwiseAND(F.lit(WORD_SLOTS - 1)).cast("int")
    toxic_most, ordinary_most = discounts

    def released(own: str, other: str, most: float, scale: float) -> Column:
        return F.least(F.col(own), F.greatest(F.lit(most), TOLERANCE * scale * F.col(other)))

    rows = F.explode(
        F.array(
            row(0, word_slot, F.col("t"), F.col("o")),
            row(
                1,
                F.col("p"),
                released("t", "o", toxic_most, toxic_most / ordinary_most),
                released("o", "t", ordinary_most, ordinary_most / toxic_most),
            ),
        )
    )
    return (
        forms.select(rows.alias("e"))
        .groupBy("e.kind", "e.slot")
        .agg(F.sum("e.t").alias("toxic"), F.sum("e.o").alias("ordinary"))
    )


def _as_models(counts: DataFrame, discounts: tuple[float, float]) -> ClassModels:
    """The tables from their filled slots: at most WORD_SLOTS + OPENING_SLOTS rows."""
    got = counts.toArrow()
    kind, slot = (got.column(c).to_numpy() for c in ("kind", "slot"))

    def table(of_kind: int, size: int) -> np.ndarray:
        out = np.zeros((2, size), dtype=np.float32)
        mine = kind == of_kind
        for c, column in enumerate(("toxic", "ordinary")):
            out[c, slot[mine]] = got.column(column).to_numpy()[mine]
        return out

    return ClassModels(table(0, WORD_SLOTS), table(1, OPENING_SLOTS), discounts)


def document_evidence(docs: DataFrame, models, id_column: str, text_column: str) -> DataFrame:
    """``id, evidence, n_words``; ``models`` is a broadcast of ``ClassModels``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, openings = batch.column(1), batch.column(2)
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (words, openings)]
            # Block by block, so that the arrays on the way stay small.
            ratios = np.empty(flat[0].size, dtype=np.float32)
            for low in range(0, ratios.size, BLOCK):
                part = slice(low, low + BLOCK)
                ratios[part] = models.value.log_ratios(flat[0][part], flat[1][part])
            sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.r_[0.0, np.cumsum(ratios, dtype=np.float64)]
            ends = np.cumsum(sizes)
            mean = (sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(mean), pa.array(sizes)],
                names=["id", "evidence", "n_words"],
            )

    text = text_of(text_column)
    # Slots go to the worker as 32-bit numbers, half of what the hashes would take.
    hashed = docs.select(
        F.col(id_column).cast("bigint"),
        _slots(word_hashes(text), WORD_SLOTS),
        _slots(opening_hashes(text), OPENING_SLOTS),
    )
    return hashed.mapInArrow(run, "id bigint, evidence double, n_words bigint")


def _fit_curve(bins: list) -> tuple[float, float, float]:
    """Intercept, evidence and length weight of a logistic curve, by Newton's method."""
    if not bins:
        return -2.0, 4.0, 0.0
    x = np.array([[1.0, r["e"], r["s"]] for r in bins])
    y = np.array([r["y"] for r in bins], dtype=float)
    n = np.array([r["n"] for r in bins], dtype=float)
    scale = np.array([1.0, max(x[:, 1].std(), 1e-6), max(x[:, 2].std(), 1e-6)])
    z, beta = x / scale, np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (n * (y - p)) - 1e-2 * beta
        curve = (z * (n * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(3)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta / scale)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    toxic_column: str = "toxic",
    folds: int = 4,
    held_out_fold: int = 2,
) -> DataFrame:
    """``id, held_out, evidence, n_words, score`` for every row of ``docs``.

    Labels of the held-out fold are never read.  Of the others, the last fold fits the
    curve and the rest the models.  A label is the largest of its id's; null labels and
    ids count for nothing.  Null and empty texts, and texts without letters, have no
    evidence and get the curve's value there.  Without any label every score rests on the
    curve's defaults.  Rows that repeat an id are scored each on its own text.
    """
    spark = docs.sparkSession
    fold = id_fold(id_column, folds)
    known = (
        labels.select(F.col(id_column), F.col(toxic_column).cast("int").alias("y"))
        .where(F.col(id_column).isNotNull() & F.col("y").isin(0, 1))
        .where(fold != held_out_fold)
        .groupBy(id_column)
        .agg(F.max("y").alias("y"))
    )
    small = broadcast_if_small(known, known.count(), BROADCAST_LABELS)
    curve_fold = max(f for f in range(folds) if f != held_out_fold)
    fitting = docs.select(id_column, text_column).where(
        ~fold.isin(held_out_fold, curve_fold)
    ).join(small, id_column)
    discounts = class_discounts(fitting, text_column, "y")
    counts = class_counts(fitting, text_column, "y", discounts)
    models = spark.sparkContext.broadcast(_as_models(counts, discounts))
    scored = materialise(document_evidence(docs, models, id_column, text_column), "evidence")
    bounded = F.greatest(F.lit(-EVIDENCE_LIMIT), F.least(F.lit(EVIDENCE_LIMIT), "evidence"))
    inverse_root = 1 / F.sqrt(F.col("n_words") + 1)
    bins = (
        scored.withColumnRenamed("id", id_column)
        .where(fold == curve_fold)
        .join(small, id_column)
        .groupBy(
            (F.round(bounded / EVIDENCE_BIN) * EVIDENCE_BIN).alias("e"),
            (F.round(inverse_root * 32) / 32).alias("s"),
            "y",
        )
        .agg(F.count("*").alias("n"))
    )
    base, weight, length = _fit_curve(bins.collect())
    logit = F.lit(base) + F.lit(weight) * bounded + F.lit(length) * inverse_root
    return scored.select(
        "id",
        (id_fold("id", folds) == held_out_fold).alias("held_out"),
        "evidence",
        "n_words",
        (1 / (1 + F.exp(-logit))).alias("score"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without documents that score at or above ``threshold``; all columns.

    Rows with a null id are kept, for a score cannot be traced to them; of a repeated id
    all rows go if one does.
    """
    bad = toxicity_scores(docs, labels).where(F.col("score") >= threshold)
    return without_ids(docs, bad.select(F.col("id").alias("doc_id")), "toxic-ids")
