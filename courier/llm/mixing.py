"""Mixing sources to target weights by hierarchical token budgets.

Documents hang as leaves' contents in a tree of levels, such as domain, language, source.
A node can give as many tokens as its documents have, times the most epochs allowed.  A
budget flows from the root down: children share their parent's by weight, a child that
cannot use its share is filled, and what it leaves goes to its siblings.  As a node's
capacity is that of everything below it, siblings take up a shortage before it shows one
level higher.

A leaf's budget is whole epochs of its documents, and then a prefix of one more epoch: its
documents in an order seeded by the epoch, as long as their tokens fit.

All amounts are whole numbers, so results do not depend on the order of additions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courier.llm.common import text_of, words_of
from courier.sources.scratch import materialise

LEVELS = ("domain", "lang", "source")
#: Relative weights of nodes by level; nodes not named weigh 1.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"d0": 4, "d1": 3, "d2": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 3},
    "source": {"src0": 2},
}
#: Budget as a fraction of all tokens there are, and the most epochs of a document.
BUDGET = (3, 4)
MAX_EPOCHS = 2
SEED = 17
#: Hex digits of the order key that split a leaf: 4,096 slices.
SLICE_DIGITS = 3


def domain_of_source(source: str | Column) -> Column:
    """The domain of a source: by the number at its end, modulo 4."""
    source = F.col(source) if isinstance(source, str) else source
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("none")).otherwise(
        F.concat(F.lit("d"), (number.cast("int") % 4).cast("string"))
    )


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in weights.items():
        out = F.when(F.col(level) == name, weight).otherwise(out)
    return out.cast("bigint")


def fill_children(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Add ``given``: each node's part of ``budget``, its parent's, by ``weight``.

    ``nodes`` has ``capacity``.  Nodes are filled in the order of capacity per weight; the
    first that its share does not fill ends the filled ones.
    """
    able = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(F.lit(0))
    weight = F.greatest("weight", F.lit(1))
    rows = nodes.withColumn("able", able.cast("decimal(20,0)")).withColumn(
        "w", weight.cast("decimal(9,0)")
    )
    group = Window.partitionBy(*parent)
    order = group.orderBy(
        F.expr("able div w"), (F.expr("able % w").cast("double") / F.col("w").cast("double")), name
    )
    before = F.coalesce(
        F.sum("able").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    after = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("before", before.cast("decimal(20,0)")).withColumn(
        "after", after.cast("decimal(18,0)")
    )
    filled = F.col("able") * F.col("after") <= (F.col("budget") - F.col("before")) * F.col("w")
    rows = rows.withColumn("filled", filled)
    used = F.sum(F.when(F.col("filled"), F.col("able")).otherwise(F.lit(0))).over(group)
    open_weight = F.sum(F.when(~F.col("filled"), F.col("w")).otherwise(F.lit(0))).over(group)
    rows = rows.withColumn("left", (F.col("budget") - used).cast("decimal(20,0)")).withColumn(
        "open", F.greatest(open_weight, F.lit(1)).cast("decimal(18,0)")
    )
    share = F.expr("(left * w) div open")
    given = F.when(F.col("filled"), F.col("able").cast("bigint")).otherwise(share)
    return rows.withColumn("given", given).drop("able", "w", "before", "after", "filled", "left", "open")


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    budget: tuple[int, int],
    max_epochs: int,
) -> DataFrame:
    """``leaves`` (the levels and ``supply``) with ``given``, each leaf's token budget."""
    total = leaves.agg(F.sum("supply")).first()[0] or 0
    rows = leaves.withColumn(
        "given", F.lit(min(total * budget[0] // budget[1], total * max_epochs)).cast("bigint")
    )
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = rows.groupBy(*path).agg(
            (F.sum("supply") * max_epochs).alias("capacity"), F.first("given").alias("budget")
        )
        nodes = nodes.withColumn("weight", _weight(level, weights.get(level, {}))).withColumn(
            "root", F.lit(0)
        )
        shared = fill_children(nodes, path[:-1] or ["root"], level).select(*path, "given")
        rows = rows.drop("given").join(shared, path)
    return rows


def mixed_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    domain: Column | None = None,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, domain, lang, source, n_tokens, copies`` of every document chosen.

    ``budget`` is a fraction of all tokens; a token is a run without white space.  A null
    level counts as the empty name, a null text as no tokens; documents without tokens cost
    nothing and come with the prefix they stand in.  Leaves without any token give nothing.
    A node of weight 0 gives nothing.  Equal order keys (repeated or null ids) go by id and
    tokens.  Of a table without rows nothing is chosen.
    """
    domain = domain_of_source("source") if domain is None else domain
    named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    slim = materialise(
        docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"),
            named(domain).alias("domain"),
            named(F.col("lang")).alias("lang"),
            named(F.col("source")).alias("source"),
            F.size(words_of(text_of(text_column))).cast("bigint").alias("n_tokens"),
        ),
        "mixing",
    )
    levels = list(LEVELS)
    leaves = materialise(
        slim.groupBy(*levels).agg(F.sum("n_tokens").alias("supply")).where("supply > 0"), "leaves"
    )
    budgets = materialise(
        leaf_budgets(leaves, levels, weights, budget, max_epochs).select(
            *levels,
            F.expr("given div supply").alias("epochs"),
            F.expr("given % supply").alias("rest"),
        ),
        "budgets",
    )
    key = F.md5(
        F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), named(F.col("doc_id")))
    )
    keyed = (
        slim.join(budgets, levels)
        .withColumn("key", key)
        .withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    )
    # A leaf may hold a third of all rows, so running totals go slice by slice.
    slices = keyed.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("amount"))
    earlier = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.select(
        *levels, "slice", F.coalesce(F.sum("amount").over(earlier), F.lit(0)).alias("before")
    )
    within = (
        Window.partitionBy(*levels, "slice")
        .orderBy("key", "doc_id", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = F.col("before") + F.sum("n_tokens").over(within)
    in_prefix = (F.col("rest") > 0) & (reached <= F.col("rest"))
    copies = F.col("epochs") + F.when(in_prefix, 1).otherwise(0)
    return (
        keyed.join(before, [*levels, "slice"])
        .withColumn("copies", copies.cast("bigint"))
        .where("copies > 0")
        .select("doc_id", *levels, "n_tokens", "copies")
    )


def mix_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The chosen documents, all their columns, and ``copies``: how often each is used.

    Rows that repeat an id come with the largest of its copies; those with a null id are
    left out, for a choice cannot be traced to them.
    """
    chosen = mixed_copies(docs, **parameters).where("doc_id is not null")
    copies = chosen.groupBy("doc_id").agg(F.max("copies").alias("copies"))
    return docs.drop("copies").join(copies, "doc_id")
