"""Small documents with every awkward case, and the plain Python versions to hold against."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def documents(seed: int = 3, n: int = 40) -> list[tuple]:
    """Rows of ``documents``: copies, near copies, shared lines and passages, nulls, a long one."""
    rng = random.Random(seed)
    shared = prose(rng, 40)
    rows = []
    for i in range(n):
        lines = [prose(rng, rng.randrange(1, 60)) for _ in range(rng.randrange(1, 5))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), shared)
        rows.append((i, "\n".join(lines), ["en", "de", None][i % 3], f"src{i % 6}", 0))
    rows.append((n, rows[1][1], "en", "src1", 0))
    rows.append((n + 1, rows[2][1] + " more", "en", "src1", 0))
    rows.append((n + 2, "", "en", "src2", 0))
    rows.append((n + 3, None, None, None, None))
    rows.append((n + 4, " \t\n", "en", "", 0))
    rows.append((n + 5, "éa ü" * 60 + "\nÉA Ü " + "x" * 300, "de", "odd", 0))
    rows.append((n + 6, prose(rng, 20_000, 5_000), "en", "src0", 0))
    rows.append((n + 7, "same same same same " * 40, "en", "src0", 0))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ascii_lower(text: str) -> str:
    return text.encode().lower().decode()
