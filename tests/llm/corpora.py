"""Made-up words and small document tables."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, `key` string, gone int, _key int, id int, version int, words string"


def filler(seed, n, pool=400):
    draw = random.Random(seed)
    stems = ["the", "an", "re", "ing", "ou", "est", "ha", "ver", "lich", "ción"]
    names = ["".join(random.Random(f"w{k}").choices(stems, k=1 + k % 4)) for k in range(pool)]
    return " ".join(draw.choice(names) for _ in range(n))


def documents(spark, rows):
    """Rows of (doc_id, text) with further columns whose names occur inside the operators too."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", "k", 1, 2, 3, 4, "w") for i, t in rows], SCHEMA)
