import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpora import documents, filler  # noqa: E402


@pytest.fixture(scope="session")
def messy_rows():
    """Null key, null and empty texts, ties, repeated rows, one very long text."""
    base = filler(1, 120)
    return [
        (1, base), (2, base), (2, base), (3, base + " more"), (4, None), (5, ""), (6, " \n\t "), (None, base), (None, None),
        (7, "one two"), (8, "one two"), (9, filler(2, 30_000)), (10, filler(3, 60) + "\n" + filler(3, 60)), (11, "x" * 5_000),
        (12, "Ünïcödé ☃ 🙂 " + filler(4, 40)), (13, '<|endoftext|> </s> token = "' + "0a1b2c3d4e" * 4 + '"'),
    ]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return documents(spark, messy_rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [(1, "x")]).where(F.lit(False))
