"""Quality score: a regularised quadratic discriminant over document statistics.

Statistics are counted from the bytes, then transformed so that they lie more like normal ones. Each
class keeps its mean and a covariance shrunk towards its diagonal; Cholesky factors are computed once
and travel with the scoring tasks. The score is the logistic of the difference of the log densities,
each the Mahalanobis distance and the log determinant, plus the log odds of the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.hashing import U64, before, gram_hashes, inside, rows_of, span_hashes, word_bounds
from tabulon.llm.shared import in_fold, sampled, text_blocks

#: Labelled rows to learn from, about; share of the diagonal in a covariance; least variance.
LEARNED, SHRINKAGE, LEAST_VARIANCE = 60_000, 0.1, 1e-3
#: Largest difference of log densities that counts, so that no score is exactly 0 or 1.
MOST_LOG_ODDS = 30.0
THRESHOLD = 0.3


def _class(characters: str) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[[ord(c) for c in characters]] = 1
    return out


UPPER, DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
SYMBOL, MARK, POINT = _class("#*$%&|<>@^~{}[]\\=+_`"), _class("!?"), _class(".,;:")
LETTER_START = np.array([0 if 0x80 <= b < 0xC0 else 1 for b in range(256)], np.int32)
FEATURES = (
    "words", "word_chars", "word_chars_spread", "upper", "digits", "symbols", "marks", "points",
    "new_words", "new_triples", "same_as_before", "lines", "new_lines", "most_frequent",
)


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of n rows the number of different hashes, and how often the commonest occurs."""
    keys = np.sort(rows.astype(U64) << U64(48) | hashes >> U64(16))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    owner = (keys[first] >> U64(48)).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner, np.diff([*first, len(keys)]) if len(first) else first)
    return np.bincount(owner, minlength=n), most


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The log odds of a share, smoothed so that nothing and everything stay finite."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of transformed statistics for each text; a text without words has small, finite ones."""
    n = len(offsets) - 1
    by_row = lambda table: np.diff(before(table[data])[offsets])
    starts, ends, row_words = word_bounds(data, offsets)
    words = span_hashes(data, starts, ends)
    rows, count = rows_of(row_words), np.diff(row_words)
    points = before(LETTER_START[data])
    sizes = points[ends] - points[starts]
    chars = np.bincount(rows, sizes, n)
    mean = chars / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(np.bincount(rows, sizes.astype(float) ** 2, n) / np.maximum(count, 1) - mean**2, 0))
    new_words, most = _distinct(rows, words, n)
    at = inside(row_words, 3)
    triples = np.bincount(rows[at], minlength=n)
    new_triples, _ = _distinct(rows[at], gram_hashes(words, 3)[at] if len(at) else words[:0], n)
    again = np.flatnonzero((words[1:] == words[:-1]) & (rows[1:] == rows[:-1]))
    # Lines with a word: they begin at the first word after a line feed or the row's start.
    feeds = before((data == 10).astype(np.int64))
    line = feeds[starts]
    opens = np.ones(len(starts), bool)
    opens[1:] = (line[1:] != line[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(opens)
    sums = before(words * (np.arange(len(words), dtype=U64) - np.repeat(begin, np.diff([*begin, len(words)])).astype(U64) + U64(1)))
    bounds = np.append(begin, len(words))
    lines = np.bincount(rows[begin], minlength=n)
    new_lines, _ = _distinct(rows[begin], sums[bounds[1:]] - sums[bounds[:-1]], n)
    return np.stack(
        [
            np.log1p(count),
            np.log1p(mean),
            np.log1p(spread),
            _share(by_row(UPPER), chars),
            _share(by_row(DIGIT), chars),
            _share(by_row(SYMBOL), chars),
            _share(by_row(MARK), chars),
            _share(by_row(POINT), chars),
            _share(new_words, count),
            _share(new_triples, triples),
            _share(np.bincount(rows[again], minlength=n), count),
            np.log1p(count / np.maximum(lines, 1)),
            _share(new_lines, lines),
            _share(most, count),
        ],
        1,
    )


class Discriminant:
    """Means and inverse Cholesky factors of both classes."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        total = sum(n for n, _, _ in sums.values())
        self.classes = []
        for label in (0, 1):
            n, first, second = sums[label]
            mean = first / n
            covariance = second / n - np.outer(mean, mean)
            diagonal = np.diag(np.maximum(np.diag(covariance), LEAST_VARIANCE))
            factor = np.linalg.cholesky((1 - SHRINKAGE) * covariance + SHRINKAGE * diagonal + LEAST_VARIANCE * np.eye(len(mean)))
            self.classes.append((mean, np.linalg.inv(factor).T, -np.log(np.diag(factor)).sum() + np.log(n / total)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        zero, one = (rest - 0.5 * (((x - mean) @ factor) ** 2).sum(1) for mean, factor, rest in self.classes)
        return 1 / (1 + np.exp(-np.clip(one - zero, -MOST_LOG_ODDS, MOST_LOG_ODDS)))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", most: int = LEARNED) -> Discriminant | float:
    """Fit on about ``most`` labelled rows at most, drawn by a hash of the key.

    Labels other than 0 and 1 are left out. With fewer than two rows of a class there is nothing to fit:
    the share of label 1 is returned (0.5 without any rows), which then is the score of every text.
    """
    given = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).where("key is not null and label in (0, 1)")
    given = sampled(given, "key", most)
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = texts.join(F.broadcast(given), "key").select("label", "text")
    width = len(FEATURES)

    def add(batches):
        sums = np.zeros((2, 1 + width, 1 + width))
        for batch in batches:
            for part, data, offsets in text_blocks(batch):
                x = np.hstack([np.ones((len(part), 1)), statistics(data, offsets)])
                y = part.column(0).to_numpy()
                for k in (0, 1):
                    sums[k] += x[y == k].T @ x[y == k]
        k, i, j = np.indices(sums.shape).reshape(3, -1).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"k": k, "i": i, "j": j, "s": sums.ravel()})

    added = rows.mapInArrow(add, "k int, i int, j int, s double").groupBy("k", "i", "j").agg(F.sum("s").alias("s"))
    sums = np.zeros((2, 1 + width, 1 + width))
    for r in added.collect():  # two classes, one number for each two statistics
        sums[r["k"], r["i"], r["j"]] = r["s"]
    counts = sums[:, 0, 0]
    if counts.min() < 2:
        return float(counts[1] / counts.sum()) if counts.sum() else 0.5
    return Discriminant({k: (counts[k], sums[k, 0, 1:], sums[k, 1:, 1:]) for k in (0, 1)})


def scored(docs: DataFrame, model: Discriminant | float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``score`` (higher: label 1 likelier) for each row, from the text alone.

    Null text counts as empty, and empty texts are scored as any other. Repeated rows, null keys and other
    columns change nothing; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    if isinstance(model, float):
        return rows.select(F.col("key").alias(key), F.lit(model).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            for part, data, offsets in text_blocks(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(shared.value.scores(statistics(data, offsets)))], names=["key", "score"]
                )

    return rows.mapInArrow(work, f"key {rows.dtypes[0][1]}, score double").withColumnRenamed("key", key)


def held_out(key: str = "doc_id"):
    """Whether a row is of the fifth that is not learned from."""
    return in_fold(F.col(f"`{key}`"), 5, 0)
