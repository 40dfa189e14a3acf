"""Language identification by Bloom filters over n-grams, bit-sliced by language.

One table of bit masks serves all languages: the mask at a slot says which languages set the slot.
Two slots of an n-gram, and-ed, give all languages that contain it at once. For each text the bits are
counted by language, corrected for the false positives that the filling of each language's filter
lets through, and the highest count decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.hashing import before
from tabulon.llm.shared import checkpoint, in_fold, sampled, text_blocks

GRAM = 4
SLOT_BITS = 20
FACTORS = (0x9E3779B1, 0x85EBCA77)
#: Documents to learn from, about; the n-grams of a language must be met so often, and at least at
#: this share of the rate that the language with the highest rate has.
LEARNED, LEAST_COUNT, RATE_SHARE = 40_000, 3, 0.3
UNKNOWN = "und"
#: Letters in lower case, every other byte below 128 as a space, bytes of longer characters as they are.
FOLD = np.array([b | 0x20 if chr(b).isalpha() and b < 128 else b if b > 127 else 0x20 for b in range(256)], np.uint8)
LETTER = regex.compile(r"\p{L}")


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every run of four folded bytes inside a row, and where each row's begin."""
    folded = FOLD[data].astype(np.uint32)
    if len(folded) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    grams = folded[:-3] << 24 | folded[1:-2] << 16 | folded[2:-1] << 8 | folded[3:]
    ok = np.ones(len(grams), bool)
    for k in range(1, GRAM):
        cut = offsets - k
        ok[cut[(cut >= 0) & (cut < len(grams))]] = False
    # Runs of spaces and signs say nothing.
    ok &= (grams & 0xFFFFFF) != 0x202020
    return grams[ok], before(ok.astype(np.int64))[np.minimum(offsets, len(grams))]


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    return [(grams * np.uint32(f)) >> np.uint32(32 - SLOT_BITS) for f in FACTORS]


class Profile:
    """Languages, the table of masks (one column for 64 languages), and false positives by language."""

    def __init__(self, languages: list[str], masks: np.ndarray, default: str):
        self.languages, self.masks, self.default = languages, masks, default
        filled = [np.mean(masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(languages))]
        self.false = np.array(filled) ** len(FACTORS)
        if len(languages) <= 8:  # a smaller table stays in the processor's cache
            self.masks = masks.astype(np.uint8)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Corrected counts by row and language."""
        grams, starts = _grams(data, offsets)
        one, two = _slots(grams)
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        total = np.diff(starts)
        for word in range(self.masks.shape[1]):
            found = self.masks[one, word] & self.masks[two, word]
            for k in range(word * 64, min(len(self.languages), word * 64 + 64)):
                has = (found >> found.dtype.type(k % 64)) & found.dtype.type(1)
                sums = before(has.astype(np.int32))
                out[:, k] = sums[starts[1:]] - sums[starts[:-1]]
        return np.maximum(0.0, (out - total[:, None] * self.false) / np.maximum(1e-9, 1 - self.false))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = LEARNED) -> Profile | None:
    """Learn from the rows given that have text and language, about ``most`` of them at most.

    None when there are none. The driver receives the languages and at most 2**20 masks.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = sampled(rows.where("lang is not null and text is not null"), "key", most).select("lang", "text")

    def count(batches):
        for batch in batches:
            names = batch.column(0)
            for name in names.unique().to_pylist():
                for _, data, offsets in text_blocks(batch.filter(pc.equal(names, name))):
                    grams, counts = np.unique(_grams(data, offsets)[0], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": [name] * len(grams), "gram": grams.astype(np.int64), "n": counts})

    counted = rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = checkpoint(counted)
    totals = sorted((r["lang"], r["n"]) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    if not totals:
        return None
    languages = [name for name, _ in totals]
    numbers = docs.sparkSession.createDataFrame([(name, k, float(n)) for k, (name, n) in enumerate(totals)], "lang string, k int, total double")
    rates = counted.join(F.broadcast(numbers), "lang").withColumn("rate", F.col("n") / F.col("total"))
    held = rates.groupBy("gram").agg(F.max("rate").alias("top")).join(rates, "gram").where(f"n >= {LEAST_COUNT} and rate >= {RATE_SHARE} * top")
    slot = [F.shiftrightunsigned((F.col("gram") * F.lit(f)).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - SLOT_BITS) for f in FACTORS]
    bit = F.expr("shiftleft(1L, k % 64)")
    slots = held.select(F.explode(F.array(*slot)).alias("slot"), F.expr("k div 64").alias("word"), bit.alias("bit"))
    found = slots.groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")).toArrow()
    masks = np.zeros((1 << SLOT_BITS, len(languages) + 63 >> 6), np.uint64)
    masks[found["slot"].to_numpy(), found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return Profile(languages, masks, max(totals, key=lambda x: x[1])[0])


def identify(docs: DataFrame, profile: Profile | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, ``lang_pred`` and ``score`` for each row, from the text alone.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. A text whose
    n-grams are all unknown gets the language with most training text, and score 0. Ties go to the first
    language in alphabetical order. Repeated rows, null keys and other columns change nothing; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    if profile is None:
        return rows.select(F.col("key").alias(key), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    model = docs.sparkSession.sparkContext.broadcast(profile)

    def work(batches):
        known = model.value
        names = np.array(known.languages, object)
        for batch in batches:
            for part, data, offsets in text_blocks(batch):
                counts = known.counts(data, offsets)
                total = counts.sum(1)
                best = counts.argmax(1)
                score = counts[np.arange(len(best)), best] / np.maximum(total, 1e-9)
                found = np.where(total > 0, names[best], known.default)
                none = np.array([not LETTER.search(b or "") for b in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.where(none, UNKNOWN, found), pa.string()), pa.array(np.where(none, 0.0, score))],
                    names=["key", "lang_pred", "score"],
                )

    return rows.mapInArrow(work, f"key {rows.dtypes[0][1]}, lang_pred string, score double").withColumnRenamed("key", key)


def held_out(key: str = "doc_id"):
    """Whether a row is of the third that is not learned from."""
    return in_fold(F.col(f"`{key}`"), 3, 1)
