"""Token counts under a vocabulary of merges with word ends, by rank-synchronous array merging.

All distinct new pre-tokens of a block are held as one ragged array of symbols. Each round finds the
lowest rank of a neighbouring pair in every sequence and merges all its places in all sequences at
once, until no sequence has a pair left; what survives is counted. A merge never makes a pair of
lower rank than itself (checked when the file is read), so merging all places of one pair at once
gives what merging them one by one gives.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.shared import text_blocks

#: Distinct pre-tokens whose counts a worker remembers; beyond it starts anew, which changes no result.
REMEMBERED = 500_000
NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable in Latin-1, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return [chr(b) if b in set(printable) else chr(0x100 + others.index(b)) for b in range(256)]


class PairTable:
    """Rank and result of a pair of symbols, by open addressing in two arrays."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NONE, np.int64)
        self.made = np.zeros(size, np.int64)
        left = np.arange(len(pairs))
        slot = self.first(pairs)
        while len(left):
            free = self.keys[slot] < 0
            slots, picked = np.unique(np.where(free, slot, -1), return_index=True)
            picked = picked[slots >= 0]
            took = left[picked]
            self.keys[slot[picked]], self.ranks[slot[picked]], self.made[slot[picked]] = pairs[took], ranks[took], made[took]
            stay = np.ones(len(left), bool)
            stay[picked] = False
            left, slot = left[stay], (slot[stay] + 1) & (size - 1)

    def first(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        """The slot of each pair; a free slot, of no rank, where the pair has none."""
        slot = self.first(pairs)
        open_ = np.flatnonzero((self.keys[slot] != pairs) & (self.keys[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[open_]]
            open_ = open_[(found != pairs[open_]) & (found >= 0)]
        return slot


class Counter:
    """Counts tokens as the library that reads the file does."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"]
        self.width = len(vocabulary)
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        # A suffix is part of the last symbol's text; the result is the two texts together.
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        ranks = np.arange(len(merges), dtype=np.int64)
        born = np.full(self.width, -1, np.int64)
        born[made[::-1]] = ranks[::-1]
        if (np.maximum(born[left], born[right]) >= ranks).any():
            raise ValueError("a merge comes before the merges that make its symbols")
        self.pairs = PairTable(left * self.width + right, ranks, made)
        letters = byte_letters()
        self.inner = np.array([vocabulary[x] for x in letters], np.int64)
        self.last = np.array([vocabulary[x + self.suffix] for x in letters], np.int64)
        steps = spec["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("other normalisation than NFC, spaces, lower case")
        self.find = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))
        self.known: dict[str, int] = {}

    def normal(self, text: str) -> str:
        """Composed, lower case letter by letter (a sigma at a word's end is no special case)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def words(self, text: str) -> tuple[int, list[str]]:
        """The number of special strings, and the pre-tokens between them."""
        parts = self.special.split(text) if "<|" in text else [text]
        if len(parts) == 1:
            return 0, self.find(self.normal(text))
        return len(parts) - 1, [w for part in parts for w in self.find(self.normal(part))]

    def merged(self, words: list[str]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        symbols = self.inner[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = self.last[np.frombuffer(b"".join(r[-1:] for r in raw), np.uint8)]
        counts = np.zeros(len(words), np.int64)
        alive = np.arange(len(words))  # the sequences still held, in order
        while len(alive):
            starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(alive)), sizes)
            slot = np.full(len(symbols), -1, np.int64)
            rank = np.full(len(symbols), NONE, np.int64)
            pair = np.flatnonzero(owner[1:] == owner[:-1])
            slot[pair] = self.pairs.slots(symbols[pair] * self.width + symbols[pair + 1])
            rank[pair] = self.pairs.ranks[slot[pair]]
            least = np.minimum.reduceat(rank, starts)
            hit = (rank == least[owner]) & (rank < NONE)
            # Overlapping places (a run of one symbol): every second of a run, from the left.
            if (hit[1:] & hit[:-1]).any():
                place = np.arange(len(hit))
                begins = hit & ~np.concatenate([[False], hit[:-1]])
                since = place - np.maximum.accumulate(np.where(begins, place, 0))
                hit &= since % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.pairs.made[slot[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            going = least < NONE
            counts[alive[~going]] = sizes[~going]
            keep &= going[owner]
            sizes = (sizes - np.bincount(owner[at], minlength=len(alive)))[going]
            symbols, alive = symbols[keep], alive[going]
        return counts

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.words(t) for t in texts]
        known = self.known
        new = {w for _, words in split for w in words if w not in known}
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = {w for _, words in split for w in words}
            new = list(new)
            known.update(zip(new, self.merged(new).tolist()))
        return [special + sum(map(known.__getitem__, words)) for special, words in split]


@lru_cache(2)
def counter(file: bytes) -> Counter:
    """Built once in each worker."""
    return Counter(file)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_bytes, n_tokens and over_limit for each row.

    Null text is empty and has no tokens; rows are independent, so ties, repeated rows, null keys and
    other columns change nothing. Whole texts are counted.
    """
    with open(path, "rb") as source:  # a few megabytes, read once by the driver
        file = docs.sparkSession.sparkContext.broadcast(source.read())
    kept = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def work(batches):
        count = counter(file.value)
        for batch in batches:
            for part, _, offsets in text_blocks(batch):
                tokens = np.array(count.counts([t or "" for t in part.column(1).to_pylist()]), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, (np.diff(offsets), tokens, tokens > limit))],
                    names=["key", "n_bytes", "n_tokens", "over_limit"],
                )

    schema = f"key {kept.dtypes[0][1]}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return kept.mapInArrow(work, schema).withColumnRenamed("key", key)
