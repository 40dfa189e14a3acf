"""Byte-level byte-pair encoding and decoding from a file of ranks.

Each match of the split pattern is encoded alone, but the new pre-tokens of a block share one queue.
It has a bucket for each merge rank, holding positions of a linked list of symbols. A hierarchy of
bitmaps over the ranks gives the lowest bucket that is not empty by find-first-set. The bucket is
drained from the left; entries whose pair has changed since are skipped. A merge that makes a pair
of lower rank puts the rest of the bucket back, so in every pre-token the lowest rank always comes
first. A pre-token of n bytes takes O(n log n), however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.shared import text_blocks

#: Distinct pre-tokens whose ids a task remembers, and of those the ones learned first, which are the frequent ones,
#: that a worker takes to its next task: an idle worker keeps its memory while other stages run. Neither changes a result.
REMEMBERED, TAKEN_ON = 250_000, 50_000

#: Bytes of pre-tokens that share a queue, one pre-token at least.
MERGED_TOGETHER = 1 << 18


class RankQueue:
    """Buckets of positions by rank.

    ``low`` has a bit for each rank that has a bucket, ``middle`` one for each word of ``low`` that is
    not zero, and ``top`` one for each such word of ``middle``.
    """

    __slots__ = ("buckets", "low", "middle", "top")

    def __init__(self, ranks: int):
        self.buckets: list[list[int] | None] = [None] * ranks
        self.low = [0] * (ranks + 63 >> 6)
        self.middle = [0] * (len(self.low) + 63 >> 6)
        self.top = 0

    def open(self, rank: int, positions: list[int]) -> None:
        """Give a rank that has none a bucket."""
        self.buckets[rank] = positions
        word = rank >> 6
        bits = self.low[word]
        self.low[word] = bits | 1 << (rank & 63)
        if not bits:
            up = word >> 6
            self.middle[up] |= 1 << (word & 63)
            self.top |= 1 << up

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank and its bucket, which is removed; only called while ``top`` is not zero."""
        up = (self.top & -self.top).bit_length() - 1
        bits = self.middle[up]
        word = up << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        bit = bits & -bits
        rank = word << 6 | bit.bit_length() - 1
        self.low[word] = bits = bits ^ bit
        if not bits:
            self.middle[up] = bits = self.middle[up] ^ (1 << (word & 63))
            if not bits:
                self.top ^= 1 << up
        bucket, self.buckets[rank] = self.buckets[rank], None
        return rank, bucket


class Codec:
    """Ranks and pattern; """

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        top = max(self.ranks.values()) + 1
        self.bytes_of = [b""] * top
        self.of_byte = np.zeros(256, np.int64)
        self.of_pair = np.full(1 << 16, -1, np.int64)
        for piece, rank in self.ranks.items():
            self.bytes_of[rank] = piece
            if len(piece) == 1:
                self.of_byte[piece[0]] = rank
            elif len(piece) == 2:
                self.of_pair[piece[0] << 8 | piece[1]] = rank
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(top)
        self.known: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token. One gap follows each of them, where the linked list ends."""
        data = b"\0".join(pieces) + b"\0"
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        gaps = np.cumsum([len(p) + 1 for p in pieces]) - 1
        n = len(data)
        end_ = np.arange(1, n + 1)
        end_[gaps] = 0
        back_ = np.arange(-1, n - 1)
        back_[gaps[:-1] + 1] = -1
        made_ = self.of_byte[codes]
        rank_ = np.full(n, -1)
        rank_[:-1] = self.of_pair[codes[:-1] << 8 | codes[1:]]
        rank_[gaps] = -1
        rank_[gaps - 1] = -1
        queue = self.queue
        places = np.flatnonzero(rank_ >= 0)
        places = places[np.argsort(rank_[places], kind="stable")]
        first, cut = np.unique(rank_[places], return_index=True)
        for rank, bucket in zip(first.tolist(), np.split(places, cut[1:])):
            queue.open(rank, bucket.tolist())
        # end: where the symbol that starts here ends, 0 at gaps and once it was merged away;
        # back: where the one before starts; now: the rank of the pair that starts here.
        end, back, made, now = end_.tolist(), back_.tolist(), made_.tolist(), rank_.tolist()
        rank_of, buckets, open_ = self.ranks.get, queue.buckets, queue.open
        while queue.top:
            rank, bucket = queue.take()
            bucket.sort()
            for k, i in enumerate(bucket):
                if now[i] != rank:
                    continue  # stale
                j = end[i]
                stop = end[j]
                end[i], end[j], made[i], now[j] = stop, 0, rank, -1
                lower = False
                later = end[stop]
                if later:
                    back[stop] = i
                    now[i] = new = rank_of(data[i:later], -1)
                    if new >= 0:
                        if (at := buckets[new]) is not None:
                            at.append(i)
                        else:
                            open_(new, [i])
                        lower = new <= rank
                else:
                    now[i] = -1
                h = back[i]
                if h >= 0:
                    now[h] = new = rank_of(data[h:stop], -1)
                    if new >= 0:
                        if (at := buckets[new]) is not None:
                            at.append(h)
                        else:
                            open_(new, [h])
                        lower |= new <= rank
                if lower and k + 1 < len(bucket):
                    if (at := buckets[rank]) is not None:
                        at.extend(bucket[k + 1 :])
                    else:
                        open_(rank, bucket[k + 1 :])
                    break
        alive = np.array(end, np.int64) > 0
        ids = np.array(made, np.int64)[alive].astype("<u4").tobytes()
        counts = np.cumsum(alive)[gaps] * 4
        return [ids[a:b] for a, b in zip([0, *counts[:-1].tolist()], counts.tolist())]

    def _learn(self, tokens: list[str]) -> None:
        """Remember the ids of these; a few hundred kilobytes are merged together."""
        known, batch, size = self.known, [], 0
        for token in tokens:
            piece = token.encode()
            whole = self.ranks.get(piece)
            if whole is not None:
                known[token] = whole.to_bytes(4, "little")
                continue
            batch.append((token, piece))
            size += len(piece)
            if size > MERGED_TOGETHER:
                known.update(zip([t for t, _ in batch], self.merge([p for _, p in batch])))
                batch, size = [], 0
        if batch:
            known.update(zip([t for t, _ in batch], self.merge([p for _, p in batch])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        split = [self.find(t) for t in texts]
        known = self.known
        new = set().union(*split).difference(known)
        if len(known) + len(new) > REMEMBERED:
            known = self.forget()
            new = set().union(*split).difference(known)
        self._learn(new)
        return [b"".join(map(known.__getitem__, tokens)) for tokens in split]

    def forget(self) -> dict[str, bytes]:
        """Keep the pre-tokens learned first; what is left."""
        if len(self.known) > TAKEN_ON:
            self.known = dict(islice(self.known.items(), TAKEN_ON))
        return self.known

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def codec(rank_file: bytes, pattern: str) -> Codec:
    """Built once in each worker."""
    return Codec(rank_file, pattern)


def remembering(coder: Codec, parts, done):
    """``done`` of each part of a task, which at its end keeps only what a worker may take on."""
    try:
        yield from map(done, parts)
    finally:
        coder.forget()


def _mapped(docs: DataFrame, key: str, text: str, rank_path: str, pattern: str, row, schema: str) -> DataFrame:
    """``row(ids, decoded bytes)`` for each row; ``schema`` names and types what it returns."""
    with open(rank_path, "rb") as file:  # under a megabyte, read once by the driver
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    names = ["key", *(field.split()[0] for field in schema.split(", "))]

    def work(batches):
        coder = codec(ranks.value, pattern)

        def done(part):
            texts = [body or "" for body in part.column(1).to_pylist()]
            rows = [row(ids, coder.decode(ids)) for ids in coder.encode(texts)]
            return pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, zip(*rows))], names=names)

        yield from remembering(coder, (part for batch in batches for part, _, _ in text_blocks(batch)), done)

    return kept.mapInArrow(work, f"key {kept.dtypes[0][1]}, {schema}").withColumnRenamed("key", key)


def encoded(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_tokens, token_ids and the digest of the bytes they decode to, for each row.

    Null text is empty and has no tokens. Repeated rows, null keys and other columns need no care:
    rows are independent. Texts of any length are encoded whole.
    """

    def row(ids: bytes, decoded: bytes):
        return len(ids) // 4, np.frombuffer(ids, "<i4"), hashlib.sha256(decoded).hexdigest()

    return _mapped(docs, key, text, rank_path, pattern, row, "n_tokens bigint, token_ids array<int>, decoded_sha256 string")


def digests(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_tokens, and the digests of the ids and of the decoded bytes, for each row."""

    def row(ids: bytes, decoded: bytes):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _mapped(docs, key, text, rank_path, pattern, row, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
