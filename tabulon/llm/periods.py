"""Periodic runs of words, found by internal pattern matching over a suffix array.

A run is a stretch of words with smallest period q that is at least ``LEAST`` words and two periods long
and that no neighbour extends. Every run holds two equal stretches of six words, so a sort of six-word
hashes first sets aside the texts that hold none. For the others:

* Prefix doubling gives the suffix array and, for each length 2**k, the interval of it that starts with
  the words of any place. Only groups that are not settled yet are sorted again.
* With b = 2**k <= (q + 1) / 2 a run of period q >= 7 holds a block of b words, whose start is a multiple
  of b, again q words later, and 2b - 1 <= q <= 4b - 2 for the largest such b. (Periods to 5 use blocks of 4
  and period 6 blocks of 2, as a run is at least 12 words long.) So each block asks for its occurrences in
  the window next to it: a range successor in a wavelet tree over the suffix array.
* Occurrences at most b / 2 apart form a progression whose difference p is the period of the block. If the
  stretches of period p around the block and around the progression are the same, only p can be the period
  of a run there; if they lie apart, only the distances of their ends can be periods; if they touch,
  every member of the progression gives a run of its own or none.
* Each candidate is extended to both sides by hashes of prefixes and binary search.

All texts of a block of at most 2 MB (or one longer text) share the arrays; equal words of different texts
differ in them. Work is about n log n in the words of a text, its memory about 200 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.hashing import U64, before, gram_hashes, inside, inverse, mix, powers, rows_of, span_hashes, word_bounds
from tabulon.llm.shared import text_blocks

#: Words of the shortest run, and words that any run repeats.
LEAST, ECHO = 12, 6
BASE = 0xB5297A4D3F84D5B5


class Factors:
    """Suffix array of words by prefix doubling, with the interval of each place at every length 2**k."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        """``bounds``: the first word of each text, and the end of the last."""
        self.n, self.row = len(words), rows_of(bounds)
        self.first, self.end = bounds[:-1][self.row], bounds[1:][self.row]
        self.array = np.arange(self.n)
        self.rank = np.zeros(self.n, np.int64)
        # Equal words of different texts are different symbols.
        self._split(np.arange(self.n), (mix(words ^ mix(self.row.astype(U64) + U64(1))) >> U64(1)).view(np.int64), None)

    def _split(self, slots: np.ndarray, key: np.ndarray, within: np.ndarray | None) -> None:
        """Order the places in these slots of the array by key inside their groups."""
        order = np.argsort(key, kind="stable") if within is None else np.lexsort((key, within))
        places = self.array[slots][order]
        key = key[order]
        lead = np.ones(len(slots), bool)
        lead[1:] = key[1:] != key[:-1]
        if within is not None:
            within = within[order]
            lead[1:] |= within[1:] != within[:-1]
        self.array[slots] = places
        self.rank[places] = slots[np.maximum.accumulate(np.where(lead, np.arange(len(slots)), 0))]

    def sizes(self) -> np.ndarray:
        """Places in the group of each place."""
        return np.bincount(self.rank, minlength=self.n)[self.rank]

    def double(self, length: int, sizes: np.ndarray) -> None:
        """From groups of equal ``length`` words to groups of twice as many."""
        slots = np.flatnonzero(sizes[self.array] > 1)
        places = self.array[slots]
        # Where the text ends before, a place is alone: its distance to the end is its own.
        left = self.end[places] - places
        ahead = self.rank[np.minimum(places + length, self.n - 1)]
        self._split(slots, np.where(left >= 2 * length, ahead, -left), self.rank[places])


class WaveletTree:
    """Levels of bits of an array of numbers, for counts below a limit and successors in any interval."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1
            packed = np.zeros(-(-(self.n + 1) // 64) * 8, np.uint8)
            raw = np.packbits(ones.astype(bool), bitorder="little")
            packed[: len(raw)] = raw
            packed = packed.view("<u8")
            self.levels.append((packed, before(np.bitwise_count(packed).astype(np.int64)), self.n - int(ones.sum())))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        packed, counts, _ = level
        word = at >> 6
        return counts[word] + np.bitwise_count(packed[word] & ((U64(1) << (at & 63).astype(U64)) - U64(1)))

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers at lo <= place < hi are less than the limit."""
        count, every = np.zeros(len(lo), np.int64), hi - lo
        for bit, level in zip(range(self.bits - 1, -1, -1), self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            one = (limit >> bit) & 1 == 1
            count += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, level[2] + a, lo - a), np.where(one, level[2] + b, hi - b)
        return np.where(limit >> self.bits > 0, every, count)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number that k others of lo <= place < hi come before."""
        value = np.zeros(len(lo), np.int64)
        for bit, level in zip(range(self.bits - 1, -1, -1), self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            zeros = (hi - b) - (lo - a)
            one = k >= zeros
            k = np.where(one, k - zeros, k)
            value += np.where(one, 1 << bit, 0)
            lo, hi = np.where(one, level[2] + a, lo - a), np.where(one, level[2] + b, hi - b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray, none: int) -> np.ndarray:
        """The least number of at least the limit at lo <= place < hi, or ``none``."""
        k = self.below(lo, hi, limit)
        found = np.full(len(lo), none, np.int64)
        there = np.flatnonzero(k < hi - lo)
        found[there] = self.smallest(lo[there], hi[there], k[there])
        return found


class Extensions:
    """How far the words from two places of one text agree, to the right and to the left."""

    def __init__(self, words: np.ndarray, factors: Factors):
        self.sums = before(words * powers(BASE, len(words)))
        self.back = powers(inverse(BASE), len(words) + 1)
        self.factors = factors

    def _same(self, i, j, length):
        left = (self.sums[i + length] - self.sums[i]) * self.back[i]
        return left == (self.sums[j + length] - self.sums[j]) * self.back[j]

    def _longest(self, most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) >> 1
            fits = same(open_, middle)
            low[open_[fits]] = middle[fits]
            high[open_[~fits]] = middle[~fits] - 1
        return low

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self._longest(self.factors.end[i] - j, lambda at, m: self._same(i[at], j[at], m))

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self._longest(i - self.factors.first[i], lambda at, m: self._same(i[at] - m, j[at] - m, m))

    def stretch(self, i: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the words around i that equal those one period on."""
        return i - self.left(i, i + period), i + period + self.right(i, i + period)


def _blocks(factors: Factors):
    """Dyadic blocks that occur again in their text: place, interval, length, and window of periods."""
    bounds, row_length = [], factors.end - factors.first
    longest = int(row_length.max(initial=0))
    length, pairs = 1, []
    while True:
        sizes = factors.sizes()
        if length > 1:
            at = np.flatnonzero(((np.arange(factors.n) - factors.first) % length == 0) & (sizes > 1))
            at = at[at + length <= factors.end[at]]
            if length == 2:
                ahead = at[at + ECHO < factors.end[at]]
                pairs = ahead[factors.rank[ahead] == factors.rank[ahead + ECHO]]
            else:
                least = 1 if length == 4 else 2 * length - 1
                bounds.append((at, factors.rank[at], sizes[at], np.full(len(at), length), np.full(len(at), least)))
        if not (sizes > 1).any() or 8 * length - 2 > 2 * longest:
            break
        factors.double(length, sizes)
        length *= 2
    empty = [np.zeros(0, np.int64)] * 5
    return pairs, [np.concatenate(x) for x in zip(*bounds)] if bounds else empty


def _candidates(factors: Factors, extensions: Extensions):
    """Pairs (place, period) that hold the smallest period of every run at one place of it or more."""
    pairs, (x, begin, size, length, least) = _blocks(factors)
    places, periods = [np.asarray(pairs, np.int64)], [np.full(len(pairs), ECHO, np.int64)]
    if not len(x):
        return places[0], periods[0]
    # Only suffixes inside the intervals asked for enter the tree.
    cover = np.zeros(factors.n + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + size, -1)
    used = np.cumsum(cover[:-1]) > 0
    slot = before(used.astype(np.int64))
    tree = WaveletTree(factors.array[used])
    lo, hi = slot[begin], slot[begin + size]
    place = x + least
    last = np.minimum(x + 4 * length - 2, factors.end[x] - length)
    while True:
        open_ = np.flatnonzero(place <= last)
        if not len(open_):
            break
        x, lo, hi, length, place, last = (v[open_] for v in (x, lo, hi, length, place, last))
        found = tree.successor(lo, hi, place, factors.n)
        open_ = np.flatnonzero(found <= last)
        x, lo, hi, length, last, found = (v[open_] for v in (x, lo, hi, length, last, found))
        step = tree.successor(lo, hi, found + 1, 2 * factors.n) - found
        many = 2 * step <= length
        places.append(x[~many])
        periods.append((found - x)[~many])
        place = found + 1
        at = np.flatnonzero(many)
        if len(at):
            x0, x1, p = x[at], found[at], step[at]
            s0, e0 = extensions.stretch(x0, p)
            s1, e1 = extensions.stretch(x1, p)
            # Only windows of blocks of 4 reach down to the period of the block itself.
            own = (s1 == s0) & (length[at] == 4)
            places.append(x0[own])
            periods.append(p[own])
            apart = s1 > e0
            for q in (s1 - s0, e1 - e0):
                fits = apart & (q > 0)
                places.append(x0[fits])
                periods.append(q[fits])
            touch = np.flatnonzero((s1 != s0) & ~apart)
            members = (np.minimum(last[at], e1 - length[at])[touch] - x1[touch]) // p[touch] + 1
            inner = np.arange(members.sum()) - np.repeat(np.cumsum(members) - members, members)
            places.append(np.repeat(x0[touch], members))
            periods.append(np.repeat((x1 - x0)[touch], members) + inner * np.repeat(p[touch], members))
            place[at] = np.maximum(place[at], e1 - length[at] + 1)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(words: np.ndarray, bounds: np.ndarray):
    """Text, start, length and period of all runs, in this order, for hashed words of many texts."""
    if not len(words):
        return (np.zeros(0, np.int64),) * 4
    factors = Factors(words, bounds)
    extensions = Extensions(words, factors)
    place, period = _candidates(factors, extensions)
    fits = place + period < factors.end[place] if len(place) else np.zeros(0, bool)
    place, period = place[fits], period[fits]
    start, end = extensions.stretch(place, period)
    length = end - start
    fits = length >= np.maximum(LEAST, 2 * period)
    start, length, period = start[fits], length[fits], period[fits]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # A multiple of a run's period has the same bounds; the smallest is the period.
    lead = np.ones(len(start), bool)
    lead[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[lead], length[lead], period[lead]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return factors.row[start], start - factors.first[start], length, period


def _echoing(words: np.ndarray, row_words: np.ndarray) -> np.ndarray:
    """Rows in which six neighbouring words occur twice."""
    at = inside(row_words, ECHO)
    if not len(at):
        return at
    row = rows_of(row_words)[at]
    grams = mix(gram_hashes(words, ECHO)[at] ^ mix(row.astype(U64) + U64(1)))
    ordered = np.sort(grams)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    return np.unique(row[np.isin(grams, again)]) if len(again) else np.zeros(0, np.int64)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_words, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` is the text without the words that any run holds after its first period, joined by one
    space. One row for each row of the input, whatever its key: null keys and repeated rows are treated
    like others. Null text, empty text and text without words have no words, no runs and an empty
    ``collapsed``. A very long text is worked on whole, in one task, with memory in proportion to it. Runs
    with equal starts are ordered by period. Other columns are not read, so their names cannot clash. An
    empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches):
        for batch in batches:
            for part, data, offsets in text_blocks(batch):
                starts, ends, row_words = word_bounds(data, offsets)
                words = span_hashes(data, starts, ends)
                held = _echoing(words, row_words)
                size = np.diff(row_words)[held]
                bounds = before(size)
                picked = np.repeat(row_words[held] - bounds[:-1], size) + np.arange(bounds[-1])
                row, start, length, period = runs_of(words[picked], bounds)
                row = held[row] if len(row) else row
                counts = np.bincount(row, minlength=part.num_rows)
                runs = pa.ListArray.from_arrays(
                    pa.array(before(counts), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(kind)),
                )
                # Words that a run covers behind its first period, counted over the whole block.
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, row_words[row] + start + period, 1)
                np.add.at(edge, row_words[row] + start + length, -1)
                gone = np.cumsum(edge) > 0
                collapsed = []
                for k, body in enumerate(part.column(1).to_pylist()):
                    left = (body or "").encode().split()
                    if counts[k]:
                        first = row_words[k]
                        left = [left[i] for i in np.flatnonzero(~gone[first : first + len(left)]).tolist()]
                    collapsed.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(row_words), pa.int64()), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "runs", "collapsed"],
                )

    schema = f"key {rows.dtypes[0][1]}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(work, schema).withColumnRenamed("key", key)
